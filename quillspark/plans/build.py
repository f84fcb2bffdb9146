"""The corpus build: units and their bodies to files, violations and statistics.

No file of the corpus is written here. The caller evaluates ``violations`` first
(``guards.require_none``) and then writes ``files``; both come from the records, which are computed
once, when the build is called, and kept in the folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.functions import yamlish as ym
from quillspark.operators import fold, guards, tracked
from quillspark.session import cut


class Build(NamedTuple):
    files: DataFrame
    violations: DataFrame
    stats: DataFrame
    producible: DataFrame


def in_scope(units: DataFrame, sections: list[str] | None, volumes: list[str] | None) -> DataFrame:
    """Units of a slice: those without section number always, else those asked for."""
    if sections:
        units = units.where((F.coalesce("section_num", F.lit("")) == "") | F.col("section_num").isin(*sections))
    return units.where(F.col("volume").isin(*volumes)) if volumes else units


def absent(units: DataFrame, sections: list[str]) -> DataFrame:
    """Violations: requested sections that no unit has, with those there are."""
    have = units.agg(F.array_sort(F.collect_set("section_num")).alias("have"))
    want = have.select(F.explode(F.array_except(F.array(*map(F.lit, sections)), "have")).alias("section"), F.array_join("have", ", ").alias("have"))
    return guards.violation(want, "section", "section", "concat('there are: ', have)")


def build(units: DataFrame, rendered: DataFrame, urls: DataFrame, documents: DataFrame, rulings: DataFrame, container_tokens: dict[str, str], sections: list[str] | None = None, volumes: list[str] | None = None) -> Build:
    """Files of a corpus.

    units: unit, ord, edition, doc, volume, kind, id, term, title, state, supersedes,
    building_classes, containerKind, containerNum, sectionType, section_num, retained.
    rendered: unit, body, defined_terms, error. urls: unit, url. documents: doc, prefix
    (citation), figures (image prefix), label. rulings: id, volume, kind, id_ruled, state.
    A glossary entry is one file for all documents: their volumes as sources, their terms in
    first-seen order, the note of retained text of any, and their senses under numbered headings.
    """
    name = tx.unit_filename({c: F.col(c) for c in ("kind", "id", "term", "title", "state", "containerKind", "containerNum", "sectionType")}, container_tokens)
    u = units.withColumn("path", tx.unit_path(F.col("edition"), F.col("kind"), F.col("volume"), name))
    producible = u.select("path").distinct()
    u = in_scope(u, sections, volumes)
    j = u.join(rendered, "unit", "left").join(urls, "unit", "left").join(documents, "doc")
    state = F.nullif(F.col("state"), F.lit(""))
    clause = F.col("kind") == "clause"
    terms = F.coalesce("defined_terms", F.array().cast("array<string>"))

    def file(sources: Column | None, terms: Column, retained: Column, body: Column) -> Column:
        front = ym.front_matter({
            "clause": F.when(clause, F.col("id")), "term": F.when(F.col("kind") == "glossary", F.col("term")), "title": F.coalesce("title", F.lit("")),
            "citation": tx.citation(F.col("prefix"), F.col("kind"), F.col("id"), F.col("term"), F.col("title"), state), "web_url": F.col("url"), "edition": F.col("edition").cast("string"),
            "volume": F.when(F.col("kind") != "glossary", F.col("volume")), **({} if sources is None else {"sources": sources}), "jurisdiction": F.coalesce(F.lower(state), F.lit("aus")),
            "supersedes": F.when(clause, F.nullif(F.col("supersedes"), F.lit(""))), "building_classes_excluded": F.when(clause, F.nullif(F.col("building_classes"), F.lit(""))), "defined_terms": terms,
        })
        return ym.document(front, tx.heading(F.col("kind"), F.col("id"), F.col("term"), F.col("title")), tracked.disclosure(F.coalesce(retained, F.lit(0))), body)

    # a glossary entry's file names all documents that publish it, which are known after the fold only
    records = cut(j.withColumn("content", file(None, terms, F.col("retained"), F.col("body"))).withColumn("figures", F.coalesce("figures", F.lit(""))))
    r = records.select("path", "kind", "doc", "ord", "content", F.col("figures").alias("prefix"))
    outcome = fold.resolve_unique(r)
    single = r.join(outcome.where("outcome in ('single', 'identical')").select("path", F.col("canonical").alias("ord")), ["path", "ord"], "left_semi").where("kind <> 'glossary'").select("path", "content")
    entries = records.where("kind = 'glossary'").withColumn("defined_terms", terms).withColumn("own", F.array("volume"))
    bodies = fold.merge_senses(fold.fold_classes(entries.select("path", "kind", "doc", "ord", F.coalesce("body", F.lit("")).alias("content"), F.col("figures").alias("prefix")))).select("path", F.col("body").alias("merged_body"))
    told = fold.ordered_union(entries, "path", "own", "ord", "volumes").join(fold.ordered_union(entries, "path", "defined_terms", "ord", "all_terms"), "path").join(entries.groupBy("path").agg(F.max("retained").alias("kept"), F.min("ord").alias("ord")), "path").join(bodies, "path")
    sources = tx.sources_for(F.lit(None).cast("string"), F.col("volumes"))
    merged = cut(entries.join(told, ["path", "ord"]).withColumn("problem", sources["problem"]).withColumn("listed", sources["sources"]))
    glossary = merged.select("path", file(F.col("listed"), F.col("all_terms"), F.col("kept"), F.col("merged_body")).alias("content"))
    bad = guards.gathered(
        guards.violation(outcome.where("outcome = 'conflict'"), "unique path", "path", "concat_ws(', ', documents)"),
        guards.violation(u.where("path is null"), "name", "unit", "kind"),
        guards.violation(u.where(tx.unsafe_segment(F.coalesce("volume", F.lit("")))), "safe path", "unit", "volume"),
        guards.rendered(records),
        guards.violation(merged.where("problem is not null"), "sources", "path", "problem"),
        guards.violation(records.where("kind = 'clause' and url is null").join(rulings.select("volume", F.col("id_ruled").alias("id")), ["volume", "id"], "left_anti"), "linked", "unit", "'no page'"),
    )
    stats = records.groupBy("doc", "kind").agg(F.count(F.lit(1)).alias("units"), F.count("url").alias("linked"), F.sum(F.size(F.coalesce("warnings", F.array().cast("array<string>")))).alias("warnings"))
    return Build(single.unionByName(glossary), bad, stats, producible)
