"""What an answerer may ask of a corpus: names, phrases, scopes, terms, figures, editions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators import positions


def by_designation(corpus: DataFrame, id: str) -> DataFrame:
    """Files whose name leads with a designation's token."""
    return corpus.where(F.regexp_extract("path", r"([^/]+)\.md$", 1).rlike(f"^{id.lower().replace('.', '[.]')}(-|$)"))


def phrase(corpus: DataFrame, words: str) -> DataFrame:
    """(path, lines): lines that hold one phrase, by one scan; a paragraph is one line. For many phrases, or again and again, take ``phrases``."""
    lines = F.filter(F.split("content", "\n"), lambda x: F.contains(x, F.lit(words)))
    return corpus.where(F.contains("content", F.lit(words))).select("path", F.size(lines).alias("lines"))


def phrases(postings: DataFrame, wanted: list[str]) -> DataFrame:
    """(phrase, path, lines): how many lines of each file hold each phrase, from an index of lines (``positions.index``) in one job."""
    found = positions.lines_with(postings, wanted)
    return found.groupBy("phrase", "row", F.col("doc").alias("path")).agg(F.count(F.lit(1)).alias("lines")).drop("row")


def citation_window(corpus: DataFrame, n: int = 7) -> DataFrame:
    """Whether citation and address stand in the first lines of a file."""
    head = F.array_join(F.slice(F.split("content", "\n"), 1, n), "\n")
    return corpus.select("path", F.contains(head, F.lit("citation: ")).alias("cited"), F.contains(head, F.lit("web_url: ")).alias("linked"))


def in_jurisdiction(corpus: DataFrame, state: str) -> DataFrame:
    return corpus.where(F.col("jurisdiction") == state.lower())


def applies_to(excluded: Column, cls: str) -> Column:
    """Whether a unit applies to a class: the list names those it does not apply to; no list, all."""
    return ~F.array_contains(F.split(F.coalesce(excluded, F.lit("")), ",\\s*"), cls)


def term_sources(units: DataFrame, glossary: DataFrame) -> DataFrame:
    """Terms that units use, with the glossary file and sources that define them, matched on folded text."""
    from quillspark.functions.text import slugify

    used = units.select("path", F.explode("defined_terms").alias("used"))
    g = glossary.select(F.col("path").alias("definition"), "sources", slugify(F.col("term")).alias("__k"))
    # folding is dear: each distinct term is folded once
    terms = used.select("used").distinct().withColumn("__k", slugify(F.col("used"))).join(g, "__k", "left").drop("__k")
    return used.join(terms, "used").select("path", "used", "definition", "sources")


def browse(index: DataFrame) -> DataFrame:
    from quillspark.operators.ordered import by_tuple

    return by_tuple(index, "label", "state", "path")


def disapplied(corpus: DataFrame, words: str) -> DataFrame:
    """Overview pages whose block quotes hold a phrase."""
    quotes = F.filter(F.split("content", "\n"), lambda x: x.startswith("> ") & F.contains(x, F.lit(words)))
    return corpus.where("kind = 'page' and overview").where(F.size(quotes) > 0).select("path", quotes.alias("quotes"))


def size_census(corpus: DataFrame) -> DataFrame:
    n = F.octet_length("content")
    return corpus.groupBy("edition").agg(F.count(F.lit(1)).alias("files"), F.max(n).alias("largest"), F.sum(n).alias("bytes"))
