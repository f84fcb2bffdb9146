"""Counts and summaries that reports and indexes are made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def kinds(units: DataFrame) -> DataFrame:
    """Units by edition and kind, overviews of their own."""
    kind = F.when((F.col("kind") == "page") & F.col("overview"), "page (overview)").otherwise(F.col("kind"))
    return units.groupBy("edition", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def kind_summary(counts: DataFrame) -> DataFrame:
    """One phrase per edition: ``12 clause, 3 page``. An edition has a handful of kinds."""
    return counts.groupBy("edition").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("kind", "n"))), lambda s: F.concat(s["n"].cast("string"), F.lit(" "), s["kind"])), ", ").alias("summary"))


def package_overlap(files: DataFrame) -> DataFrame:
    """Files by name over packages (package, name, content): how many packages have it, and how many contents it has."""
    return files.groupBy("name").agg(F.count_distinct("package").alias("packages"), F.count_distinct(F.sha2("content", 256)).alias("contents"))


def retention_sites(retained: DataFrame) -> DataFrame:
    """One row: distinct passages kept from an earlier state (file, tag, text), and the files that hold them."""
    return retained.agg(F.count_distinct(F.struct("file", "tag", "text")).alias("sites"), F.count_distinct("file").alias("files"))


def states_of(variations: DataFrame, key: str) -> DataFrame:
    """The jurisdictions whose variations go with each key."""
    return variations.groupBy(key).agg(F.array_sort(F.collect_set(F.upper("state"))).alias("states"))


def facets(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Distinct values of a key in first-seen order, joined by comma and space."""
    g = df.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("__a"))
    return g.select(key, F.array_join(F.array_distinct(F.transform("__a", lambda s: s[value])), ", ").alias(value))


def glossary_classes(folded: DataFrame) -> DataFrame:
    """How glossary paths fold (path, contents, classes): identical, identical but for images, published differently."""
    kind = F.when(F.col("contents") == 1, "identical").when(F.col("classes") == 1, "identical but for images").otherwise("published differently")
    return folded.groupBy(kind.alias("class")).agg(F.count(F.lit(1)).alias("n"))


def unit_shape(kind: str = "kind", overview: str = "overview", container: str = "container_num") -> Column:
    """What a unit without a page is: a section's or container's overview, a page, or its kind."""
    return F.when(F.col(overview) & (F.coalesce(F.col(container), F.lit("")) == ""), "section overview").when(F.col(overview), "container overview").otherwise(F.col(kind))


def coverage(units: DataFrame, by: list[str], resolved: Column) -> DataFrame:
    """Resolved of total by ``by``, with a percentage."""
    from quillspark.functions.labels import percent

    g = units.groupBy(*by).agg(F.count_if(resolved).alias("resolved"), F.count(F.lit(1)).alias("total"))
    return g.withColumn("share", percent(F.col("resolved"), F.col("total")))


def documents_read(units: DataFrame) -> DataFrame:
    """By document (doc, in_scope, figures, warnings): units read, units in scope, distinct figures of the latter, and their warnings."""
    own = units.where("in_scope")
    figures = own.select("doc", F.explode("figures").alias("figure")).groupBy("doc").agg(F.count_distinct("figure").alias("figures"))
    g = units.groupBy("doc").agg(F.count(F.lit(1)).alias("read"), F.count_if("in_scope").alias("scoped"), F.sum(F.when(F.col("in_scope"), F.size("warnings")).otherwise(0)).alias("warnings"))
    return g.join(figures, "doc", "left").select("doc", "read", "scoped", F.coalesce("figures", F.lit(0)).alias("figures"), "warnings")


def figures_published(read: DataFrame, files: DataFrame, pattern: str) -> DataFrame:
    """One row: distinct figures that units (figure) refer to, and distinct matches of ``pattern`` (first group) in the finished files (content)."""
    found = files.select(F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit(pattern), F.lit(1)))).alias("figure"))
    side = lambda df, name: df.select("figure", F.lit(name).alias("side"))
    both = side(read, "read").unionByName(side(found, "published"))
    return both.agg(*(F.count_distinct(F.when(F.col("side") == s, F.col("figure"))).alias(s) for s in ("read", "published")))


def tally(df: DataFrame, *keys: Column) -> DataFrame:
    """Rows by keys; the census of roots, memberships, variations and figures."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def reference_counts(refs: DataFrame, emitted: DataFrame) -> DataFrame:
    """One row of a map's references (conref, ord, draft, base_id) against units emitted (base_id): all, repeated
    ones, those without an earlier designation, those of the draft only, and those of them whose designation is emitted."""
    mapped = refs.where("not draft")
    first = refs.groupBy("conref").agg(F.bool_and("draft").alias("__only"), F.max("base_id").alias("base_id"))
    only = first.where("__only and base_id <> ''").join(emitted.select("base_id", F.lit(True).alias("__there")).distinct(), "base_id", "left")
    a = mapped.agg(F.count(F.lit(1)).alias("refs"), (F.count(F.lit(1)) - F.count_distinct("conref")).alias("duplicates"), F.count_distinct(F.when(F.col("base_id") == "", F.col("conref"))).alias("unnumbered"))
    return a.join(only.agg(F.count(F.lit(1)).alias("insert_only"), F.count("__there").alias("insert_only_duplicates")))


def by_volume(urls: DataFrame, pattern: str = r"/adopted/([^/?#]+)") -> DataFrame:
    """Crawled URLs by volume; those outside all volumes under the empty one."""
    return urls.select("url").distinct().groupBy(F.regexp_extract("url", pattern, 1).alias("volume")).agg(F.count(F.lit(1)).alias("n"))


def inverted(refs: DataFrame, key: str, value: str) -> DataFrame:
    """An inverted index in long form: each key's distinct values in order (place), and how many there are. No key's values meet in one row."""
    w = Window.partitionBy(key)
    return refs.select(key, value).where(F.col(key).isNotNull()).distinct().withColumn("place", F.row_number().over(w.orderBy(value)).cast("long")).withColumn("n", F.count(F.lit(1)).over(w))
