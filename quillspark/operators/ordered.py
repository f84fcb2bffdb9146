"""Ordered-state, sorting, set and truncation operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators import scan


def last_by(df: DataFrame, key: str, order: str, where: Column) -> DataFrame:
    """The last row of each key that meets a condition."""
    cols = [c for c in df.columns if c not in (key, order)]
    return df.where(where).groupBy(key).agg(F.max(order).alias(order), *(F.max_by(c, order).alias(c) for c in cols))


def error_runs(df: DataFrame, partition: str, order: str, ok: Column) -> DataFrame:
    """The longest run of consecutive failures of each partition."""
    w = Window.partitionBy(partition).orderBy(order)
    g = df.withColumn("__ok", ok.cast("int")).withColumn("__g", F.sum("__ok").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return g.groupBy(partition, "__g").agg(F.sum(1 - F.col("__ok")).alias("n")).groupBy(partition).agg(F.max("n").alias("longest"))


def numbered(df: DataFrame, partition: list[str], order: list[str], where: Column, name: str = "n") -> DataFrame:
    """Rows that meet ``where`` with their place among them: empty ones take no number."""
    return df.where(where).withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))


def pending_number(df: DataFrame, partition: str, order: str) -> DataFrame:
    """Paragraphs with the number that stands right before them; numbers without a paragraph are orphans.

    df: partition, order, kind (num or other), text.
    """
    w = Window.partitionBy(partition).orderBy(order)
    n = df.withColumn("__prev", F.lag(F.struct("kind", "text")).over(w)).withColumn("__next", F.lead("kind").over(w))
    return n.where("kind <> 'num' or __next is null or __next = 'num'").select(partition, order, "kind", F.when(F.col("kind") == "num", F.lit(None)).otherwise(F.col("text")).alias("text"), F.when(F.col("kind") == "num", F.col("text")).when(F.col("__prev.kind") == "num", F.col("__prev.text")).alias("number"), (F.col("kind") == "num").alias("orphan"))


def truncated(df: DataFrame, partition: list[str], order: list, most: int) -> DataFrame:
    """The first rows of each partition, with how many more there are."""
    w = Window.partitionBy(*partition)
    return df.withColumn("__n", F.row_number().over(w.orderBy(*order))).withColumn("more", F.greatest(F.count(F.lit(1)).over(w) - most, F.lit(0))).where(F.col("__n") <= most).withColumnRenamed("__n", "rank")


def by_tuple(df: DataFrame, label: str, state: str, path: str) -> DataFrame:
    """Index order: label, national before jurisdictions, path; by code point."""
    return df.orderBy(label, F.coalesce(F.col(state), F.lit("")), path)


def places(df: DataFrame, label: str, state: str, path: str) -> DataFrame:
    """``df`` with its place in index order, from 1: by ranges of that order, whatever share of the rows a label has."""
    keyed = df.withColumn("__state", F.coalesce(F.col(state), F.lit("")))
    return scan.places(keyed, [label, "__state", path]).drop("__state")


def heading_windows(lines: DataFrame) -> DataFrame:
    """Label lines (doc_id, pos, line) that host nothing deeper: the next non-blank line is indented no further."""
    n = lines.where("trim(line) <> ''").withColumn("indent", F.length("line") - F.length(F.ltrim("line")))
    w = Window.partitionBy("doc_id").orderBy("pos")
    return n.withColumn("next_indent", F.lead("indent").over(w)).where(F.col("line").rlike(r"^\s*(\([a-z0-9]+\)|-)\s*$") & (F.coalesce("next_indent", F.lit(0)) <= F.col("indent"))).select("doc_id", "pos", "line")


def head_lines(content: Column, n: int = 7) -> Column:
    return F.slice(F.split(content, "\n"), 1, n)


def whole(selected: DataFrame, every: DataFrame, key: str) -> DataFrame:
    """One row: whether the two hold the same keys."""
    a, b = selected.select(key).distinct(), every.select(key).distinct()
    return a.exceptAll(b).unionAll(b.exceptAll(a)).agg((F.count(F.lit(1)) == 0).alias("whole"))


def reconcile(present: DataFrame, producible: DataFrame, owned: DataFrame, known: DataFrame, keep: str = "INDEX.md") -> DataFrame:
    """Files on disk with what to do: keep, delete (owned folder, not producible, or unknown folder), leave (another run's folder)."""
    p = present.withColumn("dir", F.regexp_replace("path", "/[^/]*$", ""))
    flag = lambda df, k, n: df.select(k).distinct().withColumn(n, F.lit(True))
    j = p.join(flag(producible, "path", "__p"), "path", "left").join(flag(owned, "dir", "__o"), "dir", "left").join(flag(known, "dir", "__k"), "dir", "left")
    act = F.when(F.col("path").endswith(keep), "keep").when(F.col("__p"), "keep").when(F.col("__o"), "delete").when(F.col("__k"), "leave").otherwise("delete")
    return j.select("path", act.alias("action"))


def both_ways(found: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Keys of one side only: (key, side)."""
    f, l = found.select(key).distinct().withColumn("__f", F.lit(True)), listed.select(key).distinct().withColumn("__l", F.lit(True))  # noqa: E741
    return f.join(l, key, "full_outer").where("__f is null or __l is null").select(key, F.when(F.col("__l").isNull(), "unlisted").otherwise("dead").alias("side"))


def dead(declared: DataFrame, fired: DataFrame, superseded: DataFrame, key: str) -> DataFrame:
    """Declared rulings that neither fired nor were superseded."""
    return declared.select(key).subtract(fired.select(key)).subtract(superseded.select(key))


def compare(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Editions side by side on null-safe keys: same, changed, only left or only right."""
    fill = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys]
    l = left.select(*fill, F.col(value).alias("l"), F.lit(True).alias("__l"))  # noqa: E741
    r = right.select(*fill, F.col(value).alias("r"), F.lit(True).alias("__r"))
    state = F.when(F.col("__r").isNull(), "only left").when(F.col("__l").isNull(), "only right").when(F.col("l").eqNullSafe(F.col("r")), "same").otherwise("changed")
    return l.join(r, keys, "full_outer").select(*keys, state.alias("state"))
