"""Scans over one ordered sequence that no single task holds.

The rows are dealt out by ranges of their order and written once. Each range is summed up to one
row by an associative operation; the driver folds these summaries, one a range, to what stands
before each range; a second pass over the ranges adds it. So a global place, running sum or run
costs one exchange by range and two passes, and no exchange to a single task. Rows that tie in the
whole order fall into one range: the order should name a key that tells rows apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from quillspark.session import cut


def ranged(df: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """``df`` written by ranges of ``order`` (names or sort columns), with the range as __part: all rows of a
    lower one stand before those of a higher one. parts: at most so many ranges, by default the session's shuffle partitions."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranges")


def _within(order: list) -> Window:
    return Window.partitionBy("__part").orderBy(*order)


def _so_far(order: list) -> Window:
    return _within(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(summaries: DataFrame, start: tuple, combine: Callable[[tuple, Row], tuple], schema: str) -> DataFrame:
    """(__part, *schema): ``start`` with the summaries of all lower ranges combined into it, in their order.

    ``summaries`` has one row for each range, as many as shuffle partitions at most: the driver sees
    no more, and the result is small enough to be sent to every task.
    """
    out, state = [], start
    for r in sorted(summaries.collect(), key=lambda r: r["__part"]):
        out.append((r["__part"], *state))
        state = combine(state, r)
    return F.broadcast(summaries.sparkSession.createDataFrame(out, f"__part int, {schema}"))


def places(df: DataFrame, order: list, name: str = "place", parts: int | None = None) -> DataFrame:
    """``df`` with each row's place in the whole order, from 1."""
    r = ranged(df, order, parts)
    before = _before(r.groupBy("__part").agg(F.count(F.lit(1)).alias("n")), (0,), lambda s, x: (s[0] + x["n"],), "__before long")
    return r.join(before, "__part").withColumn(name, F.row_number().over(_within(order)) + F.col("__before")).drop("__part", "__before")


def running_sum(df: DataFrame, order: list, value: Column, name: str, parts: int | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` (whole numbers; null counts 0) up to and with each row."""
    r = ranged(df.withColumn("__v", F.coalesce(value.cast("long"), F.lit(0))), order, parts)
    before = _before(r.groupBy("__part").agg(F.sum("__v").alias("n")), (0,), lambda s, x: (s[0] + x["n"],), "__before long")
    return r.join(before, "__part").withColumn(name, F.sum("__v").over(_so_far(order)) + F.col("__before")).drop("__part", "__before", "__v")


def running_max(df: DataFrame, partition: list[str], order: list[str], value: str, name: str, parts: int | None = None) -> DataFrame:
    """``df`` with the greatest ``value`` (a whole number) of the rows of its partition up to and with each row.

    As a window, but a partition may be larger than a task: a range passes on its last partition
    and the greatest value of that, which counts for rows of later ranges as long as they are of the same one.
    """
    r = ranged(df.withColumn("__k", F.struct(*partition)).withColumn("__v", F.col(value).cast("long")), [*partition, *order], parts)
    each = r.groupBy("__part", "__k").agg(F.max("__v").alias("m"))
    ends = each.groupBy("__part").agg(F.min("__k").alias("first"), F.max(F.struct("__k", "m")).alias("last"))

    def combine(state: tuple, x: Row) -> tuple:
        key, m = x["last"]
        alone = x["first"] == key == state[0] and state[1] is not None
        return key, max(state[1], m) if alone and m is not None else state[1] if alone else m

    kind = df.select(F.struct(*partition).alias("k")).schema["k"].dataType.simpleString()
    before = _before(ends, (None, None), combine, f"__open {kind}, __most bigint")
    w = Window.partitionBy("__part", "__k").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.max("__v").over(w)
    return r.join(before, "__part").withColumn(name, F.when(F.col("__open").eqNullSafe(F.col("__k")), F.greatest("__most", own)).otherwise(own)).drop("__part", "__k", "__v", "__open", "__most")


def clamped_depth(df: DataFrame, order: list, delta: Column, name: str = "depth", parts: int | None = None) -> DataFrame:
    """A counter over all rows as one sequence that never falls below zero.

    With S the running sum and m its running minimum, the depth is S - min(0, m). A range is summed
    up as (its sum, the least of its running sums); two such combine to (s + s', min(m, s + m')).
    A null delta counts 0.
    """
    r = ranged(df.withColumn("__v", F.coalesce(delta.cast("long"), F.lit(0))), order, parts)
    r = r.withColumn("__s", F.sum("__v").over(_so_far(order)))
    sums = r.groupBy("__part").agg(F.sum("__v").alias("s"), F.min("__s").alias("m"))
    before = _before(sums, (0, 0), lambda a, x: (a[0] + x["s"], min(a[1], a[0] + x["m"])), "__sum long, __min long")
    low = F.least(F.col("__min"), F.col("__sum") + F.min("__s").over(_so_far(order)))
    return r.join(before, "__part").withColumn(name, F.col("__sum") + F.col("__s") - low).drop("__part", "__v", "__s", "__sum", "__min")


def runs(df: DataFrame, order: list, key: str, parts: int | None = None) -> DataFrame:
    """(first, length, key): stretches of rows with equal ``key`` (null equals null) in one sequence; first is the place of a stretch's first row, from 1.

    A range passes on its number of rows and its last key. A row that differs from the one before it
    opens a stretch, which is known by its place; the last opening up to a row is its stretch, or
    the last one of the ranges before. Stretches that cross ranges are summed up by an aggregate.
    """
    r = ranged(df.select(key, *{c: None for c in order if isinstance(c, str) and c != key}), order, parts)
    w = _within(order)
    edges = r.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    last = r.withColumn("__n", F.row_number().over(w)).join(F.broadcast(edges), "__part").where("__n = n").select("__part", "n", F.struct(F.col(key).alias("k")).alias("last"))
    kind = df.schema[key].dataType.simpleString()
    before = _before(last, (0, None), lambda s, x: (s[0] + x["n"], x["last"]), f"__before long, __last struct<k: {kind}>")
    numbered = r.join(before, "__part").withColumn("__n", F.row_number().over(w)).withColumn("__prev", F.coalesce(F.lag(F.struct(F.col(key).alias("k"))).over(w), F.col("__last")))
    opens = F.col("__prev").isNull() | ~F.col("__prev.k").eqNullSafe(F.col(key))
    own = numbered.withColumn("__first", F.max(F.when(opens, F.col("__before") + F.col("__n"))).over(_so_far(order)))
    # what a range has left open when it ends, for rows of later ranges that open nothing before them
    left = _before(own.groupBy("__part").agg(F.max("__first").alias("f")), (None,), lambda s, x: (x["f"] if x["f"] is not None else s[0],), "__open long")
    own = own.join(left, "__part").withColumn("first", F.coalesce("__first", "__open"))
    return own.groupBy("first").agg(F.count(F.lit(1)).alias("length"), F.first(key).alias(key))
