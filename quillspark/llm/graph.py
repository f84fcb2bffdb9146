"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (src, dst; any orderable type): root is the least node reachable.

    Loops, repeated edges and edges with a null end are dropped. Each step shuffles rows of two
    ids; a hub's edges are summed up before the exchange and joined by a skew-splittable join. The
    state is written after each round; the driver sees a count and a checksum of it.
    """
    e = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("src is not null and dst is not null and u <> v").distinct()
    e, last = materialise(e, "components"), None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == last or not mark[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = mark
        e = materialise(_small_star(_large_star(e)), "components")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
