"""A crawl as a table of states: one level a job, written after each, so that it can stop and resume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators import scan
from quillspark.session import cut


def crawl(edges: DataFrame, seeds: DataFrame, depth: int, failing: DataFrame | None = None, most_failures: int = 5, levels: int | None = None, resume: DataFrame | None = None) -> DataFrame:
    """(node, depth, state) of every node within ``depth`` links of the seeds, by breadth-first joins.

    edges (src, dst), seeds (node). state: done (its links were followed), failed (a node of
    ``failing`` (node): it has no links to follow), recorded (at the last depth, not followed), pending
    (the run stopped before it). A run stops after ``levels`` levels, or in a level when ``most_failures``
    nodes in a row, in their order, have failed: those after them stay pending. ``resume``: the table of an
    earlier run, whose pending nodes are taken up; seeds that it doesn't know are added.

    Each level is one join of the frontier with the edges, less what is known, and is written; so a
    plan never holds more than one level. A null node is none; the driver sees a level's number and a place.
    """
    edges = cut(edges.select("src", "dst").where("src is not null and dst is not null").distinct(), "edges")
    first = "pending" if depth > 0 else "recorded"
    state = seeds.select("node").where("node is not null").distinct().select("node", F.lit(0).alias("depth"), F.lit(first).alias("state"))
    if resume is not None:
        state = resume.unionByName(state.join(resume.select("node"), "node", "left_anti"))
    state, done = cut(state, "frontier"), 0
    while levels is None or done < levels:
        level = state.where("state = 'pending'").agg(F.min("depth")).first()[0]
        if level is None:
            break
        tried, stopped = _tried(state.where(f"state = 'pending' and depth = {level}").select("node"), failing, most_failures)
        follow = tried.where("ok").select(F.col("node").alias("src"))
        below = "pending" if level + 1 < depth else "recorded"
        found = edges.join(follow, "src", "left_semi").select(F.col("dst").alias("node")).distinct().join(state.select("node"), "node", "left_anti")
        now = state.join(tried, "node", "left").select("node", "depth", F.when(F.col("ok"), "done").when(~F.col("ok"), "failed").otherwise(F.col("state")).alias("state"))
        state = cut(now.unionByName(found.select("node", F.lit(level + 1).alias("depth"), F.lit(below).alias("state"))), "frontier")
        done += 1
        if stopped:
            break
    return state


def _tried(nodes: DataFrame, failing: DataFrame | None, most: int) -> tuple[DataFrame, bool]:
    """(node, ok) of the nodes that are tried before ``most`` in a row fail, and whether it came to that."""
    if failing is None:
        return nodes.withColumn("ok", F.lit(True)), False
    bad = failing.select("node").distinct().withColumn("__bad", F.lit(True))
    tried = cut(nodes.join(bad, "node", "left").select("node", F.col("__bad").isNull().alias("ok")), "level")
    full = scan.runs(tried, ["node"], "ok").where(~F.col("ok") & (F.col("length") >= most)).agg(F.min("first")).first()[0]
    if full is None:
        return tried, False
    return scan.places(tried, ["node"]).where(F.col("place") < full + most).select("node", "ok"), True
