import random

import pytest
from pyspark.sql import functions as F

from quillspark.operators import ordered, scan


def rows(n, seed, kinds="abc"):
    r = random.Random(seed)
    out, k = [], "a"
    for i in range(n):
        if r.random() < 0.2:
            k = r.choice([*kinds, None])
        out.append((i * 3 % (7 * n), i, k, r.choice((-1, -1, 0, 1, 1, None))))
    return out


@pytest.mark.parametrize("n,parts", [(0, 3), (1, 5), (2, 7), (300, 1), (300, 8), (300, 40)])
def test_one_sequence(spark, n, parts):
    data = rows(n, n + parts)
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "a int, b int, k string, d int").repartition(4)
    data.sort()
    depth, total, places, sums, depths = 0, 0, {}, {}, {}
    for i, (_, b, _, d) in enumerate(data):
        total += d or 0
        depth = max(0, depth + (d or 0))
        places[b], sums[b], depths[b] = i + 1, total, depth
    get = lambda x, c: {r["b"]: r[c] for r in x.collect()}
    assert get(scan.places(df, ["a", "b"], parts=parts), "place") == places
    assert get(scan.running_sum(df, ["a", "b"], F.col("d"), "s", parts), "s") == sums
    got = scan.clamped_depth(df, ["a", "b"], F.col("d"), parts=parts)
    assert get(got, "depth") == depths and got.columns == ["a", "b", "k", "d", "depth"]
    islands = []
    for i, (_, _, k, _) in enumerate(data):
        if islands and islands[-1][2] == k:
            islands[-1][1] += 1
        else:
            islands.append([i + 1, 1, k])
    assert sorted(map(list, scan.runs(df, ["a", "b"], "k", parts).select("first", "length", "k").collect())) == islands


def test_no_exchange_to_one_task(spark):
    df = spark.range(1000).withColumn("d", F.lit(1))
    plan = scan.clamped_depth(df, ["id"], F.col("d"))._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "rangepartitioning" not in plan


def test_places_in_index_order(spark):
    df = spark.createDataFrame([("b", None, "x"), ("a", "nsw", "y"), ("a", None, "z"), ("a", None, "y")], "label string, state string, path string")
    got = {(r.label, r.state, r.path): r.place for r in ordered.places(df, "label", "state", "path").collect()}
    assert got == {("a", None, "y"): 1, ("a", None, "z"): 2, ("a", "nsw", "y"): 3, ("b", None, "x"): 4}
