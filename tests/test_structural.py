import random

import pytest

from quillspark.operators import scan, tree
from quillspark.sources import frontier


def forest(r, doc, n):
    """(doc_id, pre, post, path) of a random tree."""
    rows, stack, closed = [], [], [0]

    def close():
        rows[stack.pop()][2] = closed[0]
        closed[0] += 1

    for i in range(n):
        while len(stack) > 1 and r.random() < 0.45:
            close()
        rows.append([doc, i, 0, [*stack, i]])
        stack.append(i)
    while stack:
        close()
    return rows


@pytest.mark.parametrize("sizes", [(), (1,), (1, 2, 3), (400, 1, 90, 7)])
def test_ancestors_from_pre_and_post(spark, sizes):
    r = random.Random(sum(sizes))
    rows = [x for d, n in enumerate(sizes) for x in forest(r, d, n)]
    r.shuffle(rows)
    nodes = spark.createDataFrame(rows, "doc_id int, pre int, post int, path array<int>")
    want = {(d, p): path for d, p, _, path in rows}
    assert {(x.doc_id, x.pre): x.path for x in tree.with_path(nodes.drop("path")).collect()} == want
    pairs = [(x.doc_id, x.pre, x.a_pre) for x in tree.stabbed(nodes.drop("path")).collect()]
    assert sorted(pairs) == sorted((d, p, a) for (d, p), path in want.items() for a in path[:-1])


def test_no_nested_loop_without_path(spark):
    nodes = spark.createDataFrame(forest(random.Random(1), 0, 50), "doc_id int, pre int, post int, path array<int>").drop("path")
    assert "NestedLoop" not in tree.with_path(nodes)._jdf.queryExecution().toString()


def test_running_max_by_partition(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None, "c"]), i, r.choice([None, r.randint(-9, 99)])) for i in range(200)]
    want = {}
    for k, i, v in sorted(rows, key=lambda x: x[1]):
        want[i] = max((x for x in (want.get(("last", k)), v) if x is not None), default=None)
        want["last", k] = want[i]
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(3)
    for parts in (1, 4, 30):
        assert {x.i: x.m for x in scan.running_max(df, ["k"], ["i"], "v", "m", parts).collect()} == {i: m for i, m in want.items() if isinstance(i, int)}


EDGES = [(f"n{i:02}", f"n{j:02}") for i in range(20) for j in ((i * 3) % 20, (i + 7) % 20)]


def test_stopped_and_resumed_crawl(spark):
    e, s = spark.createDataFrame(EDGES, "src string, dst string"), spark.createDataFrame([("n00",), (None,)], "node string")
    whole = sorted(map(tuple, frontier.crawl(e, s, 4).collect()))
    depth, now = {"n00": 0}, ["n00"]
    for d in range(1, 5):
        now = sorted({y for x, y in EDGES if x in now} - depth.keys())
        depth |= dict.fromkeys(now, d)
    assert whole == sorted((n, d, "recorded" if d == 4 else "done") for n, d in depth.items())
    part = frontier.crawl(e, s, 4, levels=1)
    assert part.where("state = 'pending'").count() == len([d for d in depth.values() if d == 1])
    for _ in range(3):
        part = frontier.crawl(e, s, 4, levels=1, resume=part)
    assert sorted(map(tuple, part.collect())) == whole
    assert [tuple(x) for x in frontier.crawl(e, s, 0).collect()] == [("n00", 0, "recorded")]


def test_crawl_stops_at_failures_in_a_row(spark):
    e = spark.createDataFrame([("a", f"n{i:02}") for i in range(12)] + [("n11", "z"), ("n00", "y")], "src string, dst string")
    s = spark.createDataFrame([("a",)], "node string")
    bad = spark.createDataFrame([(f"n{i:02}",) for i in (1, 3, 4, 5, 6, 7, 8)], "node string")
    got = {r.node: r.state for r in frontier.crawl(e, s, 3, bad).collect()}
    want = {"a": "done", "n00": "done", "n01": "failed", "n02": "done"} | {f"n{i:02}": "failed" for i in range(3, 8)} | {f"n{i:02}": "pending" for i in range(8, 12)} | {"y": "pending"}
    assert got == want
    plan = frontier.crawl(e, s, 3)._jdf.queryExecution().toString()
    assert plan.count("Exchange") == 0
    more = frontier.crawl(e, s, 3, bad, most_failures=9, resume=frontier.crawl(e, s, 3, bad))
    assert {r.node: r.state for r in more.collect()} == want | {"n08": "failed", "n09": "done", "n10": "done", "n11": "done", "y": "done", "z": "done"}
