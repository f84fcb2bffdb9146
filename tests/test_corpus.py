import hashlib
import os

import pytest
from pyspark.sql import functions as F

from quillspark.operators import guards, splice
from quillspark.sources import corpus


def rows(spark, root):
    return {r.path: r.content for r in corpus.read_corpus(spark, root).collect()}


def none(spark):
    return spark.createDataFrame([], "guard string, subject string, detail string")


def tree_of(root):
    return sorted((d, f, os.path.getsize(os.path.join(d, f))) for d, _, fs in os.walk(root) for f in fs)


def test_versions(spark, tmp_path):
    root = str(tmp_path / "c")
    assert rows(spark, root) == {}
    first = {f"a/{i}.md": f"text {i} ü\n" for i in range(30)} | {"b/x.md": "x", "top.md": ""}
    df = lambda d: spark.createDataFrame(list(d.items()), "path string, content string")
    corpus.write_corpus(df(first).repartition(5), none(spark), root)
    assert rows(spark, root) == first
    got = corpus.read_corpus(spark, "file:" + root).where("path = 'a/3.md'").first()
    assert (got.sha256, got.bytes) == (hashlib.sha256("text 3 ü\n".encode()).hexdigest(), 10)
    second = {"a/1.md": "new", "c/y.md": "y"}
    corpus.write_corpus(df(second), none(spark), root, owned=spark.createDataFrame([("a",), ("c",)], "dir string"))
    assert rows(spark, root) == second | {"b/x.md": "x", "top.md": ""}
    assert corpus.sweep(root) == 1 and rows(spark, root) == second | {"b/x.md": "x", "top.md": ""}
    corpus.write_corpus(df({}), none(spark), root)
    assert rows(spark, root) == {}


def test_refused_runs_leave_the_folder(spark, tmp_path):
    root = str(tmp_path / "c")
    df = lambda *r: spark.createDataFrame(r, "path string, content string")
    corpus.write_corpus(df(("a/b.md", "x")), none(spark), root)
    before = tree_of(root)
    bad = guards.violation(spark.range(1).select(F.lit("s").alias("s")), "some", "s", "'why'")
    for files, v in ((df(("a", "x")), bad), (df(("a", "x"), ("a", "y")), none(spark)), (df(("../a", "x")), none(spark)), (df(("a//b", "x")), none(spark)), (df((None, "x")), none(spark)), (df(("a", None)), none(spark))):
        with pytest.raises(ValueError):
            corpus.write_corpus(files, v, root)
    assert tree_of(root) == before and rows(spark, root) == {"a/b.md": "x"}


def test_a_failed_task_leaves_the_folder(spark, tmp_path):
    root = str(tmp_path / "c")
    good = spark.createDataFrame([("a/b.md", "x")], "path string, content string")
    corpus.write_corpus(good, none(spark), root)
    before = tree_of(root)
    late = spark.range(40, numPartitions=4).select(F.concat(F.lit("n/"), "id").alias("path"), F.when(F.col("id") == 39, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("content"))
    with pytest.raises(Exception, match="broken"):
        late.write.format("corpus").mode("append").option("path", root).option("run", "r").save()
    assert tree_of(root) == before and rows(spark, root) == {"a/b.md": "x"}


def test_changed_files_are_noticed(spark, tmp_path):
    root = str(tmp_path / "c")
    run = corpus.write_corpus(spark.createDataFrame([("a/b.md", "x")], "path string, content string"), none(spark), root)
    with open(f"{root}/versions/{run}/files/a/b.md", "w") as f:
        f.write("y")
    with pytest.raises(Exception, match="what was written"):
        corpus.read_corpus(spark, root).collect()


def test_subtrees_below_pointers(spark):
    # d: r(0) > p(1) -> t:2, q(2), p(3) -> t:1;  t: r(0) > a(1) > b(2) > x(3), p(4) -> t:5; then c(5)
    nodes = [("d", 0, [0]), ("d", 1, [0, 1]), ("d", 2, [0, 2]), ("d", 3, [0, 3]), ("t", 0, [0]), ("t", 1, [0, 1]), ("t", 2, [0, 1, 2]), ("t", 3, [0, 1, 2, 3]), ("t", 4, [0, 1, 4]), ("t", 5, [0, 5])]
    points = [("d", 1, "t", 2), ("d", 3, "t", 1), ("t", 4, "t", 5), ("d", 2, "t", 99)]
    n, p = spark.createDataFrame(nodes, "doc_id string, pre int, path array<int>"), spark.createDataFrame(points, "doc_id string, pre int, to_doc string, to_pre int")
    out, faults = splice.spliced(n, p)
    got = [(r.from_doc, r.from_pre, r.hops) for r in out.where("doc_id = 'd'").orderBy("label").collect()]
    assert got == [("d", 0, 0), ("d", 1, 0), ("t", 2, 1), ("t", 3, 1), ("d", 2, 0), ("d", 3, 0), ("t", 1, 1), ("t", 2, 1), ("t", 3, 1), ("t", 4, 1), ("t", 5, 2)]
    assert [(r.doc_id, r.label, r.fault) for r in faults.collect()] == [("d", [0, 2], "points to nothing")]
    assert [r.from_pre for r in out.where("doc_id = 't'").orderBy("label").collect()] == [0, 1, 2, 3, 4, 5, 5]


def test_pointers_without_end(spark):
    n = spark.createDataFrame([("d", 0, [0]), ("d", 1, [0, 1])], "doc_id string, pre int, path array<int>")
    out, faults = splice.spliced(n, spark.createDataFrame([("d", 1, "d", 0)], "doc_id string, pre int, to_doc string, to_pre int"), most=3)
    assert [(r.from_pre, r.hops) for r in out.orderBy("label").collect()] == [(0, 0), (1, 0), (0, 1), (1, 1), (0, 2), (1, 2), (0, 3), (1, 3)]
    assert [r.fault for r in faults.collect()] == ["has no end"]
