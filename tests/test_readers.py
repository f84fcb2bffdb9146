import pytest
from pyspark.sql import functions as F

from quillspark.functions import urls
from quillspark.operators import census, guards
from quillspark.plans.readers import parse_args, read_document, read_package
from quillspark.sources.shred import shred

CLASSES = [("volume", "root", None), ("section", "root", None), ("part", "container", None), ("clause", "unit", "clause"), ("glossentry", "unit", "glossary"), ("p", "prose", None), ("title", "metadata", None), ("sptc", "metadata", None), ("glossterm", "metadata", None), ("archive-num", "metadata", None)]


def test_read_document(spark):
    x = '<volume><section num="C"><part num="C2"><title>Fire</title><p>Overview prose.</p><clause building="Class 1a" state="nsw"><sptc>C2D1</sptc><title>Walls</title><archive-num>C1.1</archive-num><p>x</p></clause></part></section><section num=""><glossentry category="symbols"><glossterm>m</glossterm></glossentry></section></volume>'
    nodes = shred(spark.createDataFrame([("d", x)], "id string, xml string"), "id", "xml").cache()
    rows = read_document(nodes, spark.createDataFrame(CLASSES, "tag string, class string, kind string"), "2025", "one").orderBy("unit_ord").collect()
    assert [(r["kind"], r["overview"], r["id"], r["term"], r["title"], r["state"], r["section_num"], r["container_num"], r["container_title"]) for r in rows] == [
        ("page", True, None, None, "Fire", None, "C", "C2", "Fire"), ("clause", False, "C2D1", None, "Walls", "NSW", "C", "C2", "Fire"), ("glossary", False, None, "m", "m", None, None, None, None),
    ]
    assert rows[1]["supersedes"] == "C1.1" and rows[1]["building_classes"] == "Class 1a" and rows[2]["category"] == "symbols"


def test_read_package(spark):
    spine = spark.createDataFrame([("r1", 1, "f1", "a", "a", "C"), ("r2", 2, "f9", "z", "z", "C"), ("r3", 3, "ERROR:x", None, None, "C"), ("r4", 4, "f2", "b", "wrong", "C")], "ref string, ord int, conref string, id string, title_id string, section string")
    clauses = spark.createDataFrame([("f1", "a", "a-NSW.xml", "nsw", "A1"), ("f2", "b", "b.xml", None, "B1"), ("f3", "c", "c-VIC.xml", "nsw", "C1"), ("f4", "d", "d.xml", None, "")], "conref string, id string, name string, variation string, base_id string")
    units, bad = read_package(spine, clauses, spark.createDataFrame([], "ref string, action string"), ["NSW", "VIC"])
    assert sorted((r["conref"], r["state"], r["rescued"]) for r in units.collect()) == [("f1", "NSW", False), ("f3", "NSW", True)]
    assert sorted((r["guard"], r["subject"]) for r in bad.collect()) == [("identity", "r4"), ("reference", "r2"), ("state", "f3")]


def test_arguments():
    assert parse_args(["--sections=A,B", "--editions=2025"]) == {"sections": ["A", "B"], "editions": ["2025"]}
    for wrong in (["--x=1"], ["--sections"], ["--sections="], ["--sections=A", "--sections=B"], ["--sections=A,A"], ["sections=A"]):
        with pytest.raises(ValueError):
            parse_args(wrong)


def test_figure_urls(spark):
    cases = {"https://img/a/b/2025/v1/x": None, "https://img/ncd/2025/v1/x%20y.svg": "not five segments", "http://img/a/b/c/d/e": "another host", "https://img/a/b/c/d/e?q": "query or fragment", "https://img/a/b/c/d/%zz": "does not decode"}
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r["u"]: r["p"] for r in df.select("u", urls.figure_parts(F.col("u"), "img")["problem"].alias("p")).collect()} == cases


def test_census(spark):
    u = spark.createDataFrame([("2025", "clause", False), ("2025", "page", True), ("2025", "clause", False)], "edition string, kind string, overview boolean")
    assert census.kind_summary(census.kinds(u)).first()["summary"] == "2 clause, 1 page (overview)"
    f = spark.createDataFrame([("a", "x", "1"), ("b", "x", "1"), ("b", "y", "2")], "package string, name string, content string")
    assert {r["name"]: (r["packages"], r["contents"]) for r in census.package_overlap(f.withColumn("content", F.col("content").cast("binary"))).collect()} == {"x": (2, 1), "y": (1, 1)}
    v = spark.createDataFrame([("k", "nsw", 2), ("k", "vic", 1), ("k", "nsw", 3)], "key string, state string, o int")
    assert census.states_of(v, "key").first()["states"] == ["NSW", "VIC"] and census.facets(v, "key", "state", "o").first()["state"] == "vic, nsw"
    g = spark.createDataFrame([("p", 1, 1), ("q", 2, 1), ("r", 2, 2)], "path string, contents int, classes int")
    assert census.glossary_classes(g).count() == 3
    assert guards.plausible(u).count() == 1 and guards.plausible(u, 2).count() == 0


def test_volumes_are_never_one_string(spark, sf, monkeypatch):
    from quillspark import queries_corpus
    from quillspark.sources import ranges

    class Seen(Exception):
        pass

    def look(pieces, order, **how):
        longest = F.max(F.greatest(*(F.length(c) for c, kind in pieces.dtypes if kind == "string")))
        raise Seen(*pieces.agg(longest, F.count("*"), F.count_distinct("doc_id")).first())

    monkeypatch.setattr(ranges, "shred_pieces", look)
    with pytest.raises(Seen) as e:
        queries_corpus.nation_volumes(spark, sf)
    longest, pieces, volumes = e.value.args
    assert longest < 400 and volumes == 25 and pieces > 40 * volumes
