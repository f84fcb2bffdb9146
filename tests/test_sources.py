import io
import json
import zipfile

from pyspark.sql import functions as F

from quillspark.sources import frontier, paged, shred, sinks, tables


def archive(*entries, method=zipfile.ZIP_DEFLATED):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w", method) as z:
        for name, data in entries:
            z.writestr(name, data)
    return b.getvalue()


def test_unzip_and_refusals(spark):
    good = archive(("a/b.xml", "<x/>"), ("a/", ""), ("..name", "ok"))
    odd = archive(("../up", "x"), ("/abs", "y"))
    lzma = archive(("c", "x" * 99), method=zipfile.ZIP_LZMA)
    broken = bytearray(archive(("d", "hello")))
    broken[broken.index(b"\xcbH") + 2] ^= 16
    df = spark.createDataFrame([("good", bytearray(good)), ("odd", bytearray(odd)), ("lzma", bytearray(lzma)), ("none", bytearray(b"no zip")), ("broken", broken)], "path string, content binary")
    got = {(r["path"], r["name"]): (r["data"] and bytes(r["data"]), r["error"]) for r in tables.unzip(df).collect()}
    assert got[("good", "a/b.xml")] == (b"<x/>", None) and got[("good", "..name")] == (b"ok", None) and ("good", "a/") not in got
    assert got[("odd", "../up")][1] and got[("odd", "/abs")] == (None, "escapes its folder")
    assert "method" in got[("lzma", "c")][1] and "header" in got[("none", None)][1] and got[("broken", "d")][1]


def test_checksums_and_currency(spark):
    import hashlib

    df = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b"2"))], "name string, content binary")
    sums = spark.createDataFrame([("a", hashlib.sha256(b"1").hexdigest()), ("b", "0" * 64)], "name string, sha256 string")
    v = tables.verified(df, sums)
    assert {r["name"]: r["ok"] for r in v.collect()} == {"a": True, "b": False}
    done = spark.createDataFrame([(hashlib.sha256(b"1").hexdigest(),)], "sha256 string")
    assert [r["name"] for r in tables.stale(v.drop("sha256"), done).collect()] == ["b"]


def test_xml_keeps_mixed_content_in_order(spark):
    df = spark.createDataFrame([(1, "<p>x <a k='v'>y</a> z</p>"), (2, "<p>"), (3, None), (4, "")], "id int, xml string")
    rows = shred.shred(df, "id", "xml").orderBy("doc_id", "pre").collect()
    assert [(r["tag"], r["text"], r["depth"], r["ord"], r["parent"]) for r in rows if r["doc_id"] == 1] == [("p", None, 0, 0, None), ("#text", "x ", 1, 0, 0), ("a", None, 1, 1, 0), ("#text", "y", 2, 0, 2), ("#text", " z", 1, 2, 0)]
    assert [r["error"] is not None for r in rows if r["doc_id"] == 2] == [True]
    assert not [r for r in rows if r["doc_id"] > 2]


def test_html_is_tolerant(spark):
    df = spark.createDataFrame([(1, "<div><p>a<p>b<br>c<script>'</p>'</script></div> tail")], "id int, html string")
    tags = [r["tag"] for r in shred.shred(df, "id", "html", "html").orderBy("pre").collect()]
    assert tags.count("p") == 2 and "br" in tags


def test_links_crawl_images(spark):
    p = spark.createDataFrame([(1, '<a href="http://h/x/#a"></a><a href="http://h/x?q"></a><a href="http://g/y">')], "page_id int, html string")
    assert sorted(r["link"] for r in tables.links(p).collect()) == ["http://g/y", "http://h/x"]
    assert [r["link"] for r in tables.links(p, "http://h/").collect()] == ["http://h/x"]
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("b", "a")], "src string, dst string")
    s = spark.createDataFrame([("a",)], "node string")
    assert {r["node"]: r["depth"] for r in frontier.crawl(e, s, 2).collect()} == {"a": 0, "b": 1, "c": 2}
    f = spark.createDataFrame([("v1", "v1/Images/a.png"), ("v2", "v2/XMLs/a.xml"), ("v3", "v3/images/a.png"), ("v3", "v3/IMAGES/b.png")], "doc string, path string")
    assert {r["doc"]: r["state"] for r in tables.images(f).collect()} == {"v1": "listed", "v2": "absent", "v3": "ambiguous"}


def test_markdown_round_trip(spark, tmp_path):
    from quillspark.functions import yamlish

    c = yamlish.document(yamlish.front_matter({"clause": F.lit("C1D1"), "title": F.lit("yes"), "sources": F.array(F.lit("Vol, one"), F.lit("two")), "defined_terms": F.array(F.lit("fire: wall"), F.lit("b"))}), F.lit("C1D1 — yes"), F.lit(None).cast("string"), F.lit("Body one.\n\nBody two."))
    df = spark.range(1).select(F.lit("2025/v/c1d1.md").alias("path"), c.alias("content"))
    assert df.first()["content"] == '---\nclause: C1D1\ntitle: "yes"\nsources: ["Vol, one", two]\ndefined_terms:\n  - "fire: wall"\n  - b\n---\n\n# C1D1 — yes\n\nBody one.\n\nBody two.\n'
    r = tables.markdown(df).first()
    assert r["keys"]["title"] == "yes" and r["defined_terms"] == ["fire: wall", "b"] and r["h1"] == "C1D1 — yes" and r["body"] == "Body one.\n\nBody two."
    assert sinks.write_files(df, str(tmp_path)).collect()[0]["bytes"] == len(df.first()["content"].encode())
    assert (tmp_path / "2025/v/c1d1.md").read_text() == df.first()["content"]


def test_reports_and_redaction(spark):
    m = spark.createDataFrame([("u2", ["b", "a"]), ("u1", ["c"])], "url string, referenced_by array<string>")
    got = json.loads(sinks.report(m, year=F.lit(2025)).first()["report"])
    assert got["count"] == 2 and got["missing"][0]["url"] == "u1" and got["missing"][1]["referenced_by"] == ["a", "b"]
    rows = sinks.run_report(("kinds", spark.createDataFrame([("x", 2)], "k string, n long")), ("none", spark.createDataFrame([], "k string, n long"))).collect()
    assert sorted((r["block"], r["key"], r["n"]) for r in rows if r["key"]) == [("kinds", "x", 2)] and ("none", None, 0) in [tuple(r) for r in rows]
    t = spark.range(1).select(tables.redact(F.lit('{"a":{"api_key":"s\\"x","b":"keep"},"token": "t"}')).alias("x")).first()["x"]
    assert json.loads(t) == {"a": {"api_key": "[redacted]", "b": "keep"}, "token": "[redacted]"}
    i = spark.createDataFrame([("B", None, "b.md"), ("A", "nsw", "a2.md"), ("A", None, "a1.md")], "label string, state string, path string")
    assert sinks.index_text(i, "T").first()["content"] == "# T\n\n- [A](a1.md)\n- [A (NSW)](a2.md)\n- [B](b.md)\n"


def test_paged_source(spark, tmp_path):
    (tmp_path / "0.json").write_text(json.dumps({"data": [{"id": 1, "type": "a"}], "next_page": "1"}))
    (tmp_path / "1.json").write_text(json.dumps({"data": [{"id": 2, "type": "b"}], "next_page": None}))
    spark.dataSource.register(paged.PagedSource)
    got = spark.read.format("paged").option("path", str(tmp_path)).load()
    assert [(r["id"], r["type"]) for r in got.orderBy("id").collect()] == [("1", "a"), ("2", "b")]
    try:
        list(paged.read_pages(lambda c: {"data": [], "next_page": "x"}, 3))
        raise AssertionError
    except RuntimeError:
        pass
