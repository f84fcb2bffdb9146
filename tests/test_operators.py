from pyspark.sql import functions as F

from quillspark.operators import fold, guards, joins, ordered, render, search, tracked, transcript, tree
from quillspark.plans.build import build
from quillspark.sources.shred import shred

CLASSES = [("volume", "root"), ("section", "root"), ("part", "container"), ("group", "transparent"), ("clause", "unit"), ("p", "prose"), ("title", "metadata"), ("ref", "pointer")]


def nodes(spark, *xml):
    return shred(spark.createDataFrame(list(enumerate(xml)), "id int, xml string"), "id", "xml").cache()


def classed(spark, *xml):
    return tree.with_class(nodes(spark, *xml), spark.createDataFrame(CLASSES, "tag string, class string"))


def test_contexts(spark):
    x = '<volume state="x"><section num="A"><part num="A1"><p>own</p><group><p>deep</p><clause id="c1"><p>t</p></clause></group></part></section><section num="B"><clause id="c2" state="nsw"/></section></volume>'
    c = classed(spark, x)
    got = {r["attrs"].get("id"): r for r in tree.contexts(c).where("class = 'unit'").collect()}
    assert (got["c1"]["state"], got["c1"]["section_num"], got["c1"]["container_num"]) == ("X", "A", "A1")
    assert (got["c2"]["state"], got["c2"]["section_num"], got["c2"]["container_num"]) == ("NSW", "B", None)
    assert tree.own_prose(c).count() == 2
    assert tree.overviews(c).count() == 1
    n = tree.nearest(c, F.col("attrs")["state"], "near").where("tag = 'clause'")
    assert sorted(r["near"] for r in n.collect()) == ["nsw", "x"]
    assert {(r["parent_tag"], r["tag"]): r["n"] for r in tree.containment(c).collect()}[("part", "p")] == 1


def test_tree_guards(spark):
    c = classed(spark, "<volume><odd/>stray<ref>x</ref><p>orphan</p></volume>")
    assert [r["tag"] for r in tree.unknown_tags(c).collect()] == ["odd"]
    assert sorted(r["text"] for r in tree.stray_text(c).collect()) == ["stray", "x"]
    assert tree.pointer_content(c).count() == 1 and [r["tag"] for r in tree.orphan_prose(c).collect()] == ["p"]
    ok = classed(spark, "<volume><section><part><p>x</p></part></section></volume>")
    assert not (tree.unknown_tags(ok).count() + tree.stray_text(ok).count() + tree.pointer_content(ok).count() + tree.orphan_prose(ok).count())


def test_child_text(spark):
    n = nodes(spark, "<clause><title>A <b>bold</b>  one</title><title>second</title></clause>")
    assert tree.child_text(n, "title", "t").first()["t"] == "A bold one"


T = 'xmlns:t="urn:track"'


def base(spark, xml, cycle=2024):
    b = tracked.base_view(nodes(spark, xml), cycle)
    return "".join(r["text"] for r in b.where("tag = '#text'").orderBy("pre").collect()), b


def test_base_view(spark):
    text, _ = base(spark, f'<p {T}>a<insText action="start"/>new<insText action="end"/>b<insText>x</insText><delText>old</delText></p>')
    assert text == "abold"
    text, b = base(spark, f'<d {T}><p t:type="insert" t:dateTime="2024-05-01">draft</p><p t:type="insert" t:dateTime="2022-01-01">kept</p><p t:type="delete" t:dateTime="2021-01-01">gone</p><p t:type="delete" t:dateTime="2025-01-01">later</p></d>')
    # the draft insertion holds bare text outside any insertion range, so it is retained
    assert text == "draftkeptlater" and b.where("retained").count() == 1
    text, b = base(spark, f'<d {T}><p t:type="insert" t:dateTime="2024-05-01"><insText>new words</insText></p><p>x</p></d>')
    assert text == "x" and b.where("retained").count() == 0
    text, b = base(spark, f'<d {T}><u><p t:type="insert" t:dateTime="2024-05-01"><insText>new</insText><delText>earlier</delText></p></u></d>')
    assert text == "earlier" and b.where("retained").count() == 1
    units = nodes(spark, f'<d {T}><u><p t:type="insert" t:dateTime="2024-05-01"><insText>new</insText><delText>earlier</delText></p></u></d>').where("tag in ('d', 'u')")
    assert [r["n"] for r in tracked.retention_counts(b, units).collect()] == [1]


def test_marks(spark):
    n = nodes(spark, f'<d {T}><p t:type="insert" t:dateTime="2023-05-01"/><p t:type="insert"/><p type="ordered"/></d>')
    assert sorted(str(r["year"]) for r in tracked.undated(n, 2024).collect()) == ["2023", "None"]


def test_accepted_text(spark):
    n = nodes(spark, f'<d {T}><p>a<insText>b</insText><delText>c</delText><q t:type="delete" t:dateTime="2025-01-01">d</q></p></d>')
    assert tracked.accepted_text(n, n.where("tag = 'p'"), 2024).first()["accepted"] == "ab"


def test_corrections(spark):
    t = spark.createDataFrame([(1, 1, "the wrng word", True), (1, 2, "wrng again outside", False), (2, 1, "fine", True)], "doc_id int, pre int, text string, retained boolean")
    r = spark.createDataFrame([(1, "wrng word", "wrong word"), (1, "again", "x"), (2, "absent", "y")], "doc_id int, find string, replace string")
    fixed, faults = tracked.corrections(t, r)
    assert {r["text"] for r in fixed.collect()} == {"the wrong word", "wrng again outside", "fine"}
    assert sorted(r["find"] for r in faults.collect()) == ["absent", "again"]


def body(spark, xml, **kw):
    n = nodes(spark, xml).withColumn("unit", F.col("doc_id").cast("string"))
    return render.render(n, "https://img", **kw).first()


def test_render_prose_lists_numbers(spark):
    r = body(spark, '<clause><title>T</title><subclause><num>(1)</num><content><p>One <xref type="glossary">wall</xref> two.</p></content></subclause><ol><li>a<ol><li>x</li><li/></ol></li><li><ul><li>b</li></ul></li></ol><num>2</num></clause>')
    assert r["error"] is None
    assert r["body"] == "**(1)** One wall two.\n\n(a) a\n  (i) x\n(b) b\n\n**(2)**"
    assert r["defined_terms"] == ["wall"] and {w.split(":")[0] for w in r["warnings"]} == {"empty-list-item", "flattened-wrapper-item", "orphan-num"}


def test_render_tables(spark):
    r = body(spark, "<clause><table-reference><num>1</num><title>Sizes</title><table><tr><td colspan='2'>a|b</td></tr><tr><td>c</td><td>d</td></tr><tr><td/><td/></tr></table></table-reference></clause>")
    assert r["body"] == "### Table 1 — Sizes\n\n| a\\|b | a\\|b |\n| --- | --- |\n| c | d |" and r["table_refs"] == ["clause"]
    r = body(spark, "<clause><table><tgroup><colspec colname='c1'/><colspec colname='c2'/><thead><row><entry namest='c1' nameend='c2'>h</entry></row></thead><tbody><row><entry morerows='1'>x</entry><entry>y</entry></row><row><entry>z</entry></row></tbody></tgroup></table></clause>")
    assert r["body"] == "| h | h |\n| --- | --- |\n| x | y |\n| x | z |"
    assert body(spark, "<clause><table><tgroup><colspec colname='c1'/><tbody><row><entry namest='zz'>x</entry></row></tbody></tgroup></table></clause>")["error"]


def test_render_the_rest(spark):
    r = body(spark, '<clause><callout><callout-type info-type="note"/><title>N</title><p>inside</p></callout><callout><title>empty</title></callout><image-reference><num>2</num><title>F</title><image href="a/b (1).svg"/></image-reference><equation-block><math><mfrac><mi>a</mi><msup><mi>b</mi><mn>2</mn></msup></mfrac></math></equation-block><p><b> x </b><a href="https://h/">l</a><i>y</i></p><resources><link href="https://h" title="H"/></resources></clause>')
    assert r["body"].split("\n\n") == ["> **Note — N**\n>\n> inside".split("\n\n")[0], "![Figure 2: F](https://img/b%20%281%29.svg)", "a/(b^2)", "**x** [l](https://h/)*y*", "- [H](https://h)"]
    assert r["figures"] == ["b (1).svg"]
    assert "unknown" in body(spark, "<clause><unknown/></clause>")["error"]


def test_tiers_and_identity(spark):
    a = spark.createDataFrame([(1, "x", "p"), (2, "y", "q"), (3, "z", "r")], "id int, n string, s string")
    b = spark.createDataFrame([("f1", "x", "p"), ("f2", "w", "q"), ("f3", "v", "q")], "f string, n string, s string")
    got = {r["id"]: (r["rule"], r["match"], r["matches"]) for r in joins.tiered(a, b, [(F.col("n"), F.col("n")), (F.col("s"), F.col("s"))], "id", "f").collect()}
    assert got == {1: (1, "f1", 1), 2: (2, "f2", 2), 3: (None, None, None)}
    refs = spark.createDataFrame([("r1", "c1", "a", "a"), ("r2", "c1", "a", "b"), ("r3", "c1", "b", "b"), ("r4", "c9", "z", "z")], "ref string, conref string, id string, title_id string")
    cl = spark.createDataFrame([("c1", "a"), ("c2", "b")], "conref string, id string")
    rul = spark.createDataFrame([("r4", "omit")], "ref string, action string")
    assert {r["ref"]: (r["decision"], r["target"]) for r in joins.identity(refs, cl, rul).collect()} == {"r1": ("agree", "c1"), "r2": ("title-only", "c1"), "r3": ("redirect", "c2"), "r4": ("omit", "c9")}


def test_splice_variations_rescue(spark):
    p = spark.createDataFrame([("s1", "a"), ("s2", "x"), ("s3", "c1")], "start string, target string")
    w = spark.createDataFrame([("a", "b", False), ("b", None, False), ("c1", "c2", False), ("c2", "c1", False)], "node string, points_to string, empty boolean")
    got = {r["start"]: (r["node"], r["state"]) for r in joins.splice(p, w, 6).collect()}
    assert got["s1"] == ("b", "content") and got["s2"][1] == "dangling" and got["s3"][1] == "cyclic"
    h = spark.createDataFrame([("h1", "DELETE", None), ("h2", "REPLACE", "t"), ("h3", "REPLACE", "t"), ("h4", "REPLACE", "no")], "host string, type string, target string")
    m = spark.createDataFrame([("t",)], "unit string")
    assert sorted((r["host"], r["unit"]) for r in joins.variations(h, m).collect()) == [("h1", "h1"), ("h2", "t")]
    hosts = spark.createDataFrame([("h", "C1D2 Walls", "C1D2", "C1D3", "NSW"), ("i", "zz", "zz", "E4F5", "VIC")], "host string, stem string, base_id string, accepted_id string, state string")
    files = spark.createDataFrame([("c1d2-walls_NSW.xml",), ("E4F5-other-VIC.xml",)], "name string")
    assert {r["host"]: (r["rule"], r["match"]) for r in joins.state_files(hosts, files).collect()} == {"h": (1, "c1d2-walls_NSW.xml"), "i": (3, "E4F5-other-VIC.xml")}
    one = spark.createDataFrame([("1", "a")], "k string, v string")
    two = spark.createDataFrame([("1", "b"), ("2", "c")], "k string, v string")
    assert sorted(tuple(r) for r in joins.merge_sources(one, two, ["k"]).collect()) == [("1", "a"), ("2", "c")]
    s = joins.splice(spark.createDataFrame([], "start string, target string"), w, 2)
    assert s.count() == 0


def records(spark, rows):
    return spark.createDataFrame(rows, "path string, kind string, doc string, ord int, content string, prefix string")


def test_uniqueness_fold(spark):
    c = lambda b: f"---\nterm: x\n---\n\n# X\n\n{b}\n"
    r = records(spark, [
        ("one", "clause", "v1", 1, "a", ""), ("same", "clause", "v1", 2, "a", ""), ("same", "clause", "v2", 3, "a", ""), ("clash", "clause", "v1", 4, "a", ""), ("clash", "clause", "v2", 5, "b", ""),
        ("senses", "glossary", "v1", 6, c("one"), ""), ("senses", "glossary", "v1", 7, c("two"), ""), ("figures", "glossary", "v1", 8, c("![](p1/a.png)"), "p1"), ("figures", "glossary", "v2", 9, c("![](p2/a.png)"), "p2"), ("text", "glossary", "v1", 10, c("l"), ""), ("text", "glossary", "v2", 11, c("r"), ""),
    ])
    got = {x["path"]: (x["outcome"], x["canonical"], x["classes"], x["documents"]) for x in fold.resolve_unique(r).collect()}
    assert got["one"][0] == "single" and got["same"] == ("identical", 2, 1, ["v1", "v2"]) and got["clash"][0] == "conflict"
    assert got["senses"][0] == "merged" and got["figures"] == ("folded", 8, 1, ["v1", "v2"]) and got["text"][2] == 2
    m = {x["path"]: (x["senses"], x["body"]) for x in fold.merge_senses(fold.fold_classes(r.where("kind = 'glossary'"))).collect()}
    assert m["figures"] == (1, "![](p1/a.png)") and m["senses"][1] == "## Definition 1 (v1)\n\none\n\n## Definition 2 (v1)\n\ntwo"


def test_links(spark):
    b = "https://code.example/editions/code-2025/adopted/"
    urls = [b + "v1/1-governing", b + "v1/c-fire/c2-fire-resistance", b + "v1/c-fire/part-c2-other-words", b + "v1/9-victoria/vic-part-d3-exits", b + "v1/d-access/vic-d3-exits", b + "v1/d-access/d1", b + "v1", "https://evil.example/x"]
    idx, coll, refused = fold.link_index(spark.createDataFrame([(u,) for u in urls], "url string"), "code[.]example", {"victoria": "vic"})
    got = {r["key"]: r["url"] for r in idx.collect()}
    assert got["v1|1|"] == urls[0] and got["v1|state:vic|d3"] == urls[3] and got["v1|d|d1"] == urls[5]
    assert [r["key"] for r in coll.collect()] == ["v1|c|c2"] and [r["url"] for r in refused.collect()] == [urls[-1]]
    u = spark.createDataFrame([
        (1, "2025", "v1", "clause", "C2D2", None, "C", "Part C2", "Fire resistance", "t"), (2, "2025", "v1", "page", None, None, "C", "C2", "Neither", "t"), (3, "2025", "v1", "clause", "D3D1", "VIC", "D", "D3", "x", "t"),
        (4, "2025", "v1", "clause", "D1D1", None, "", "D1", "x", "t"), (5, "2025", "v9", "page", None, None, "1", "", "x", "Governing"), (6, "2025", "v1", "page", None, None, "1", None, "x", "Governing"),
    ], "unit int, edition string, volume string, kind string, id string, state string, section string, container string, container_title string, title string")
    got = {r["unit"]: r["url"] for r in fold.resolve_links(u, idx, coll, ["vic"]).collect()}
    assert got == {1: urls[1] + "#C2D2", 2: None, 3: urls[3] + "#D3D1", 4: urls[5] + "#D1D1", 5: None, 6: urls[0]}


def test_ordered(spark):
    d = spark.createDataFrame([("a", 1, "num", "(1)"), ("a", 2, "p", "x"), ("a", 3, "num", "(2)"), ("a", 4, "num", "(3)"), ("a", 5, "p", "y")], "k string, o int, kind string, text string")
    assert sorted((r["o"], r["number"], r["orphan"]) for r in ordered.pending_number(d, "k", "o").collect()) == [(2, "(1)", False), (3, "(2)", True), (5, "(3)", False)]
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (1,), (1,)], "k int")
    assert ordered.whole(a, b, "k").first()["whole"] and not ordered.whole(a, b.where("k = 1"), "k").first()["whole"]
    h = spark.createDataFrame([(1, 0, "(a)"), (1, 1, "  (i) x"), (1, 2, "(b)"), (1, 3, "(c) y")], "doc_id int, pos int, line string")
    assert [r["line"] for r in ordered.heading_windows(h).collect()] == ["(b)"]


def test_guards(spark):
    r = spark.createDataFrame([("a",), ("a",), ("b",)], "path string")
    v = guards.unique(r, "path")
    assert [tuple(x) for x in v.collect()] == [("unique", "a", "2 records")]
    try:
        guards.require_none(guards.gathered(v, guards.evidenced(spark.createDataFrame([("e", "short")], "id string, evidence string"))))
        raise AssertionError
    except ValueError as e:
        assert "unique: a" in str(e) and "evidence: e" in str(e)
    guards.require_none(v.where("false"))
    c = spark.createDataFrame([("2025/v/c1d1-x.md", "C1D1", "---\ncitation: C\n---"), ("2025/v/c2.md", "C1D2", "x" * 200_000)], "path string, clause string, content string")
    assert sorted(x["guard"] for x in guards.acceptance(c).collect()) == ["citation near top", "lead token", "size"]
    w = spark.createDataFrame([("2025/glossary/a.md",), ("2025/INDEX.md",), ("2025/v/b.md",)], "path string")
    assert guards.partial_scope(w, "glossary", False).count() == 2 and guards.partial_scope(w, "glossary", True).count() == 0


def test_search(spark):
    c = spark.createDataFrame([("2025/v/c2d2-x.md", "one fire wall\ntwo", "aus", "Class 1a, Class 2"), ("2025/v/c2d20-y.md", "x", "nsw", None)], "path string, content string, jurisdiction string, excluded string")
    assert [r["path"] for r in search.by_designation(c, "C2D2").collect()] == ["2025/v/c2d2-x.md"]
    assert search.phrase(c, "fire wall").first()["lines"] == 1 and search.in_jurisdiction(c, "NSW").count() == 1
    assert [r["x"] for r in c.orderBy("path").select(search.applies_to(F.col("excluded"), "Class 2").alias("x")).collect()] == [False, True]


def test_transcript(spark):
    e = spark.createDataFrame([("s", 1, "agent.message", ["CHECK1 a=1 b=\"x y\"", "noise"], None), ("s", 2, "session.status_idle", [], "requires_action"), ("s", 3, "agent.message", ["* `CHECK1 a=2.`"], None), ("s", 4, "session.status_idle", [], "end_turn")], "session string, ord int, type string, texts array<string>, stop_reason string")
    assert transcript.session_state(e).first()["state"] == "done" and transcript.session_state(e.where("ord < 3")).first()["state"] == "blocked"
    t = transcript.transcript(e)
    r = transcript.result_lines(t).first()
    assert r["fields"] == {"a": "2"} and r["occurrences"] == 2
    checks = spark.createDataFrame([("CHECK1", "a", "2", None, "^noise$"), ("CHECK2", "a", None, None, None)], "id string, field string, expected string, pattern string, evidence string")
    g = transcript.grade(transcript.result_lines(t), t, checks)
    assert {x["id"]: (x["passed"], x["why"]) for x in g.collect()} == {"CHECK1": (True, None), "CHECK2": (False, "no line")}
    assert transcript.verdicts(g).first()["passed"] is False


def test_build_plan(spark):
    units = spark.createDataFrame([
        ("u1", 1, "2025", "v1", "vol1", "clause", "C1D1", None, "Walls", "", "C1.1", "Class 1a", None, None, None, "C", 2), ("u2", 2, "2025", "v1", "vol1", "glossary", None, "Fire", "Fire", None, None, None, None, None, None, "", 0),
        ("u3", 3, "2025", "v2", "vol2", "glossary", None, "Fire", "Fire", None, None, None, None, None, None, "", 0), ("u4", 4, "2025", "v1", "vol1", "page", None, None, "Scope", "NSW", None, None, "part", "C1", "section", "C", 0),
        ("u5", 5, "2025", "v1", "vol1", "clause", "C1D2", None, "Doors", None, None, None, None, None, None, "C", 0),
    ], "unit string, ord int, edition string, doc string, volume string, kind string, id string, term string, title string, state string, supersedes string, building_classes string, containerKind string, containerNum string, sectionType string, section_num string, retained int")
    rendered = spark.createDataFrame([("u1", "Text.", ["wall"], [], None), ("u2", "One sense.", [], [], None), ("u3", "Other sense.", [], [], None), ("u4", "Overview.", [], [], None), ("u5", None, [], [], "<x> in a block position")], "unit string, body string, defined_terms array<string>, warnings array<string>, error string")
    urls = spark.createDataFrame([("u1", "https://h/1")], "unit string, url string")
    docs = spark.createDataFrame([("v1", "Code One", "p1", "One"), ("v2", "Code Two", "p2", "Two")], "doc string, prefix string, figures string, label string")
    rul = spark.createDataFrame([], "volume string, id_ruled string")
    b = build(units, rendered, urls, docs, rul, {"part": "part"})
    files = {r["path"]: r["content"] for r in b.files.collect()}
    assert files["2025/vol1/c1d1-walls.md"] == "---\nclause: C1D1\ntitle: Walls\ncitation: Code One C1D1\nweb_url: https://h/1\nedition: \"2025\"\nvolume: vol1\njurisdiction: aus\nsupersedes: C1.1\nbuilding_classes_excluded: Class 1a\ndefined_terms:\n  - wall\n---\n\n# C1D1 — Walls\n\n> Note: 2 passages are given as in the earlier state.\n\nText.\n"
    assert "## Definition 2 (v2)" in files["2025/glossary/fire.md"] and "2025/vol1/part-c1-nsw-scope.md" in files
    assert sorted((r["guard"], r["subject"]) for r in b.violations.collect()) == [("linked", "u5"), ("rendered", "u5")]
    assert b.producible.count() == 4 and b.stats.where("doc = 'v1' and kind = 'clause'").first()["linked"] == 1
