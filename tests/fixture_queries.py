"""Queries over hand-written inputs of the reference formats; their SQL lists the rows that are expected.

The driver's tables hold no XML units, packages or tracked changes. So each of these runs an operator over
a small fixture stated here, and its SQL is the table of results as worked out by hand from the
format's rules. They are tests, not registered queries: ``test_fixture_queries`` runs them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from quillspark.operators import guards, render, tracked, tree
from quillspark.plans import build as plan
from quillspark.plans import readers
from quillspark.sources.shred import shred

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def values(columns: str, rows: Sequence[Sequence]) -> str:
    """SQL of a table of texts and whole numbers."""
    one = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"{v}::BIGINT" if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) t({columns})"


def _shredded(spark, docs: dict[str, str]):
    return shred(spark.createDataFrame(list(docs.items()), "id string, xml string"), "id", "xml")


# Rendering: name, body of the unit, its Markdown, the kinds of its warnings

UNITS = [
    ("paragraph", "<p>One  <xref type='glossary'>fire wall</xref>\n two.</p>", "One fire wall two.", ""),
    ("number", "<num>(1)</num><p>a</p><p>b</p>", "**(1)** a\n\nb", ""),
    ("orphan number", "<num>1</num><num>(2)</num><p>a</p>", "**(1)**\n\n**(2)** a", "orphan-num"),
    ("transparent", "<content><intro-part><p>a</p></intro-part></content><glossdef><title>Definition</title><p>b</p></glossdef>", "a\n\nb", ""),
    ("subclause", "<subclause variation-type='REPLACE' state='nsw' deleted-text='[deleted]'><title>t</title><p>x</p></subclause>", "**NSW variation (replace)**\n\n[deleted]\n\nx", ""),
    ("empty subclause", "<p>a</p><subclause><num>(3)</num></subclause>", "a", "empty-subclause"),
    ("nothing", "<placeholder>x</placeholder><related-links>y</related-links><clauseref/><p>z</p>", "z", ""),
    ("marks", "<p><b> x </b>and <i>y</i> <sup>2</sup><a href='https://h/'> l </a><a href='#i'>in</a></p>", "**x** and *y* 2 [l](https://h/) in", ""),
    ("list", "<ol><li>a</li><li><p>b</p><p>c</p></li></ol>", "(a) a\n(b) b\n  c", ""),
    ("nested lists", "<ol><li>a<ol><li>x<ol><li>y</li></ol></li><li>z</li></ol></li><li>b<ul><li>u<ol><li>v</li></ol></li></ul></li></ol>", "(a) a\n  (i) x\n    (A) y\n  (ii) z\n(b) b\n  - u\n    (i) v", ""),
    ("empty items", "<ol><li>a</li><li> </li><li><placeholder>p</placeholder></li><li>b</li></ol>", "(a) a\n(b) b", "empty-list-item"),
    ("wrapper items", "<ol><li>a</li><li><ol><li>b</li><li>c</li></ol></li><li>d</li></ol>", "(a) a\n(b) b\n(c) c\n(d) d", "flattened-wrapper-item"),
    ("label above a list", "<ol><li><table><tr><td>t</td></tr></table><ol><li>x</li></ol></li></ol>", "(a)\n\n| t |\n| --- |\n\n  (i) x", ""),
    ("declared styles", "<ol class='upper-roman'><li>a</li></ol><ol class='numbered'><li>b</li><li>c</li></ol><ul><li>d</li></ul>", "(I) a\n(1) b\n(2) c\n- d", ""),
    ("notes are numbered", "<desc-note><ol><li>a</li><li>b</li></ol></desc-note>", "> (1) a\n> (2) b", ""),
    ("section", "<section><title>T</title><h2>T</h2><p>a</p></section><section><h3>S</h3></section>", "## T\n\na\n\n### S", ""),
    ("table", "<table><tr><th>h</th><th>i</th></tr><tr><td>a|b</td><td> c  d </td></tr></table>", "| h | i |\n| --- | --- |\n| a\\|b | c d |", ""),
    ("table with empty first row", "<table><tr><td/><td/></tr><tr><td>a</td><td>b</td></tr><tr><td>c</td><td/></tr></table>", "| a | b |\n| --- | --- |\n| c |  |", "table-empty-rows"),
    ("spans", "<table><tr><td colspan='2'>a</td><td rowspan='2'>b</td></tr><tr><td>c</td><td>d</td></tr></table>", "| a | a | b |\n| --- | --- | --- |\n| c | d | b |", "table-irregular"),
    ("span below the last row", "<table><tr><td rowspan='2'>a</td><td>b</td></tr></table>", "| a | b |\n| --- | --- |\n| a |  |", "table-irregular"),
    ("named columns", "<table><tgroup><colspec colname='x'/><colspec colname='y'/><thead><row><entry namest='x' nameend='y'>h</entry></row><row><entry>i</entry><entry>j</entry></row></thead><tbody><row><entry morerows='1'>a</entry><entry>b</entry></row><row><entry>c</entry></row></tbody></tgroup></table>", "| h | h |\n| --- | --- |\n| i | j |\n| a | b |\n| a | c |", "table-irregular,table-multirow-header"),
    ("table reference", "<table-reference><num>4</num><title>Sizes</title><table><tr><td>a</td></tr></table></table-reference>", "### Table 4 — Sizes\n\n| a |\n| --- |", ""),
    ("empty table reference", "<p>a</p><table-reference><num>4</num><title>Sizes</title></table-reference>", "a", "empty-table-reference"),
    ("figures", "<image-reference><num>2</num><title>F</title><image href='a/b (1).svg'/></image-reference><image href='c.emf'/>", "![Figure 2: F](https://img/b%20%281%29.svg)\n\n[Figure](https://img/c.emf)", ""),
    ("callout", "<callout><callout-type info-type='note'/><title>N</title><p>a</p><p>b</p></callout><callout><title>empty</title></callout>", "> **Note — N**\n>\n> a\n>\n> b", "empty-callout"),
    ("state text", "<subclause-variation state='vic' type='Insert'><title>T</title><p>a</p></subclause-variation>", "**VIC variation (insert) — T**\n\na", ""),
    ("formula", "<equation-block><math><mfrac><mrow><mi>a</mi><mo>+</mo><mi>b</mi></mrow><msup><mi>c</mi><mn>2</mn></msup></mfrac></math></equation-block>", "(a + b)/(c^2)", "mathml-flattened"),
    ("formula parts", "<p><equation-inline><math><msubsup><mi>x</mi><mi>i</mi><mn>2</mn></msubsup><msqrt><mi>y</mi></msqrt><mfenced><mi>p</mi><mi>q</mi></mfenced></math></equation-inline></p>", "x_i^2 √y (p, q)", "mathml-flattened"),
    ("formula table", "<equation-block><mtable><mtr><mtd>a</mtd><mtd>b</mtd></mtr><mtr><mtd>c</mtd></mtr></mtable></equation-block>", "a, b; c", "mathml-flattened"),
    ("the rest", "<notice>n</notice><signage>s</signage><resources><link href='https://h' title='H'/><link href='x' title='X'/></resources><glossAcronym>ABC</glossAcronym>", "n\n\ns\n\n- [H](https://h)\n- X\n\nAcronym: ABC", ""),
]
#: Units that no rule models: name, body, what the error names.
REFUSED = [
    ("unknown element", "<odd/>", "<odd>"), ("item of another kind", "<ol><p>x</p></ol>", "<p> in a list"), ("list class", "<ol class='odd'><li>a</li></ol>", "list class odd"),
    ("foreign cell", "<table><tr><td>a</td><p>lost</p></tr></table>", "<p> in a row"), ("foreign row", "<table><p>lost</p></table>", "<p> in a table"), ("half a span", "<table><tgroup><colspec colname='x'/><tbody><row><entry namest='x'>a</entry></row></tbody></tgroup></table>", "a span over x"),
    ("unknown column", "<table><tgroup><colspec colname='x'/><tbody><row><entry namest='x' nameend='z'>a</entry></row></tbody></tgroup></table>", "a span over x to z"), ("column by name", "<table><tgroup><colspec colname='x'/><tbody><row><entry colname='x'>a</entry></row></tbody></tgroup></table>", "a cell at the column x"),
    ("rows by words", "<table><tgroup><tbody><row><entry morerows='two'>a</entry></row></tbody></tgroup></table>", "morerows=two"), ("content of a pointer", "<callout-type>x</callout-type>", "<callout-type> carries content"),
]


def _rendered(spark, docs: dict[str, str]):
    nodes = _shredded(spark, {k: f"<clause><title>T</title>{v}</clause>" for k, v in docs.items()})
    return render.render(nodes.withColumn("unit", F.col("doc_id")), "https://img")


@query(values("unit, body, warnings", [(n, body, w) for n, _, body, w in UNITS]))
def rendered_units(spark, sf):
    """Units of every kind of element to Markdown, with the kinds of their warnings."""
    r = _rendered(spark, {n: x for n, x, _, _ in UNITS})
    kinds = F.array_sort(F.array_distinct(F.transform("warnings", lambda w: F.substring_index(w, ":", 1))))
    return r.select("unit", "body", F.array_join(kinds, ",").alias("warnings"))


@query(values("unit, found", [("figures", "b (1).svg,c.emf"), ("paragraph", "fire wall"), ("table reference", "clause")]))
def rendered_references(spark, sf):
    """Figures, terms and tables that units refer to."""
    r = _rendered(spark, {n: x for n, x, _, _ in UNITS if n in ("figures", "paragraph", "table reference")})
    return r.select("unit", F.array_join(F.concat("defined_terms", "figures", "table_refs"), ",").alias("found"))


@query(values("unit, named, body", [(n, True, "") for n, _, _ in REFUSED]))
def refused_units(spark, sf):
    """What no rule models is named, and gives no body."""
    r = _rendered(spark, {n: x for n, x, _ in REFUSED})
    what = F.create_map(*(F.lit(x) for n, _, e in REFUSED for x in (n, e)))
    return r.select("unit", F.contains("error", what[F.col("unit")]).alias("named"), F.coalesce("body", F.lit("")).alias("body"))


# Parsing

MARKUP = {"mixed": "<p k='v'>x <a>y</a> z</p>", "broken": "<p>", "entities": "<p>&lt;&amp;</p>", "none": ""}


@query(values("doc_id, pre, post, parent, depth, ord, tag, text, path", [
    ("mixed", 0, 4, -1, 0, 0, "p", "", "0"), ("mixed", 1, 0, 0, 1, 0, "#text", "x ", "0,1"), ("mixed", 2, 2, 0, 1, 1, "a", "", "0,2"), ("mixed", 3, 1, 2, 2, 0, "#text", "y", "0,2,3"), ("mixed", 4, 3, 0, 1, 2, "#text", " z", "0,4"),
    ("broken", 0, 0, -1, 0, 0, "error", "", ""), ("entities", 0, 1, -1, 0, 0, "p", "", "0"), ("entities", 1, 0, 0, 1, 0, "#text", "<&", "0,1"),
]))
def shredded(spark, sf):
    """Documents as node tables; mark-up with a fault gives one row that says so."""
    n = _shredded(spark, MARKUP)
    long = lambda c: F.coalesce(F.col(c), F.lit(-1)).cast("long").alias(c)
    return n.select("doc_id", *map(long, ("pre", "post", "parent", "depth", "ord")), F.when(F.col("error").isNotNull(), "error").otherwise(F.col("tag")).alias("tag"), F.coalesce("text", F.lit("")).alias("text"), F.array_join(F.col("path").cast("array<string>"), ",").alias("path"))


# Tracked changes, cycle 2024: name, mark-up, text of the earlier state, elements retained, accepted text of the root

NS = "xmlns:t='urn:track'"
INS, DEL = "t:type='insert' t:dateTime='{}-05-01'", "t:type='delete' t:dateTime='{}-05-01'"
TRACKED = [
    ("ranges", "a<insText action='start'/>new<insText action='end'/>b", "ab", 0, "anewb"),
    ("unmatched end", "a<insText action='end'/>b<insText action='start'/>c", "ab", 0, "abc"),
    ("containers", "a<insText>new</insText><delText>old</delText>", "aold", 0, "anew"),
    ("earlier insertion", f"<p {INS.format(2022)}>kept</p>", "kept", 0, "kept"),
    ("later insertion of new words", f"<p {INS.format(2024)}><insText>new</insText></p><p>x</p>", "x", 0, "newx"),
    ("later insertion over old words", f"<u><p {INS.format(2024)}><insText>new</insText><delText>earlier</delText></p></u>", "earlier", 1, "new"),
    ("earlier deletion", f"<p {DEL.format(2021)}>gone</p><p>x</p>", "x", 0, "gonex"),
    ("later deletion", f"<p {DEL.format(2025)}>later</p>", "later", 0, ""),
    ("inline words alone don't survive", f"<p {INS.format(2024)}><insText>new</insText><xref>wall</xref></p><p>x</p>", "x", 0, "newwallx"),
    ("nested insertion", f"<s {INS.format(2024)}><p><insText>new</insText></p></s><p>x</p>", "x", 0, "newx"),
]


def _tracked(spark):
    return _shredded(spark, {n: f"<d {NS}>{x}</d>" for n, x, *_ in TRACKED})


@query(values("doc_id, base, retained, accepted", [(n, base, k, acc) for n, _, base, k, acc in TRACKED]))
def base_views(spark, sf):
    """The earlier state of texts with tracked changes, what is retained in it, and the later state."""
    n = _tracked(spark)
    b = tracked.base_view(n, 2024)
    text = b.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("tag") == "#text", F.struct("pre", "text")))), lambda s: s["text"]), "").alias("base"), F.count_if("retained").alias("retained"))
    later = tracked.accepted_text(n, n.where("depth = 0"), 2024).select("doc_id", "accepted")
    return text.join(later, "doc_id", "left").withColumn("accepted", F.coalesce("accepted", F.lit("")))


@query(values("doc_id, tag, year", [("a", "p", 2023), ("a", "q", -1)]))
def undated_marks(spark, sf):
    """Marks without a year, or of the year between the states."""
    n = _shredded(spark, {"a": f"<d {NS}><p {INS.format(2023)}/><q t:type='insert'/><r type='ordered'/><s {DEL.format(2021)}/></d>"})
    return tracked.undated(n, 2024).select("doc_id", "tag", F.coalesce("year", F.lit(-1)).cast("long").alias("year"))


# Readers

CLASSES = [("volume", "root", None), ("section", "root", None), ("part", "container", None), ("specification", "container", None), ("clause", "unit", "clause"), ("clause-variation", "unit", "clause"), ("glossentry", "unit", "glossary"), ("subtopic", "transparent", None), ("p", "prose", None), *((t, "metadata", None) for t in ("title", "sptc", "glossterm", "archive-num"))]
VOLUME = """<volume state='x'><section num='C' summary='What C is about.'><title>Fire</title><part num='C2'><title>Walls <b>and</b> doors</title><p>Overview.</p><subtopic><clause building='Class 1a'><sptc>C2D1</sptc><title>Walls</title><archive-num>C1.1</archive-num>
<clause-variation state='nsw'><sptc>C2D1</sptc><title>Walls here</title></clause-variation></clause></subtopic><clause state='vic'><sptc>C2D2</sptc><title>Doors</title><archive-num><placeholder>none</placeholder></archive-num></clause></part></section>
<section num='S'><specification num='S1' state='qld'><title>Tests</title><clause><sptc>S1C1</sptc><title>Scope</title></clause></specification></section><glossentry category='symbols'><glossterm>m</glossterm></glossentry><glossentry><glossterm>wall</glossterm></glossentry></volume>"""


@query(values("n, kind, overview, id, title, state, section, container, container_title, supersedes, building, category", [
    (1, "page", True, "", "Fire", "X", "C", "", "", "", "", ""), (2, "page", True, "", "Walls and doors", "X", "C", "C2", "Walls and doors", "", "", ""), (3, "clause", False, "C2D1", "Walls", "X", "C", "C2", "Walls and doors", "C1.1", "Class 1a", ""),
    (4, "clause", False, "C2D1", "Walls here", "NSW", "C", "C2", "Walls and doors", "", "", ""), (5, "clause", False, "C2D2", "Doors", "VIC", "C", "C2", "Walls and doors", "", "", ""), (6, "clause", False, "S1C1", "Scope", "QLD", "S", "S1", "Tests", "", "", ""),
    (7, "glossary", False, "", "m", "X", "", "", "", "", "", "symbols"), (8, "glossary", False, "", "wall", "X", "", "", "", "", "", "glossary"),
]))
def read_volume(spark, sf):
    """Units of a monolithic document, overviews and section abstracts among them."""
    from pyspark.sql import Window

    u = readers.read_document(_shredded(spark, {"d": VOLUME}), spark.createDataFrame(CLASSES, "tag string, class string, kind string"), "2025", "one")
    e = lambda c, name: F.coalesce(F.col(c), F.lit("")).alias(name)
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("unit_ord")).cast("long")
    return u.select(n.alias("n"), "kind", "overview", e("id", "id"), "title", e("state", "state"), e("section_num", "section"), e("container_num", "container"), e("container_title", "container_title"), e("supersedes", "supersedes"), e("building_classes", "building"), e("category", "category"))


PACKAGE = {
    "map.xml": "<map><topicset section-num='C'><part><clauseref conref='f1.xml' id='a'><title id='a'/></clauseref><clauseref conref='f2.xml' id='wrong'><title id='b'/></clauseref><clauseref conref='gone.xml' id='z'><title id='z'/></clauseref><clauseref conref='ERROR_IN:q' id='q'><title id='q'/></clauseref></part></topicset><topicset section-num='D'><clauseref conref='f3.xml' id='c'><title id='c'/></clauseref></topicset></map>",
    "f1.xml": f"<clause {NS} id='a'><sptc>C1D1</sptc><title>Walls</title><p {INS.format(2024)}><insText>later</insText></p><clause-variation variation='nsw' variation-type='REPLACE' target='f1-nsw.xml'/><clause-variation variation='vic' variation-type='DELETE' deleted-text='[deleted]'/></clause>",
    "f1-nsw.xml": "<clause id='a1' variation='nsw'><sptc>C1D1</sptc><title>Walls here</title></clause>",
    "f2.xml": "<clause id='b'><sptc>C1D2</sptc><title>Doors</title></clause>",
    "f3.xml": f"<clause {NS} id='c'><sptc><delText>D1D1</delText><insText>D1D9</insText></sptc><title>Lifts</title></clause>",
    "f4.xml": f"<clause {NS} id='d'><sptc><insText>D1D2</insText></sptc><title>Draft</title></clause>",
    "f5_VIC.xml": "<clause id='e'><sptc>D1D3</sptc><title>Lost</title></clause>",
    "f6_NSW.xml": "<clause id='h' variation='vic'><sptc><insText>E1D1</insText></sptc><title>Odd</title></clause>",
    "g1.xml": "<glossentry id='g' category='terms'><glossterm>wall</glossterm></glossentry>",
}


@query(values("file, base_id, accepted_id, term, title, state", [
    ("f1-nsw.xml", "C1D1", "C1D1", "", "Walls here", "NSW"), ("f1.xml", "C1D1", "C1D1", "", "Walls", ""), ("f2.xml", "C1D2", "C1D2", "", "Doors", ""), ("f3.xml", "D1D1", "D1D9", "", "Lifts", ""), ("f4.xml", "", "D1D2", "", "Draft", ""), ("f5_VIC.xml", "D1D3", "D1D3", "", "Lost", "VIC"), ("f6_NSW.xml", "", "E1D1", "", "Odd", "VIC"), ("g1.xml", "", "", "wall", "", ""),
]))
def package_facts(spark, sf):
    """What the files of a package say of themselves, in the earlier and the later state."""
    f = readers.package_files(_shredded(spark, PACKAGE), 2024, ["NSW", "VIC"]).where("root <> 'map'")
    e = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return f.select("file", e("base_id"), e("accepted_id"), e("term"), e("title"), e("state"))


@query(values("unit, kind, id, title, state, section, how", [
    ("f1.xml", "clause", "C1D1", "Walls", "", "C", "mapped"), ("f1-nsw.xml", "clause", "C1D1", "Walls here", "NSW", "C", "variation"), ("f1.xml#VIC", "clause", "C1D1", "Walls", "VIC", "C", "variation"), ("f3.xml", "clause", "D1D1", "Lifts", "", "D", "mapped"), ("f2.xml", "clause", "C1D2", "Doors", "", "C", "mapped"),
    ("f5_VIC.xml", "clause", "D1D3", "Lost", "VIC", "", "rescued"), ("g1.xml", "glossary", "", "wall", "", "", "rescued"),
]))
def package_units(spark, sf):
    """Units of a package from its map, its variations and what the map never reaches."""
    units, _ = _package(spark)
    e = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return units.select("unit", "kind", e("id"), e("title"), e("state"), e("section"), "how")


@query(values("guard, subject", [("reference", "3"), ("state", "f6_NSW.xml")]))
def package_faults(spark, sf):
    """References to no file, and states that a name and an attribute tell differently; an identity ruled on is no fault."""
    _, bad = _package(spark)
    return bad.select("guard", "subject")


def _package(spark):
    rulings = spark.createDataFrame([("2", "keep")], "ref string, action string")
    return readers.read_package_files(_shredded(spark, PACKAGE), 2024, rulings, ["NSW", "VIC"], tolerated="ERROR_IN")


# The build

BUILD_UNITS = [
    ("u1", 1, "2025", "v1", "vol1", "clause", "C1D1", None, "Walls", "", "C1.1", "Class 1a", None, None, None, "C", 2), ("u2", 2, "2025", "v1", "vol1", "glossary", None, "Fire", "Fire", None, None, None, None, None, None, "", 1),
    ("u3", 3, "2025", "v2", "vol2", "glossary", None, "Fire", "Fire", None, None, None, None, None, None, "", 0), ("u4", 4, "2025", "v1", "vol1", "page", None, None, "Scope", "NSW", None, None, "part", "C1", "section", "C", 0),
    ("u5", 5, "2025", "v1", "vol1", "clause", "C1D2", None, "Doors", None, None, None, None, None, None, "C", 0), ("u6", 6, "2025", "v2", "vol2", "glossary", None, "Wall", "Wall", None, None, None, None, None, None, "", 0), ("u7", 7, "2025", "v1", "vol1", "glossary", None, "Wall", "Wall", None, None, None, None, None, None, "", 0),
]
BUILD_BODIES = [("u1", "Text.", ["wall"], [], [], None), ("u2", "One ![](p1/a.svg) sense.", ["fire"], ["a.svg"], [], None), ("u3", "Other sense.", ["wall", "fire"], [], ["table-irregular: x"], None), ("u4", "Overview.", [], [], [], None), ("u5", None, [], [], [], "<x> in a block position"), ("u6", "Same ![](p2/b.svg).", [], ["b.svg"], [], None), ("u7", "Same ![](p1/b.svg).", [], ["b.svg"], [], None)]


def _build(spark):
    units = spark.createDataFrame(BUILD_UNITS, "unit string, ord int, edition string, doc string, volume string, kind string, id string, term string, title string, state string, supersedes string, building_classes string, containerKind string, containerNum string, sectionType string, section_num string, retained int")
    rendered = spark.createDataFrame(BUILD_BODIES, "unit string, body string, defined_terms array<string>, figures array<string>, warnings array<string>, error string").withColumnRenamed("figures", "shown")
    urls = spark.createDataFrame([("u1", "https://h/1")], "unit string, url string")
    docs = spark.createDataFrame([("v1", "Code One", "p1", "One"), ("v2", "Code Two", "p2", "Two")], "doc string, prefix string, figures string, label string")
    return plan.build(units, rendered, urls, docs, spark.createDataFrame([], "volume string, id_ruled string"), {"part": "part"})


@query(values("path, content", [
    ("2025/vol1/c1d1-walls.md", '---\nclause: C1D1\ntitle: Walls\ncitation: Code One C1D1\nweb_url: https://h/1\nedition: "2025"\nvolume: vol1\njurisdiction: aus\nsupersedes: C1.1\nbuilding_classes_excluded: Class 1a\ndefined_terms:\n  - wall\n---\n\n# C1D1 — Walls\n\n> Note: 2 passages are given as in the earlier state.\n\nText.\n'),
    ("2025/vol1/c1d2-doors.md", '---\nclause: C1D2\ntitle: Doors\ncitation: Code One C1D2\nedition: "2025"\nvolume: vol1\njurisdiction: aus\n---\n\n# C1D2 — Doors\n'),
    ("2025/vol1/part-c1-nsw-scope.md", '---\ntitle: Scope\ncitation: Code One Scope (NSW)\nedition: "2025"\nvolume: vol1\njurisdiction: nsw\n---\n\n# Scope\n\nOverview.\n'),
    ("2025/glossary/fire.md", '---\nterm: Fire\ntitle: Fire\ncitation: "Code One Glossary: Fire"\nedition: "2025"\nsources: [vol1, vol2]\njurisdiction: aus\ndefined_terms:\n  - fire\n  - wall\n---\n\n# Fire\n\n> Note: 1 passage is given as in the earlier state.\n\n## Definition 1 (v1)\n\nOne ![](p1/a.svg) sense.\n\n## Definition 2 (v2)\n\nOther sense.\n'),
    ("2025/glossary/wall.md", '---\nterm: Wall\ntitle: Wall\ncitation: "Code Two Glossary: Wall"\nedition: "2025"\nsources: [vol2, vol1]\njurisdiction: aus\n---\n\n# Wall\n\nSame ![](p2/b.svg).\n'),
]))
def built_files(spark, sf):
    """Files of a build, glossary entries folded over documents."""
    return _build(spark).files


@query(values("what, subject, n", [("violation", "linked: u5", 1), ("violation", "rendered: u5", 1), ("stats", "v1 clause", 2), ("stats", "v1 page", 1), ("stats", "v1 glossary", 2), ("stats", "v2 glossary", 2), ("warnings", "v2 glossary", 1), ("producible", "paths", 5)]))
def build_facts(spark, sf):
    """Violations, counts and producible paths of a build."""
    b = _build(spark)
    one = F.lit(1).cast("long")
    v = b.violations.select(F.lit("violation").alias("what"), F.concat_ws(": ", "guard", "subject").alias("subject"), one.alias("n"))
    s = b.stats.select(F.lit("stats").alias("what"), F.concat_ws(" ", "doc", "kind").alias("subject"), F.col("units").alias("n"))
    w = b.stats.where("warnings > 0").select(F.lit("warnings").alias("what"), F.concat_ws(" ", "doc", "kind").alias("subject"), F.col("warnings").cast("long").alias("n"))
    return v.unionByName(s).unionByName(w).unionByName(b.producible.agg(F.count(F.lit(1)).alias("n")).select(F.lit("producible").alias("what"), F.lit("paths").alias("subject"), "n"))


# Acceptance of files: name, content, lines of the body that are labels without a requirement

LABELS = [
    ("lists", "---\na: b\n---\n(a)\n  (i) x\n(b) y\n(c)\n(d) z\n-", ["(c)", "-"]), ("numbers", "**(1)**\n\ntext\n\n**(2)**\n\n**(3)**\n\n## Head", ["**(2)**", "**(3)**"]),
    ("quotes", "> **Note**\n\ntext\n\n> **Note**\n>\n> text\n\n> (a)\n>   (i) x", ["> **Note**"]), ("deeper below blank", "(a)\n\n  text\n\n(b)\n\n| t |", ["(b)"]),
]


@query(values("path, label", [(n, x) for n, _, bad in LABELS for x in bad]))
def bare_labels(spark, sf):
    """C13 (7): labels with nothing under them."""
    c = spark.createDataFrame([(n, x) for n, x, _ in LABELS], "path string, content string")
    return guards.bare_labels(c).select(F.col("subject").alias("path"), F.regexp_replace("detail", r"(?s)\Aline [0-9]+ of the body: ", "").alias("label"))


NOTED = [("good", "# T\n\nNOTE: kept.\n\ntext"), ("twice", "# T\n\nNOTE: a\n\nNOTE: b\n\n"), ("above", "NOTE: a\n\n# T"), ("glued", "# T\n\nNOTE: a\ntext"), ("unlisted", "# T\n\nNOTE: a\n\n"), ("plain", "# T\n\ntext")]


@query(values("subject, detail", [("twice", "2 times"), ("above", "not a paragraph below the heading"), ("glued", "not a paragraph below the heading"), ("unlisted", "unlisted"), ("absent", "dead")]))
def caveats(spark, sf):
    """C13 (9), U8: notes of retained text that aren't one paragraph below the heading, or that the index doesn't list."""
    listed = spark.createDataFrame([("good",), ("twice",), ("above",), ("glued",), ("absent",)], "path string")
    return guards.caveats(spark.createDataFrame(NOTED, "path string, content string"), "NOTE:", listed).select("subject", "detail")


@query(values("guard, n", [("address near top", 1), ("bare label", 1), ("caveat and index", 1), ("cited figure", 1), ("phrase", 1), ("size", 1), ("wrong hit", 1)]))
def acceptance(spark, sf):
    """All nine checks of a finished corpus in one table."""
    head = "---\ncitation: C\nweb_url: https://h\n---\n\n# T\n\n"
    rows = [("e/v/c1d1-x.md", "C1D1", "v", "aus", head + "see Figure H1.\n\n(a)\n"), ("e/v/c1d2-y.md", "C1D2", "v", "aus", "---\ncitation: C\n---\n\n# T\n\n" + "x" * 300), ("e/v/c1d1-z.md", None, "v", "aus", head + "words here")]
    c = spark.createDataFrame(rows, "path string, clause string, volume string, jurisdiction string, content string")
    none = spark.createDataFrame([], "path string")
    v = guards.acceptance_pack(c, ["words here", "other words"], none, "NOTE:", spark.createDataFrame([("e/v/q.md",)], "path string"), True, 256)
    return v.groupBy("guard").agg(F.count(F.lit(1)).alias("n"))


@query(values("doc_id, tag, parent_tag, n", [("-", "b", "p", 2), ("-", "p", "d", 1)]))
def containment_fixture(spark, sf):
    """How often a tag stands in a parent tag."""
    c = tree.containment(_shredded(spark, {"x": "<d><p><b/>t<b/></p></d>"})).where("parent_tag is not null")
    return c.select(F.lit("-").alias("doc_id"), "tag", "parent_tag", "n")
