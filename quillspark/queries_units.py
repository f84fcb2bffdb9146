"""Queries that derive units, references, trees and files from the driver's tables, each with DuckDB SQL for the same rows.

They register with ``quillspark.queries``. Literal keys stand for designations, sources and languages
for documents and jurisdictions; the SQL states the derivation in its own words.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.functions import labels as lab
from quillspark.functions import text as tx
from quillspark.functions import urls as ur
from quillspark.functions import yamlish as ym
from quillspark.operators import census, fold, guards, joins, ordered, search, tracked, transcript, tree
from quillspark.queries import CAPPED, SLUG, query
from quillspark.sources import sinks, tables
from quillspark.sources.tables import table
from quillspark.streaming import sessions


def _cat(*parts):
    return F.concat(*(p if not isinstance(p, (str, int)) else F.lit(str(p)) for p in parts))


def _c(name: str):
    return F.col(name).cast("string")


# Names, paths, texts

UNIT_NAMES = f"""
WITH d AS (SELECT doc_id, ['clause', 'glossary', 'page'][(doc_id % 3 + 1)::INT] AS kind, CASE WHEN doc_id % 4 = 0 THEN lang ELSE '' END AS state, CASE WHEN doc_id % 2 = 0 THEN 'Part C' || (doc_id % 9) ELSE '' END AS num, string_split(text, chr(10))[1] AS title, source FROM documents),
s AS (SELECT *, {SLUG.replace("string_split(text, chr(10))[1]", "title")} AS slug FROM d),
n AS (SELECT *, {CAPPED} AS cap, CASE WHEN state = '' THEN '' ELSE '-' || state END AS st FROM s),
f AS (SELECT *, CASE kind
  WHEN 'clause' THEN 'c' || (doc_id % 90) || '.' || (doc_id % 7) || 'd' || st || CASE WHEN cap = '' THEN '' ELSE '-' || cap END
  WHEN 'glossary' THEN CASE WHEN slug = '' OR regexp_matches(title, '[^\\x00-\\x7F]') THEN CASE WHEN cap = '' THEN 'term' ELSE cap END || '-' || left(sha1(trim(title)), 8) ELSE cap END || st
  ELSE CASE WHEN num = '' THEN 'page' ELSE 'part-c' || (doc_id % 9) END || st || CASE WHEN cap = '' THEN '' ELSE '-' || cap END END || '.md' AS name FROM n)
SELECT doc_id, name, '2025/' || CASE WHEN kind = 'glossary' THEN 'glossary' ELSE source END || '/' || name AS path FROM f"""


@query(UNIT_NAMES)
def unit_names(spark, sf):
    """File names and paths of units of all kinds; terms beyond ASCII carry a digest."""
    k = F.col("doc_id")
    d = table(spark, sf, "documents").select(
        "doc_id", F.get(F.array(*map(F.lit, ("clause", "glossary", "page"))), (k % 3).cast("int")).alias("kind"), _cat("C", (k % 90).cast("string"), ".", (k % 7).cast("string"), "D").alias("id"), F.split("text", "\n")[0].alias("title"),
        F.when(k % 4 == 0, F.col("lang")).alias("state"), F.when(k % 2 == 0, "part").alias("containerKind"), F.when(k % 2 == 0, _cat("Part C", (k % 9).cast("string"))).alias("containerNum"), F.lit("section").alias("sectionType"), "source",
    )
    cols = {c: F.col(c) for c in ("kind", "id", "title", "state", "containerKind", "containerNum", "sectionType")} | {"term": F.col("title")}
    name = tx.unit_filename(cols, {"part": "part"})
    return d.select("doc_id", name.alias("name"), tx.unit_path(F.lit("2025"), F.col("kind"), F.col("source"), name).alias("path"))


@query("""
SELECT p_partkey, lower(p_brand) || '-c' || p_size || '-x' AS stem, 'part' AS local, CASE p_size % 3 WHEN 0 THEN 'section' WHEN 1 THEN 'schedule' ELSE 'other' END AS section,
  CASE p_size % 4 WHEN 0 THEN 'NSW' WHEN 1 THEN 'VIC' ELSE '-' END AS state, CASE WHEN p_size % 5 = 0 THEN -1 ELSE 1990 + p_size END AS year, '(' || p_size || ')' AS number, '**' || p_type AS odd, p_type AS value, p_size IN (1, 2, 3) AS unsafe
FROM (SELECT * REPLACE (replace(p_brand, '#', '-') AS p_brand) FROM part)""")
def text_functions(spark, sf):
    """F14, F15, F21, N4, T14, T15, T18, P12, editYear: stems, local names, sections, states, years, numbers, values and unsafe paths."""
    n, b = F.col("p_size"), F.replace("p_brand", F.lit("#"), F.lit("-"))
    name = _cat(b, ".C", _c("p_size"), "_X.xml")
    of = F.when(n % 3 == 0, "Section A").when(n % 3 == 1, "schedule 1").otherwise("Sectional")
    with_state = _cat("C1 Walls", F.when(n % 4 == 0, "_nsw").when(n % 4 == 1, "-VIC").when(n % 4 == 2, "-QQ").otherwise("vic"), ".xml")
    date = F.when(n % 5 == 0, "unknown").otherwise(_cat((n + 1990).cast("string"), "-05-01T00:00"))
    path = F.when(n == 1, "a/../b").when(n == 2, "/abs").when(n == 3, "").otherwise("..name/b")
    return table(spark, sf, "part").select(
        "p_partkey", tx.stem(name).alias("stem"), tx.local_name(F.when(n % 2 == 0, "xt:part").otherwise("part")).alias("local"), tx.section_kind(of).alias("section"), F.coalesce(tx.filename_state(with_state, ["NSW", "VIC"]), F.lit("-")).alias("state"),
        F.coalesce(tx.edit_year(date), F.lit(-1)).alias("year"), lab.number_prefix(F.when(n % 2 == 0, _cat("(", _c("p_size"), ") ")).otherwise(_c("p_size"))).alias("number"), _cat("**", tx.unwrap(_cat("- `", F.col("p_type"), "`"))).alias("odd"),
        tx.clean_value(_cat("*", F.col("p_type"), ".,")).alias("value"), tx.unsafe_segment(path).alias("unsafe"),
    )


@query("""
WITH w AS (SELECT doc_id, list_filter(string_split(string_split(text, chr(10))[1], ' '), lambda x: x <> '') AS ws FROM documents)
SELECT doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(strip_accents(array_to_string(ws, ' '))), '[^a-z0-9]+'), lambda x: x <> ''))) AS words, len(ws)::BIGINT AS n FROM w""")
def title_words(spark, sf):
    """the word set of a title, and its words wrapped and counted again."""
    title = F.split("text", "\n")[0]
    wrapped = tx.wrap(title, 40, "  ")
    n = F.size(F.filter(F.split(wrapped, "[ \n]+"), lambda w: w != ""))
    return table(spark, sf, "documents").select("doc_id", F.array_sort(tx.title_words(title)).alias("words"), n.cast("long").alias("n"))


@query("""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split(string_split(text, chr(10))[1], ' '), lambda x: x <> '') AS ws FROM documents),
r AS (SELECT doc_id, ws, 1 AS i, ws[1] AS line, '' AS done FROM w WHERE len(ws) > 0
  UNION ALL SELECT doc_id, ws, i + 1, CASE WHEN length(line) + 1 + length(ws[i + 1]) + 2 <= 60 THEN line || ' ' || ws[i + 1] ELSE ws[i + 1] END, CASE WHEN length(line) + 1 + length(ws[i + 1]) + 2 <= 60 THEN done ELSE done || '  ' || line || chr(10) END FROM r WHERE i < len(ws))
SELECT doc_id, md5(done || '  ' || line) AS wrapped FROM r WHERE i = len(ws)""")
def wrapped_titles(spark, sf):
    """first lines filled greedily into lines of 60 characters."""
    d = table(spark, sf, "documents").withColumn("t", F.split("text", "\n")[0]).where("trim(t) <> ''")
    return d.select("doc_id", F.md5(tx.wrap(F.col("t"), 60, "  ")).alias("wrapped"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'h1d' || p_size || 'a' ELSE '10.' || p_size END AS key, CASE p_size % 4 WHEN 0 THEN p_brand WHEN 1 THEN 'one, ' || p_brand ELSE '' END AS sources,
  CASE p_size % 4 WHEN 2 THEN 'named twice' WHEN 3 THEN 'no source' ELSE '' END AS problem FROM part""")
def figure_keys(spark, sf):
    """designations of figures from captions and prose; sources of entries and what is wrong with them."""
    n = F.col("p_size")
    raw = F.when(n % 2 == 0, _cat("H1D", _c("p_size"), "a (explanatory): Footing ", F.col("p_type"))).when(n % 3 == 0, _cat("NT 10.", _c("p_size"), " Explanatory")).otherwise(_cat("10.", _c("p_size"), ")."))
    given = F.when(n % 4 == 1, F.array(F.lit(" one"), F.col("p_brand"))).when(n % 4 == 2, F.array(F.lit("x"), F.lit("x "))).when(n % 4 == 3, F.array(F.lit(" ")))
    s = tx.sources_for(F.col("p_brand"), given)
    listed = F.when(s["problem"].isNull(), F.array_join(s["sources"], ", ")).otherwise("")
    return table(spark, sf, "part").select("p_partkey", tx.fig_key(raw).alias("key"), listed.alias("sources"), F.coalesce(s["problem"], F.lit("")).alias("problem"))


@query("""
SELECT doc_id, '[' || lang || ', ' || CASE WHEN doc_id % 2 = 0 THEN '"a, b"' ELSE 'a b' END || ', ' || CASE WHEN doc_id % 3 = 0 THEN '"yes"' ELSE '"' || (doc_id % 5) || '"' END || ']' AS seq,
  md5(trim(trim(regexp_replace(text, '^# [^' || chr(10) || ']*' || chr(10) || '+', '')), chr(10))) AS body FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM documents)""")
def flow_sequences(spark, sf):
    """Values in flow sequences; bodies of whole files cut out again."""
    k = F.col("doc_id")
    seq = F.array(F.col("lang"), F.when(k % 2 == 0, "a, b").otherwise("a b"), F.when(k % 3 == 0, "yes").otherwise((k % 5).cast("string")))
    file = _cat("---\ntitle: x\n---\n\n# Heading\n\n", F.regexp_replace(F.coalesce("text", F.lit("")), r"\A# [^\n]*\n+", ""), "\n")
    body = F.trim(F.trim(tx.body_of(file)), F.lit("\n"))
    return table(spark, sf, "documents").select("doc_id", ym.flow_seq(seq).alias("seq"), F.md5(body).alias("body"))


# URLs

@query("""
SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'not five segments' WHEN 1 THEN 'another host' WHEN 2 THEN 'query or fragment' WHEN 3 THEN 'does not decode' WHEN 4 THEN 'not a file name' ELSE '' END AS problem,
  CASE WHEN p_size % 6 = 5 THEN '2025|v' || (p_size % 3) || '|' || p_name || ' (' || p_size || ').svg' ELSE '' END AS parts FROM part""")
def figure_urls(spark, sf):
    """Image URLs taken apart, or what is wrong with them."""
    n = F.col("p_size")
    good = _cat("https://img.example/set/fig/2025/v", (n % 3).cast("string"), "/")
    url = F.when(n % 6 == 0, "https://img.example/a/b").when(n % 6 == 1, "https://evil.example/a/b/2025/v/x.svg").when(n % 6 == 2, _cat(good, "x.svg?y")).when(n % 6 == 3, _cat(good, "%zz")).when(n % 6 == 4, _cat(good, "%2e%2e")).otherwise(_cat(good, ur.encode_component(_cat(F.col("p_name"), " (", _c("p_size"), ").svg"))))
    p = ur.figure_parts(url, "img.example")
    return table(spark, sf, "part").select("p_partkey", F.coalesce(p["problem"], F.lit("")).alias("problem"), F.when(p["problem"].isNull(), F.concat_ws("|", p["year"], p["key"], p["file"])).otherwise("").alias("parts"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'https://h/x' ELSE 'https://h/x#C' || p_size || '%20a' END AS anchored, CASE p_size % 3 WHEN 0 THEN 'image/svg+xml' WHEN 1 THEN 'image/jpeg' ELSE '-' END AS type, '{f}/' || p_name || ' old' AS body,
  CASE WHEN p_size % 4 = 0 THEN 'present' WHEN p_size % 4 = 1 THEN 'missing' ELSE 'error' END AS state, 1 + p_size % 4 AS span, CASE p_size % 4 WHEN 0 THEN 'alpha' WHEN 1 THEN 'roman' WHEN 2 THEN 'upper-alpha' ELSE 'alpha' END AS style FROM part""")
def url_functions(spark, sf):
    """Fragments, content types, image prefixes, probe states, spans, list styles."""
    n = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", ur.with_fragment(F.lit("https://h/x"), F.when(n % 3 == 0, "").otherwise(_cat("C", _c("p_size"), " a"))).alias("anchored"), F.coalesce(ur.content_type(_cat("f", F.when(n % 3 == 0, ".SVG").when(n % 3 == 1, ".jpg").otherwise(".xyz"))), F.lit("-")).alias("type"),
        ur.rewrite_prefix(_cat("old/", F.col("p_name"), " old"), F.lit("old"), F.lit("{f}")).alias("body"), ur.head_state(F.when(n % 4 == 0, 200).when(n % 4 == 1, 404).otherwise(500 + n)).alias("state"), lab.span(F.lit("2"), (2 + n % 4).cast("string")).alias("span"),
        lab.child_style(F.when(n % 4 == 0, "numbered").when(n % 4 == 1, "alpha").when(n % 4 == 2, "roman")).alias("style"),
    )


#: Slugs of containers with the jurisdiction and lead they name.
SLUGS = [("part-{}-fire", "", "{}"), ("vic-part-{}-exits", "vic", "{}"), ("part-vic-{}-exits", "vic", "{}"), ("{}-walls", "", "{}"), ("part-{}-walls-and-doors", "", "{}"), ("nsw-{}", "nsw", "{}")]


def _pages(spark, sf):
    k = F.col("p_partkey")
    slug = F.get(F.array(*(_cat(a.split("{}")[0], "c", (k % 40).cast("string"), a.split("{}")[1]) for a, _, _ in SLUGS)), (k % 6).cast("int"))
    section = F.when(k % 5 == 0, "9-victoria").otherwise("c-fire")
    url = F.when(k % 17 == 0, _cat("https://evil.example/", _c("p_partkey"))).when(k % 13 == 0, _cat("https://code.example/editions/code-2025/adopted/v", (k % 3).cast("string"), "/", section, "/")).otherwise(_cat("https://code.example/editions/code-2025/adopted/v", (k % 3).cast("string"), "/", section, "/", slug))
    return table(spark, sf, "part").select(url.alias("url"))


PAGES = f"""
SELECT DISTINCT url, vol, k17, k13, CASE WHEN s IS NOT NULL AND s <> '' THEN s WHEN k5 THEN 'vic' ELSE '' END AS state, CASE WHEN k5 THEN '9' ELSE 'c' END AS section, lead, CASE WHEN NOT k13 AND ((s <> '' AND NOT (k5 AND s = 'vic'))) THEN 1 ELSE 0 END AS rank FROM (
  SELECT p_partkey % 17 = 0 AS k17, p_partkey % 13 = 0 AS k13, p_partkey % 5 = 0 AS k5, 'v' || (p_partkey % 3) AS vol, ['', 'vic', 'vic', '', '', 'nsw'][(p_partkey % 6 + 1)::INT] AS s, 'c' || (p_partkey % 40) AS lead,
    CASE WHEN p_partkey % 17 = 0 THEN 'https://evil.example/' || p_partkey ELSE 'https://code.example/editions/code-2025/adopted/v' || (p_partkey % 3) || '/' || CASE WHEN p_partkey % 5 = 0 THEN '9-victoria' ELSE 'c-fire' END
      || CASE WHEN p_partkey % 13 = 0 THEN '' ELSE '/' || replace([{", ".join(repr(a) for a, _, _ in SLUGS)}][(p_partkey % 6 + 1)::INT], '{{}}', 'c' || (p_partkey % 40)) END END AS url FROM part)"""
KEYED = f"SELECT url, rank, vol || '|' || CASE WHEN k13 THEN section || '|' ELSE CASE WHEN state <> '' THEN 'state:' || state ELSE section END || '|' || lead END AS key FROM ({PAGES}) WHERE NOT k17"


@query(f"""
WITH k AS (SELECT DISTINCT * FROM ({KEYED})), b AS (SELECT *, min(rank) OVER (PARTITION BY key) AS best FROM k), g AS (SELECT key, count(DISTINCT url) AS n, min(url) AS url FROM b WHERE rank = best GROUP BY key)
SELECT CASE WHEN n = 1 THEN 'index' ELSE 'collision' END AS what, key, n, url FROM g UNION ALL SELECT 'refused', '', 1, url FROM (SELECT DISTINCT url FROM ({PAGES}) WHERE k17)""")
def link_index(spark, sf):
    """Page URLs to an index, its collisions and the URLs of no page."""
    index, collisions, refused = fold.link_index(_pages(spark, sf), "code[.]example", {"victoria": "vic", "newsouthwales": "nsw"})
    one = F.lit(1).cast("long")
    rows = index.select(F.lit("index").alias("what"), "key", one.alias("n"), "url").unionByName(collisions.select(F.lit("collision").alias("what"), "key", F.size("urls").cast("long").alias("n"), F.array_min("urls").alias("url")))
    return rows.unionByName(refused.select(F.lit("refused").alias("what"), F.lit("").alias("key"), one.alias("n"), "url"))


@query(f"""
WITH k AS (SELECT DISTINCT * FROM ({KEYED})), b AS (SELECT *, min(rank) OVER (PARTITION BY key) AS best FROM k), g AS (SELECT key, count(DISTINCT url) AS n, min(url) AS url, list(DISTINCT url) AS urls FROM b WHERE rank = best GROUP BY key),
u AS (SELECT c_custkey AS unit, 'v' || (c_custkey % 4) AS vol, CASE WHEN c_custkey % 7 = 0 THEN 'vic' ELSE '' END AS state, CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'c' ELSE '9' END AS section, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'c' || (c_custkey % 40) END AS lead, c_custkey % 3 = 0 AS fire, c_custkey % 2 = 0 AS clause FROM customer),
w AS (SELECT *, CASE WHEN lead = '' THEN vol || '|' || section || '|' WHEN state <> '' THEN vol || '|state:' || state || '|' || lead WHEN section <> '' THEN vol || '|' || section || '|' || lead END AS key FROM u),
t AS (SELECT unit, count(*) AS n, min(x) AS url FROM (SELECT unit, unnest(urls) AS x, lead, fire FROM w JOIN g USING (key) WHERE n > 1) WHERE CASE WHEN lead = '' THEN false WHEN fire THEN x LIKE '%-fire' ELSE x LIKE '%-exits' OR regexp_matches(x, '/c[0-9]+-walls$') END GROUP BY unit),
nat AS (SELECT split_part(key, '|', 1) AS vol, split_part(key, '|', 3) AS lead, count(*) AS m, min(url) AS url FROM g WHERE n = 1 AND NOT contains(key, ':') AND split_part(key, '|', 3) <> '' GROUP BY ALL)
SELECT w.unit, coalesce(CASE WHEN p IS NOT NULL AND clause AND w.lead <> '' THEN p || '#U' || w.unit ELSE p END, '') AS url FROM (
  SELECT w.*, coalesce(CASE WHEN g.n = 1 THEN g.url END, CASE WHEN t.n = 1 THEN t.url END, CASE WHEN w.section = '' AND w.lead <> '' AND w.state = '' AND nat.m = 1 THEN nat.url END) AS p
  FROM w LEFT JOIN g USING (key) LEFT JOIN t ON t.unit = w.unit LEFT JOIN nat ON nat.vol = w.vol AND nat.lead = w.lead) w""")
def link_resolution(spark, sf):
    """Units to pages, ties by the words of their titles, none where that leaves a doubt."""
    index, collisions, _ = fold.link_index(_pages(spark, sf), "code[.]example", {"victoria": "vic", "newsouthwales": "nsw"})
    k = F.col("c_custkey")
    u = table(spark, sf, "customer").select(
        k.alias("unit"), F.lit("2025").alias("edition"), _cat("v", (k % 4).cast("string")).alias("volume"), F.when(k % 2 == 0, "clause").otherwise("page").alias("kind"), _cat("U", _c("c_custkey")).alias("id"), F.when(k % 7 == 0, "VIC").alias("state"),
        F.when(k % 11 == 0, "").when(k % 2 == 0, "C").otherwise("9").alias("section"), F.when(k % 9 == 0, "").otherwise(_cat(F.when(k % 2 == 0, "Part C").otherwise("c"), (k % 40).cast("string"))).alias("container"), F.when(k % 3 == 0, "On Fire").otherwise("Exits, walls").alias("container_title"), F.lit("x").alias("title"),
    )
    return fold.resolve_links(u, index, collisions, ["vic", "nsw"]).select("unit", F.coalesce("url", F.lit("")).alias("url"))


@query("SELECT CASE WHEN p_partkey % 17 = 0 THEN '' ELSE 'v' || (p_partkey % 3) END AS volume, count(DISTINCT url) AS n FROM part JOIN (SELECT DISTINCT p_partkey AS q, p_partkey FROM part) USING (p_partkey), LATERAL (SELECT " + PAGES[PAGES.rindex("CASE WHEN p_partkey % 17"):PAGES.rindex(" AS url FROM part")] + " AS url) GROUP BY 1")
def urls_by_volume(spark, sf):
    """Crawled URLs by volume."""
    return census.by_volume(_pages(spark, sf))


# References, pointers, variations

@query("""
WITH r AS (SELECT o_orderkey AS ref, CASE WHEN o_orderkey % 10 = 0 THEN 'ERROR:' || o_custkey ELSE 'f' || o_custkey END AS conref FROM orders), f AS (SELECT 'f' || c_custkey AS conref FROM customer WHERE c_nationkey <> 7)
SELECT ref, CASE WHEN f.conref IS NOT NULL THEN 'found' WHEN r.conref LIKE 'ERROR%' THEN 'tolerated' ELSE 'missing' END AS state FROM r LEFT JOIN f USING (conref)""")
def reference_states(spark, sf):
    """References to files, and what is known of those that fail."""
    r = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ref"), F.when(F.col("o_orderkey") % 10 == 0, _cat("ERROR:", _c("o_custkey"))).otherwise(_cat("f", _c("o_custkey"))).alias("conref"))
    return joins.classified(r, table(spark, sf, "customer").where("c_nationkey <> 7").select(_cat("f", _c("c_custkey")).alias("conref")), "conref", "ERROR").select("ref", "state")


@query("SELECT c_name AS id, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 50 = 0 THEN 'same ' || c_nationkey ELSE c_name END AS c_name FROM customer) GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf):
    """Identities that several files claim."""
    return joins.duplicates(table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 50 == 0, _cat("same ", _c("c_nationkey"))).otherwise(F.col("c_name")).alias("id")), "id")


@query("""
WITH r AS (SELECT s_suppkey AS ref, 'pkg' || (s_suppkey % 3) AS "from", s_suppkey AS conref, s_nationkey AS wanted FROM supplier WHERE s_suppkey % 2 = 0),
sib AS (SELECT 'pkg' || (s_suppkey % 3) AS package, s_suppkey AS conref, CASE WHEN s_suppkey % 8 = 0 THEN -1 ELSE s_nationkey END AS id, s_suppkey % 6 = 0 AS v, s_suppkey % 10 = 0 AS p FROM supplier WHERE s_suppkey % 14 <> 0)
SELECT ref, CASE WHEN sib.id IS NULL THEN 'not there' WHEN sib.id <> wanted THEN 'another identity' WHEN v THEN 'a variation' WHEN p THEN 'a pointer' ELSE '' END AS problem FROM r LEFT JOIN sib ON package = "from" AND sib.conref = r.conref""")
def recoveries(spark, sf):
    """Ruled recoveries from another package, identities checked again."""
    s = table(spark, sf, "supplier").withColumn("k", F.col("s_suppkey")).withColumn("pkg", _cat("pkg", (F.col("s_suppkey") % 3).cast("string")))
    r = s.where("k % 2 = 0").select(F.col("k").alias("ref"), F.col("pkg").alias("from"), F.col("k").alias("conref"), F.col("s_nationkey").alias("wanted_id"))
    sib = s.where("k % 14 <> 0").select(F.col("pkg").alias("package"), F.col("k").alias("conref"), F.when(F.col("k") % 8 == 0, -1).otherwise(F.col("s_nationkey")).alias("id"), (F.col("k") % 6 == 0).alias("is_variation"), (F.col("k") % 10 == 0).alias("has_conref"))
    return joins.recover(s.select(F.col("k").alias("ref")), sib, r).select("ref", F.coalesce("problem", F.lit("")).alias("problem"))


@query("""
WITH RECURSIVE w AS (SELECT c_custkey AS node, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE (c_custkey * 7) % 2000 END AS points_to, c_custkey % 6 = 0 AS empty FROM customer),
r AS (SELECT o_orderkey AS start, o_custkey AS node, 0 AS hops FROM orders UNION ALL SELECT r.start, w.points_to, r.hops + 1 FROM r JOIN w ON w.node = r.node WHERE w.points_to IS NOT NULL AND r.hops < 8)
SELECT start, r.node, r.hops, CASE WHEN r.hops >= 8 THEN 'cyclic' WHEN w.node IS NULL THEN 'dangling' WHEN w.empty THEN 'empty' ELSE 'content' END AS state FROM r LEFT JOIN w ON w.node = r.node WHERE r.hops >= 8 OR w.points_to IS NULL""")
def pointer_splice(spark, sf):
    """Pointers followed until something holds content."""
    k = F.col("c_custkey")
    w = table(spark, sf, "customer").select(k.alias("node"), F.when(k % 3 != 0, k * 7 % 2000).alias("points_to"), (k % 6 == 0).alias("empty"))
    return joins.splice(table(spark, sf, "orders").select(F.col("o_orderkey").alias("start"), F.col("o_custkey").alias("target")), w, 8)


@query("""
WITH h AS (SELECT c_custkey AS host, CASE WHEN c_custkey % 2 = 0 THEN 'vic' ELSE 'nsw' END AS st, 'c' || (c_custkey % 300) || 'd1' AS own, 'e' || (c_custkey % 300) || 'f1' AS acc FROM customer),
f AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'C' || s_suppkey || 'D1 walls' WHEN 1 THEN 'c' || s_suppkey || 'd1.other' ELSE 'E' || s_suppkey || 'F1_x' END || CASE WHEN s_suppkey % 2 = 0 THEN '-VIC' ELSE '_nsw' END || '.xml' AS name, CASE WHEN s_suppkey % 3 = 2 THEN 'e' || s_suppkey || 'f1' ELSE 'c' || s_suppkey || 'd1' END AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'vic' ELSE 'nsw' END AS st FROM supplier)
SELECT host, CASE WHEN a.name IS NOT NULL THEN 1 WHEN b.name IS NOT NULL THEN 2 WHEN c.name IS NOT NULL THEN 3 ELSE 0 END AS rule, coalesce(a.name, b.name, c.name, '') AS match
FROM h LEFT JOIN f a ON a.s_suppkey % 3 = 0 AND a.id = h.own AND a.st = h.st LEFT JOIN f b ON b.id = h.own AND b.st = h.st LEFT JOIN f c ON c.id = h.acc AND c.st = h.st""")
def state_files(spark, sf):
    """Hosts to the files of their state, by stem and then by identity."""
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    own, acc = _cat("C", (k % 300).cast("string"), "D1"), _cat("E", (k % 300).cast("string"), "F1")
    hosts = table(spark, sf, "customer").select(k.alias("host"), _cat(own, " Walls").alias("stem"), own.alias("base_id"), acc.alias("accepted_id"), F.when(k % 2 == 0, "VIC").otherwise("NSW").alias("state"))
    name = _cat(F.when(s % 3 == 0, _cat("C", _c("s_suppkey"), "D1 walls")).when(s % 3 == 1, _cat("c", _c("s_suppkey"), "d1.other")).otherwise(_cat("E", _c("s_suppkey"), "F1_x")), F.when(s % 2 == 0, "-VIC").otherwise("_nsw"), ".xml")
    j = joins.state_files(hosts, table(spark, sf, "supplier").select(name.alias("name")))
    return j.select("host", F.coalesce("rule", F.lit(0)).alias("rule"), F.coalesce("match", F.lit("")).alias("match"))


@query("""
SELECT host, host AS unit, 'DELETE' AS type FROM (SELECT c_custkey AS host FROM customer WHERE c_custkey % 5 = 0)
UNION ALL SELECT min(c_custkey), c_custkey % 40, 'REPLACE' FROM customer WHERE c_custkey % 5 = 1 AND c_custkey % 40 IN (SELECT s_suppkey FROM supplier) GROUP BY c_custkey % 40""")
def variation_units(spark, sf):
    """Units that variations give."""
    k = F.col("c_custkey")
    h = table(spark, sf, "customer").select(k.alias("host"), F.when(k % 5 == 0, "DELETE").when(k % 5 == 1, "REPLACE").otherwise("NONE").alias("type"), (k % 40).alias("target"))
    return joins.variations(h, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("unit")))


@query("SELECT n_nationkey AS key, n_name AS name FROM nation WHERE n_regionkey < 3 UNION ALL SELECT s_nationkey, min(s_name) FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) GROUP BY 1")
def merged_sources(spark, sf):
    """Two sources as one, the first wins."""
    a = table(spark, sf, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    return joins.merge_sources(a, table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key"), F.col("s_name").alias("name")), ["key"])


@query("SELECT o_orderkey AS ref, o_custkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30) AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def insert_only_refs(spark, sf):
    """References of the later state only, whose identity nothing else supplies."""
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ref"), F.col("o_custkey").alias("id"))
    return joins.insert_only(a, table(spark, sf, "lineitem").where("l_quantity > 30").select(F.col("l_orderkey").alias("ref")), table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id")))


@query("""
WITH r AS (SELECT o_orderkey, o_custkey % 700 AS conref, o_orderkey % 4 = 0 AS draft, CASE WHEN (o_custkey % 700) % 9 = 0 THEN '' ELSE 'B' || (o_custkey % 350) END AS base_id FROM orders),
g AS (SELECT conref, bool_and(draft) AS drafted, max(base_id) AS base_id FROM r GROUP BY conref), o AS (SELECT * FROM g WHERE drafted AND base_id <> '')
SELECT (SELECT count(*) FROM r WHERE NOT draft) AS refs, (SELECT count(*) - count(DISTINCT conref) FROM r WHERE NOT draft) AS duplicates, (SELECT count(DISTINCT conref) FROM r WHERE NOT draft AND base_id = '') AS unnumbered,
  (SELECT count(*) FROM o) AS insert_only, (SELECT count(*) FROM o WHERE base_id IN (SELECT 'B' || (c_custkey % 200) FROM customer)) AS insert_only_duplicates""")
def reference_counts(spark, sf):
    """Repeated references of a map, and those of its draft only."""
    k = F.col("o_custkey")
    r = table(spark, sf, "orders").select((k % 700).alias("conref"), F.col("o_orderkey").alias("ord"), (F.col("o_orderkey") % 4 == 0).alias("draft"), F.when(k % 700 % 9 == 0, "").otherwise(_cat("B", (k % 350).cast("string"))).alias("base_id"))
    return census.reference_counts(r, table(spark, sf, "customer").select(_cat("B", (F.col("c_custkey") % 200).cast("string")).alias("base_id")))


@query("""
WITH i AS (SELECT p_partkey AS pre, p_size AS doc_id, CASE p_partkey % 4 WHEN 0 THEN 'data:x' WHEN 1 THEN 'a/F' || (p_partkey % 30) || '.svg' WHEN 2 THEN 'b/f' || (p_partkey % 30) || '.SVG' ELSE 'f' || (p_partkey % 30) || '.emf' END AS href FROM part),
f AS (SELECT DISTINCT s_nationkey AS doc_id, CASE s_suppkey % 3 WHEN 0 THEN 'F' ELSE 'f' END || (s_suppkey % 30) || CASE s_suppkey % 2 WHEN 0 THEN '.svg' ELSE '.png' END AS name FROM supplier),
m AS (SELECT i.*, regexp_extract(href, '([^/]+)$', 1) AS n FROM i WHERE href NOT LIKE 'data:%'),
t AS (SELECT m.doc_id, m.pre, 1 AS rule, min(f.name) AS name, count(DISTINCT f.name) AS k FROM m JOIN f ON f.doc_id = m.doc_id AND f.name = m.n GROUP BY ALL
  UNION ALL SELECT m.doc_id, m.pre, 2, min(f.name), count(DISTINCT f.name) FROM m JOIN f ON f.doc_id = m.doc_id AND lower(f.name) = lower(m.n) GROUP BY ALL
  UNION ALL SELECT m.doc_id, m.pre, 3, min(f.name), count(DISTINCT f.name) FROM m JOIN f ON f.doc_id = m.doc_id AND lower(split_part(f.name, '.', 1)) = lower(split_part(m.n, '.', 1)) GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, pre ORDER BY rule) AS r FROM t)
SELECT i.pre, CASE WHEN href LIKE 'data:%' THEN 'inline' WHEN k IS NULL THEN 'missing' WHEN k > 1 THEN 'ambiguous' ELSE 'found' END AS state, CASE WHEN k = 1 THEN name ELSE '' END AS name FROM i LEFT JOIN b ON b.doc_id = i.doc_id AND b.pre = i.pre AND b.r = 1""")
def image_sources(spark, sf):
    """Image nodes to the files on disk."""
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    n = (k % 30).cast("string")
    href = F.when(k % 4 == 0, "data:x").when(k % 4 == 1, _cat("a/F", n, ".svg")).when(k % 4 == 2, _cat("b/f", n, ".SVG")).otherwise(_cat("f", n, ".emf"))
    images = table(spark, sf, "part").select(F.col("p_size").alias("doc_id"), k.alias("pre"), href.alias("href"))
    files = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("doc_id"), _cat(F.when(s % 3 == 0, "F").otherwise("f"), (s % 30).cast("string"), F.when(s % 2 == 0, ".svg").otherwise(".png")).alias("name"))
    return joins.image_sources(images, files).select("pre", "state", F.coalesce("name", F.lit("")).alias("name"))


@query("""
WITH f AS (SELECT p_partkey, 'y' || (p_size % 4) AS year, 'k' || (p_size % 5) AS key, p_name || (p_partkey % 8) AS file FROM part), d AS (SELECT DISTINCT 'y' || (n_regionkey % 3) AS year, 'k' || (n_nationkey % 5) AS key, 'p' || (n_nationkey % 5) || (n_regionkey % 3) AS package FROM nation),
l AS (SELECT DISTINCT package, p_name || 3 AS file FROM part, d WHERE package LIKE 'p%1')
SELECT f.year, f.key, f.file, coalesce(d.package, '') AS package, CASE WHEN d.package IS NULL THEN 'no package' WHEN l.file IS NOT NULL THEN 'listed' ELSE 'not listed' END AS state FROM f LEFT JOIN d USING (year, key) LEFT JOIN l ON l.package = d.package AND l.file = f.file""")
def figure_packages(spark, sf):
    """Figures with the package that holds them."""
    n = F.col("p_size")
    f = table(spark, sf, "part").select(_cat("y", (n % 4).cast("string")).alias("year"), _cat("k", (n % 5).cast("string")).alias("key"), _cat(F.col("p_name"), (F.col("p_partkey") % 8).cast("string")).alias("file"))
    r, k = (F.col("n_regionkey") % 3).cast("string"), (F.col("n_nationkey") % 5).cast("string")
    d = table(spark, sf, "nation").select(_cat("y", r).alias("year"), _cat("k", k).alias("key"), _cat("p", k, r).alias("package")).distinct()
    listed = table(spark, sf, "part").select(_cat(F.col("p_name"), "3").alias("name")).distinct().join(d.where("package like 'p%1'").select("package").distinct())
    return joins.packaged(f, d, listed).withColumn("package", F.coalesce("package", F.lit("")))


@query("SELECT s_nationkey AS key, array_to_string(list_sort(list(DISTINCT upper('s' || (s_suppkey % 4)))), ',') AS states FROM supplier GROUP BY 1")
def variation_states(spark, sf):
    """The jurisdictions whose variations go with an omitted clause."""
    v = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key"), _cat("s", (F.col("s_suppkey") % 4).cast("string")).alias("state"))
    return census.states_of(v, "key").select("key", F.array_join("states", ",").alias("states"))


# Node tables: regions hold nations, nations market segments, segments customers, customers a text

CLASSES = [("volume", "root"), ("section", "root"), ("part", "container"), ("group", "transparent"), ("clause", "unit"), ("p", "prose"), ("ref", "pointer")]


def _nodes(spark, sf):
    """The node table of the tree; closing order is pre + descendants - depth."""
    n = table(spark, sf, "nation").select(F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("n"))
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n")).select("r", "n", F.col("c_mktsegment").alias("seg"), F.col("c_custkey").alias("c"), F.col("c_name").alias("name"))
    none = {"n": F.lit(-1), "seg": F.lit(""), "c": F.lit(-1).cast("long"), "name": F.lit("")}
    row = lambda df, lvl, *own: df.select("r", *(F.col(k) if k in own else v.alias(k) for k, v in none.items()), F.lit(lvl).alias("depth"))
    rows = [row(table(spark, sf, "region").select(F.col("r_regionkey").alias("r")), 0), row(n, 1, "n"), row(c.select("r", "n", "seg").distinct(), 2, "n", "seg"), row(c, 3, "n", "seg", "c", "name"), row(c.where("c % 4 <> 0"), 4, "n", "seg", "c", "name")]
    t = rows[0]
    for x in rows[1:]:
        t = t.unionByName(x)
    w = F.row_number().over(Window.partitionBy("r").orderBy("n", "seg", "c", "depth")) - 1
    t = t.withColumn("pre", w)
    keys = ["r", "n", "seg", "c"]
    size, up, path = F.lit(None), F.lit(None), []
    for lvl in range(4):
        over = Window.partitionBy(*keys[: lvl + 1])
        size = F.when(F.col("depth") == lvl, F.count(F.lit(1)).over(over) - 1).otherwise(size)
        up = F.when(F.col("depth") == lvl + 1, F.min("pre").over(over)).otherwise(up)
        path.append(F.when(F.col("depth") > lvl, F.min("pre").over(over)))
    tag = F.when(F.col("depth") == 0, "volume").when(F.col("depth") == 1, "section").when(F.col("depth") == 4, "#text").when(F.col("depth") == 2, F.when(F.col("seg") == "AUTOMOBILE", "group").otherwise("part"))
    tag = tag.when(F.col("c") % 3 == 0, "clause").when(F.col("c") % 3 == 1, "p").otherwise(F.when(F.col("c") % 2 == 0, "ref").otherwise("odd"))
    state = F.when(F.col("depth") == 0, _cat("r", _c("r"))).when((F.col("depth") == 3) & (F.col("c") % 5 == 0), "nsw").otherwise("")
    num = F.when(F.col("depth") == 1, _c("n")).when(F.col("depth") == 2, F.col("seg")).otherwise("")
    return t.select(
        F.col("r").alias("doc_id"), "pre", (F.col("pre") + F.coalesce(size, F.lit(0)) - F.col("depth")).cast("int").alias("post"), up.cast("int").alias("parent"), "depth", tag.alias("tag"),
        F.create_map(F.lit("state"), state, F.lit("num"), num, F.lit("key"), _c("c")).alias("attrs"), F.when(F.col("depth") == 4, F.col("name")).alias("text"),
        F.array_compact(F.array(*path, "pre")).alias("path"),
    )


def _classed(spark, sf):
    return tree.with_class(_nodes(spark, sf), spark.createDataFrame(CLASSES, "tag string, class string"))


NODES = """
c AS (SELECT n_regionkey AS r, n_nationkey AS n, c_mktsegment AS seg, c_custkey AS c, c_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey),
u AS (SELECT r_regionkey AS r, -1 AS n, '' AS seg, -1 AS c, '' AS name, 0 AS depth FROM region UNION ALL SELECT n_regionkey, n_nationkey, '', -1, '', 1 FROM nation UNION ALL SELECT DISTINCT r, n, seg, -1, '', 2 FROM c UNION ALL SELECT r, n, seg, c, name, 3 FROM c UNION ALL SELECT r, n, seg, c, name, 4 FROM c WHERE c % 4 <> 0),
t AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY n, seg, c, depth) - 1 AS pre,
  CASE depth WHEN 0 THEN 'volume' WHEN 1 THEN 'section' WHEN 2 THEN CASE WHEN seg = 'AUTOMOBILE' THEN 'group' ELSE 'part' END WHEN 4 THEN '#text' ELSE CASE c % 3 WHEN 0 THEN 'clause' WHEN 1 THEN 'p' ELSE CASE WHEN c % 2 = 0 THEN 'ref' ELSE 'odd' END END END AS tag FROM u)"""


@query(f"WITH {NODES} SELECT r AS doc_id, pre, CASE WHEN c % 5 = 0 THEN 'nsw' ELSE 'r' || r END AS near FROM t WHERE depth = 3")
def tree_nearest(spark, sf):
    """The state at or above each node."""
    n = _nodes(spark, sf)
    return tree.nearest(n, F.col("attrs")["state"], "near").where("depth = 3").select("doc_id", "pre", "near")


@query(f"""
WITH {NODES}, k AS (SELECT *, CASE depth WHEN 0 THEN count(*) OVER (PARTITION BY r) WHEN 1 THEN count(*) OVER (PARTITION BY r, n) WHEN 2 THEN count(*) OVER (PARTITION BY r, n, seg) WHEN 3 THEN count(*) OVER (PARTITION BY r, n, seg, c) ELSE 1 END - 1 AS below FROM t),
i AS (SELECT r, pre, pre + below - depth AS post FROM k)
SELECT d.r AS doc_id, d.pre::BIGINT AS pre, count(*) AS above, max(a.pre)::BIGINT AS nearest, sum(a.pre)::BIGINT AS places FROM i d JOIN i a ON a.r = d.r AND a.pre < d.pre AND a.post > d.post GROUP BY ALL""")
def tree_stabbed(spark, sf):
    """All ancestors of all nodes from pre and post alone, by cells of the interval tree."""
    up = tree.stabbed(_nodes(spark, sf).select("doc_id", "pre", "post"))
    return up.groupBy("doc_id", "pre").agg(F.count(F.lit(1)).alias("above"), F.max("a_pre").alias("nearest"), F.sum("a_pre").alias("places"))


@query(f"""
WITH {NODES} SELECT r AS doc_id, pre, upper(CASE WHEN depth = 3 AND c % 5 = 0 THEN 'nsw' ELSE 'r' || r END) AS state, n::VARCHAR AS section_num, CASE WHEN seg = 'AUTOMOBILE' THEN '' ELSE 'part' END AS container_kind, CASE WHEN seg = 'AUTOMOBILE' THEN '' ELSE seg END AS container_num
FROM t WHERE tag IN ('clause', 'part')""")
def tree_contexts(spark, sf):
    """Section, container and state that units and containers stand in."""
    e = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return tree.contexts(_classed(spark, sf)).select("doc_id", "pre", "state", "section_num", e("container_kind"), e("container_num"))


@query(f"WITH {NODES} SELECT p.r AS doc_id, h.pre AS container, p.pre, 'prose' AS what FROM t p JOIN t h ON p.tag = 'p' AND h.tag = 'part' AND (h.r, h.n, h.seg) = (p.r, p.n, p.seg) UNION ALL SELECT DISTINCT h.r, h.pre, -1, 'overview' FROM t p JOIN t h ON p.tag = 'p' AND h.tag = 'part' AND (h.r, h.n, h.seg) = (p.r, p.n, p.seg)")
def tree_prose(spark, sf):
    """Prose of containers, and the containers that have some."""
    c = _classed(spark, sf)
    prose = tree.own_prose(c).select("doc_id", "container", "pre", F.lit("prose").alias("what"))
    return prose.unionByName(tree.overviews(c).select("doc_id", F.col("pre").alias("container"), F.lit(-1).alias("pre"), F.lit("overview").alias("what")))


@query(f"""
WITH {NODES}, k AS (SELECT x.*, (SELECT any_value(p.tag) FROM t p WHERE p.depth = 3 AND p.r = x.r AND p.c = x.c) AS own FROM t x WHERE depth >= 3)
SELECT 'unknown' AS what, r AS doc_id, pre FROM k WHERE depth = 3 AND tag = 'odd' UNION ALL SELECT 'stray', r, pre FROM k WHERE depth = 4 AND own = 'ref' UNION ALL SELECT 'pointer', r, pre FROM k WHERE depth = 4 AND own = 'ref'
UNION ALL SELECT 'orphan', r, pre FROM k WHERE depth = 3 AND tag = 'p' AND seg = 'AUTOMOBILE'""")
def tree_guards(spark, sf):
    """Unknown elements, stray text, pointers with content, prose without container."""
    c = _classed(spark, sf)
    found = {"unknown": tree.unknown_tags(c), "stray": tree.stray_text(c), "pointer": tree.pointer_content(c), "orphan": tree.orphan_prose(c)}
    out = [df.select(F.lit(k).alias("what"), "doc_id", "pre") for k, df in found.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query(f"WITH {NODES}, p AS (SELECT r, n, seg, min(c) AS c FROM t WHERE tag = 'p' GROUP BY ALL) SELECT h.r AS doc_id, h.pre AS parent, x.name AS first FROM p JOIN t x ON x.depth = 4 AND (x.r, x.c) = (p.r, p.c) JOIN t h ON h.depth = 2 AND (h.r, h.n, h.seg) = (p.r, p.n, p.seg)")
def tree_child_text(spark, sf):
    """The text of the first child of a tag."""
    return tree.child_text(_nodes(spark, sf), "p", "first")


@query(f"WITH {NODES}, e AS (SELECT *, CASE depth WHEN 1 THEN 'volume' WHEN 2 THEN 'section' WHEN 3 THEN CASE WHEN seg = 'AUTOMOBILE' THEN 'group' ELSE 'part' END ELSE '' END AS up FROM t WHERE depth < 4) SELECT up AS parent_tag, tag, count(*) AS n FROM e GROUP BY ALL")
def tree_containment(spark, sf):
    """How often a tag stands in a parent tag."""
    return tree.containment(_nodes(spark, sf)).withColumn("parent_tag", F.coalesce("parent_tag", F.lit("")))


@query(f"WITH {NODES} SELECT x.r AS doc_id, h.pre AS unit, count(*) AS n FROM t x JOIN t h ON x.depth = 3 AND x.c % 7 = 0 AND h.r = x.r AND h.pre = CASE WHEN x.tag = 'clause' THEN x.pre ELSE (SELECT z.pre FROM t z WHERE z.depth = 2 AND (z.r, z.n, z.seg) = (x.r, x.n, x.seg)) END GROUP BY ALL")
def retention_counts(spark, sf):
    """Retained elements counted for the inner unit only."""
    n = _nodes(spark, sf)
    base = n.withColumn("retained", F.coalesce((F.col("depth") == 3) & (F.col("attrs")["key"].cast("long") % 7 == 0), F.lit(False)))
    return tracked.retention_counts(base, n.where("depth = 2 or (depth = 3 and tag = 'clause')"))


@query("""
WITH t AS (SELECT doc_id // 2 AS doc, doc_id, text, doc_id % 3 <> 0 AS retained FROM documents), r AS (SELECT DISTINCT doc FROM t),
h AS (SELECT doc, count(*) AS n, bool_and(retained) AS inside FROM t WHERE contains(text, 'Copyright') GROUP BY doc)
SELECT 'text' AS what, t.doc_id, md5(CASE WHEN h.n = 1 AND h.inside THEN replace(text, 'Copyright', 'A') ELSE text END) AS text FROM t LEFT JOIN h USING (doc)
UNION ALL SELECT 'fault', r.doc, coalesce(n, 0)::VARCHAR FROM r LEFT JOIN h USING (doc) WHERE n IS NULL OR n <> 1 OR NOT inside""")
def corrections(spark, sf):
    """Ruled corrections of whole texts (two documents share a ruling), and rulings that fit none, several, or one that isn't retained."""
    t = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 2).alias("doc_id"), F.col("doc_id").alias("pre"), "text", (F.col("doc_id") % 3 != 0).alias("retained"))
    r = t.select("doc_id", F.lit("Copyright").alias("find"), F.lit("A").alias("replace")).distinct()
    fixed, faults = tracked.corrections(t, r)
    return fixed.select(F.lit("text").alias("what"), F.col("pre").alias("doc_id"), F.md5("text").alias("text")).unionByName(faults.select(F.lit("fault").alias("what"), "doc_id", F.col("n").cast("string").alias("text")))


# Censuses

UNITS = "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '2022' ELSE '2025' END AS edition, CASE WHEN doc_id % 3 = 0 THEN 'page' ELSE source END AS kind, doc_id % 5 = 0 AS overview, lang FROM documents"


def _u(spark, sf):
    k = F.col("doc_id")
    return table(spark, sf, "documents").select("doc_id", F.when(k % 2 == 0, "2022").otherwise("2025").alias("edition"), F.when(k % 3 == 0, "page").otherwise(F.col("source")).alias("kind"), (k % 5 == 0).alias("overview"), "lang")


@query(f"WITH k AS (SELECT edition, CASE WHEN kind = 'page' AND overview THEN 'page (overview)' ELSE kind END AS kind, count(*) AS n FROM ({UNITS}) GROUP BY ALL) SELECT edition, string_agg(n || ' ' || kind, ', ' ORDER BY kind) AS summary, sum(n)::BIGINT AS units FROM k GROUP BY edition")
def kind_summary(spark, sf):
    """Units by kind, and a phrase for each edition."""
    k = census.kinds(_u(spark, sf))
    return census.kind_summary(k).join(k.groupBy("edition").agg(F.sum("n").alias("units")), "edition")


@query("""
WITH f AS (SELECT c_mktsegment AS package, 'f' || (c_custkey % 300) AS name, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE 'same' END AS content FROM customer)
SELECT name, count(DISTINCT package) AS packages, count(DISTINCT content) AS contents FROM f GROUP BY name""")
def package_overlap(spark, sf):
    """Files that packages share, by name and content."""
    k = F.col("c_custkey")
    f = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("package"), _cat("f", (k % 300).cast("string")).alias("name"), F.when(k % 4 == 0, F.col("c_mktsegment")).otherwise("same").cast("binary").alias("content"))
    return census.package_overlap(f)


@query("SELECT count(DISTINCT (l_suppkey, l_returnflag, l_linenumber)) AS sites, count(DISTINCT l_suppkey) AS files FROM lineitem WHERE l_quantity < 5")
def retention_sites(spark, sf):
    """Passages kept from an earlier state, and the files that hold them."""
    return census.retention_sites(table(spark, sf, "lineitem").where("l_quantity < 5").select(F.col("l_suppkey").alias("file"), F.col("l_returnflag").alias("tag"), F.col("l_linenumber").cast("string").alias("text")))


@query("WITH f AS (SELECT source, lang, min(doc_id) AS first FROM documents WHERE doc_id % 7 <> 0 GROUP BY ALL) SELECT source, string_agg(lang, ', ' ORDER BY first) AS lang FROM f GROUP BY source")
def facet_lists(spark, sf):
    """Distinct values in first-seen order, empty ones left out."""
    d = table(spark, sf, "documents").select("source", "doc_id", F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("lang")).alias("lang"))
    return census.facets(d, "source", "lang", "doc_id")


@query("""
WITH u AS (SELECT lang AS doc, source <> 'src1' AS scoped, doc_id % 40 AS a, doc_id % 3 AS w FROM documents)
SELECT doc, count(*) AS read, count(*) FILTER (WHERE scoped) AS scoped, (SELECT count(DISTINCT f) FROM (SELECT a AS f, doc AS d, scoped AS s FROM u UNION ALL SELECT a + 1, doc, scoped FROM u) x WHERE s AND x.d = u.doc) AS figures, coalesce(sum(w) FILTER (WHERE scoped), 0)::BIGINT AS warnings FROM u GROUP BY doc""")
def documents_read(spark, sf):
    """A5: by document the units read and in scope, their figures and warnings."""
    k = F.col("doc_id")
    return census.documents_read(table(spark, sf, "documents").select(F.col("lang").alias("doc"), (F.col("source") != "src1").alias("in_scope"), F.array((k % 40).cast("string"), (k % 40 + 1).cast("string")).alias("figures"), F.array_repeat(F.lit("w"), (k % 3).cast("int")).alias("warnings")))


@query("SELECT (SELECT count(DISTINCT p_size) FROM part WHERE p_partkey % 2 = 0) AS read, (SELECT count(DISTINCT CASE WHEN doc_id % 3 = 0 THEN doc_id % 70 ELSE doc_id % 10 END) FROM documents) AS published")
def figures_published(spark, sf):
    """Figures read and figures that the finished files show."""
    k = F.col("doc_id")
    body = F.when(k % 3 == 0, _cat("text ![a](https://img/", (k % 70).cast("string"), ".svg) more")).otherwise(_cat("![a](https://img/", (k % 10).cast("string"), ".svg) [b](https://img/", (k % 10).cast("string"), ".svg)"))
    return census.figures_published(table(spark, sf, "part").where("p_partkey % 2 = 0").select(F.col("p_size").cast("string").alias("figure")), table(spark, sf, "documents").select(body.alias("content")), r"\(https://img/([0-9]+)[.]svg\)")


# Guards and acceptance

@query("""
SELECT 'linked' AS guard, doc_id::VARCHAR AS subject, 'no page' AS detail FROM documents WHERE doc_id % 6 = 0 AND doc_id % 2 = 0 AND NOT (lang = 'en' AND source = 'src1' AND doc_id % 4 <> 0)
UNION ALL SELECT 'parity', doc || '/' || parent, 'off by ' || delta FROM (SELECT lang AS doc, source AS parent, count(*) - 3 AS delta FROM documents GROUP BY ALL) WHERE delta <> 0
UNION ALL SELECT 'rendered', doc_id::VARCHAR, 'no rule' FROM documents WHERE doc_id % 50 = 0
UNION ALL SELECT 'identity stated', o_orderkey::VARCHAR, 'no identity' FROM orders WHERE o_custkey % 100 = 0
UNION ALL SELECT 'partial run', n_name || '/glossary/a.md', 'belongs to a whole run' FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'partial run', n_name || '/INDEX.md', 'belongs to a whole run' FROM nation WHERE n_regionkey = 2
UNION ALL SELECT 'edition', page_id::VARCHAR, 'edition ' || (page_id % 4) FROM pages WHERE page_id % 4 <> 2
UNION ALL SELECT 'plausible', 'links', 'only ' || count(*) FROM nation HAVING count(*) < 100
UNION ALL SELECT 'evidence', s_suppkey::VARCHAR, CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 5 END || ' characters' FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT 'index', CASE WHEN c_custkey % 30 = 0 THEN '2022' ELSE '2025' END || '/' || (c_custkey % 800), 'outside its edition' FROM customer WHERE c_custkey % 30 = 0
UNION ALL SELECT 'index', p, 'listed twice' FROM (SELECT CASE WHEN c_custkey % 30 = 0 THEN '2022' ELSE '2025' END || '/' || (c_custkey % 800) AS p FROM customer) GROUP BY p HAVING count(*) > 1
UNION ALL SELECT 'unique', c_nationkey::VARCHAR, count(*) || ' records' FROM customer GROUP BY c_nationkey HAVING count(*) > 1
UNION ALL SELECT 'ruling fired', c_custkey::VARCHAR, 'never used' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) AND c_nationkey <> 3""")
def guard_violations(spark, sf):
    """The violations of all guards in one table."""
    d, k = table(spark, sf, "documents"), F.col("doc_id")
    units = d.select(k.alias("unit"), F.when(k % 6 != 0, "u").alias("url"), F.when(k % 2 == 0, "clause").otherwise("page").alias("kind"), F.col("lang").alias("volume"), F.col("source").alias("id"), F.when(k % 4 == 0, "x").alias("state"), F.when(k % 50 == 0, "no rule").alias("error"))
    rulings = spark.createDataFrame([("en", "clause", "src1", None)], "volume string, kind string, id string, state string")
    deltas = d.groupBy(F.col("lang").alias("doc"), F.col("source").alias("parent")).agg((F.count(F.lit(1)) - 3).alias("delta"))
    pointers = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ref"), F.when(F.col("o_custkey") % 100 != 0, "x").alias("id"))
    n = table(spark, sf, "nation")
    writes = n.select(F.concat("n_name", F.when(F.col("n_regionkey") == 1, "/glossary/a.md").when(F.col("n_regionkey") == 2, "/INDEX.md").otherwise("/x/b.md")).alias("path"))
    urls = table(spark, sf, "pages").select(F.col("page_id").alias("url"), (F.col("page_id") % 4).cast("string").alias("edition"))
    evidence = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 2 != 0, F.repeat(F.lit("x"), 90)).when(F.col("s_suppkey") % 3 != 0, "short").alias("evidence"))
    c = table(spark, sf, "customer")
    index = c.select(F.lit("2025").alias("edition"), _cat(F.when(F.col("c_custkey") % 30 == 0, "2022").otherwise("2025"), "/", (F.col("c_custkey") % 800).cast("string")).alias("path"))
    key = lambda df, col: df.select(F.col(col).alias("k"))
    return guards.gathered(
        guards.linked(units, rulings), guards.parity(deltas), guards.rendered(units), guards.stated(pointers), guards.partial_scope(writes, "glossary", False), guards.one_edition(urls, "2"), guards.plausible(n),
        guards.evidenced(evidence), guards.indexed(index), guards.unique(c, "c_nationkey"), guards.fired(key(c, "c_custkey"), key(table(spark, sf, "orders"), "o_custkey"), key(c.where("c_nationkey = 3"), "c_custkey"), "k"),
    )


CORPUS = """
SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'C' || (p_partkey % 500) || 'D1' END AS clause, 'v' || (p_partkey % 5) AS volume, CASE WHEN p_partkey % 2 = 0 THEN 'aus' ELSE 'nsw' END AS jurisdiction,
  '2025/v' || CASE WHEN p_partkey % 50 = 1 THEN 9 ELSE p_partkey % 5 END || '/' || CASE WHEN p_partkey % 3 = 0 THEN CASE WHEN p_partkey % 90 = 0 THEN 'c1d1' ELSE 'page' END ELSE CASE WHEN p_partkey % 40 = 2 THEN 'lost' ELSE 'c' || (p_partkey % 500) || 'd1' END END || '-' || p_partkey || '.md' AS path,
  '---' || chr(10) || CASE WHEN p_partkey % 17 = 0 THEN 'x: y' ELSE 'citation: Code' END || chr(10) || CASE WHEN p_partkey % 4 = 0 THEN 'x: z' ELSE 'web_url: https://h' END || chr(10) || '---' || chr(10) || chr(10) || '# Title' || chr(10) || chr(10)
    || CASE p_partkey % 6 WHEN 0 THEN '![Figure H' || (p_partkey % 60) || ': a](x)' WHEN 1 THEN 'see Figure H' || (p_partkey % 90) || '.' WHEN 2 THEN '### Table C' || (p_partkey % 60) || 'D1 — a' WHEN 3 THEN 'as in NSW Table C' || (p_partkey % 90) || 'D1 (b)' ELSE 'plain text of ' || p_name END || chr(10) AS content FROM part"""


def _corpus(spark, sf):
    k = F.col("p_partkey")
    m = lambda n: (k % n).cast("string")
    clause = F.when(k % 3 != 0, _cat("C", m(500), "D1"))
    name = F.when(k % 3 == 0, F.when(k % 90 == 0, "c1d1").otherwise("page")).otherwise(F.when(k % 40 == 2, "lost").otherwise(_cat("c", m(500), "d1")))
    body = F.when(k % 6 == 0, _cat("![Figure H", m(60), ": a](x)")).when(k % 6 == 1, _cat("see Figure H", m(90), ".")).when(k % 6 == 2, _cat("### Table C", m(60), "D1 — a")).when(k % 6 == 3, _cat("as in NSW Table C", m(90), "D1 (b)")).otherwise(_cat("plain text of ", F.col("p_name")))
    head = _cat("---\n", F.when(k % 17 == 0, "x: y").otherwise("citation: Code"), "\n", F.when(k % 4 == 0, "x: z").otherwise("web_url: https://h"), "\n---\n\n# Title\n\n")
    return table(spark, sf, "part").select(
        clause.alias("clause"), _cat("v", m(5)).alias("volume"), F.when(k % 2 == 0, "aus").otherwise("nsw").alias("jurisdiction"), _cat("2025/v", F.when(k % 50 == 1, "9").otherwise(m(5)), "/", name, "-", k.cast("string"), ".md").alias("path"), _cat(head, body, "\n").alias("content"),
    )


@query(f"""
WITH c AS ({CORPUS}), n AS (SELECT *, lower(clause) AS token, split_part(split_part(path, '/', 3), '-', 1) AS lead, split_part(path, '/', 2) AS dir FROM c)
SELECT 'wrong hit' AS guard, path AS subject, 'found as ' || lead AS detail FROM n WHERE lead IN (SELECT token FROM n) AND (clause IS NULL OR token <> lead)
UNION ALL SELECT 'lost name', path, 'clause ' || clause FROM n WHERE token <> lead
UNION ALL SELECT 'two files of one clause', clause || '|' || volume || '|' || jurisdiction, count(*) || ' files' FROM c WHERE clause IS NOT NULL GROUP BY clause, volume, jurisdiction HAVING count(*) > 1
UNION ALL SELECT 'outside its volume', path, volume FROM n WHERE clause IS NOT NULL AND dir <> volume""")
def accept_names(spark, sf):
    """C13 (1), Q1: names that don't lead to a clause's files, or to others."""
    return guards.exact_names(_corpus(spark, sf))


@query(f"""
WITH c AS ({CORPUS}), p AS (SELECT path FROM c WHERE k % 8 = 0 OR k % 21 = 0)
SELECT 'citation near top' AS guard, path AS subject, 'no citation' AS detail FROM c WHERE NOT contains(content, 'citation: ')
UNION ALL SELECT 'address near top', path, 'no address' FROM c WHERE clause IS NOT NULL AND NOT contains(content, 'web_url: ') AND path NOT IN (SELECT path FROM p)
UNION ALL SELECT 'address near top', path, 'has an address after all' FROM c WHERE clause IS NOT NULL AND contains(content, 'web_url: ') AND path IN (SELECT path FROM p)
UNION ALL SELECT 'phrase', x, 'in no line' FROM (VALUES ('plain text of'), ('no such words'), ('# Title')) t(x) WHERE NOT EXISTS (SELECT 1 FROM c WHERE contains(content, x))
UNION ALL SELECT 'size', path, strlen(content) || ' bytes' FROM c WHERE strlen(content) > 90""")
def accept_citations(spark, sf):
    """C13 (2, 3, 5, 6), Q2-Q4, Q12, U7: files that don't cite themselves near their top, phrases that no line holds, files too long."""
    c = _corpus(spark, sf)
    k = F.regexp_extract("path", r"-([0-9]+)\.md$", 1).cast("int")
    large = guards.violation(c.where(F.octet_length("content") > 90), "size", "path", "concat(octet_length(content), ' bytes')")
    return guards.gathered(guards.self_citing(c, c.where((k % 8 == 0) | (k % 21 == 0))), guards.phrases_present(c, ["plain text of", "no such words", "# Title"]), large)


@query(f"""
WITH c AS ({CORPUS}), f AS (SELECT path, coalesce(clause, path) AS home, 'h' || (k % 60) AS key FROM c WHERE k % 6 = 0), t AS (SELECT path, coalesce(clause, path) AS home, 'c' || (k % 60) || 'd1' AS key FROM c WHERE k % 6 = 2),
r AS (SELECT 'cited figure' AS guard, path, 'h' || (k % 90) AS key FROM c WHERE k % 6 = 1 UNION ALL SELECT 'cited table', path, 'c' || (k % 90) || 'd1' FROM c WHERE k % 6 = 3),
h AS (SELECT 'cited figure' AS guard, key, count(DISTINCT home) AS n FROM f GROUP BY key UNION ALL SELECT 'cited table', key, count(DISTINCT home) FROM t GROUP BY key)
SELECT r.guard, path AS subject, CASE WHEN n IS NULL THEN key || ' is nowhere' ELSE key || ' is in ' || n || ' clauses' END AS detail FROM r LEFT JOIN h USING (guard, key) WHERE n IS NULL OR n > 1""")
def accept_cited(spark, sf):
    """C13 (4, 8), Q8, J19, F22: figures and tables that are cited but nowhere, or in several clauses."""
    c = _corpus(spark, sf)
    return guards.gathered(guards.cited_reachable(c, "figure", True), guards.cited_reachable(c, "table", True))


# Consumers

@query(f"""
WITH c AS ({CORPUS}) SELECT 'designation' AS what, path FROM c WHERE regexp_matches(path, '/c1d1(-[0-9]+)[.]md$') UNION ALL SELECT 'jurisdiction', path FROM c WHERE jurisdiction = 'nsw'
UNION ALL SELECT 'window', path FROM c WHERE contains(content, 'citation: ') AND contains(content, 'web_url: ')""")
def lookups(spark, sf):
    """Q1, Q4, Q5: files by designation, by jurisdiction, and those that cite themselves in their first lines."""
    c = _corpus(spark, sf)
    what = lambda df, w: df.select(F.lit(w).alias("what"), "path")
    return what(search.by_designation(c, "C1D1"), "designation").unionByName(what(search.in_jurisdiction(c, "NSW"), "jurisdiction")).unionByName(what(search.citation_window(c).where("cited and linked"), "window"))


@query("""
SELECT p_partkey, NOT (p_size % 3 = 0) AS applies, CASE WHEN p_size % 2 = 0 THEN '> The ' || p_type || ' does not apply' ELSE '' END AS quote FROM part""")
def class_scopes(spark, sf):
    """Q6, Q11: classes that a unit applies to, and overviews whose block quotes say that something doesn't apply."""
    n = F.col("p_size")
    c = table(spark, sf, "part").select(F.col("p_partkey").alias("path"), F.lit("page").alias("kind"), F.lit(True).alias("overview"), F.when(n % 3 == 0, "Class 1a, Class 2").when(n % 3 == 1, "Class 1a, Class 20").alias("excluded"), _cat("does not apply\n", F.when(n % 2 == 0, _cat("> The ", F.col("p_type"), " does not apply")).otherwise("> other"), "\nend").alias("content"))
    q = search.disapplied(c, "does not apply").select("path", F.array_join("quotes", "\n").alias("quote"))
    return c.join(q, "path", "left").select(F.col("path").alias("p_partkey"), search.applies_to(F.col("excluded"), "Class 2").alias("applies"), F.coalesce("quote", F.lit("")).alias("quote"))


@query("""
SELECT 'prompt' AS what, string_agg('C' || n_nationkey || ' ' || lower(n_name) || '=<' || 'n' || n_regionkey || '>', chr(10) ORDER BY 'C' || n_nationkey, lower(n_name)) AS text FROM nation
UNION ALL SELECT 'reusable', s_name FROM supplier WHERE s_suppkey % 2 = 0 AND s_nationkey % 3 = 1 AND s_suppkey % 7 <> 0""")
def prompts_and_caches(spark, sf):
    """The format table of checks, and cached agents that fit."""
    checks = table(spark, sf, "nation").select(_cat("C", _c("n_nationkey")).alias("id"), F.lower("n_name").alias("field"), _cat("n", _c("n_regionkey")).alias("ask"))
    s = F.col("s_suppkey")
    cache = table(spark, sf, "supplier").select(F.when(s % 7 != 0, F.col("s_name")).alias("id"), F.when(s % 2 == 0, "m1").otherwise("m2").alias("model"), F.sha2(F.when(F.col("s_nationkey") % 3 == 1, "conf").otherwise("other").cast("binary"), 256).alias("config_sha"))
    fit = transcript.reusable(cache, F.lit("conf"), F.lit("m1"))
    return transcript.prompt(checks).select(F.lit("prompt").alias("what"), F.col("prompt").alias("text")).unionByName(fit.select(F.lit("reusable").alias("what"), F.col("id").alias("text")))


@query("SELECT a, b, whole FROM (VALUES ('all', 'all', true), ('some', 'all', false)) t(a, b, whole)")
def whole_editions(spark, sf):
    """Whether a selection is the whole."""
    n = table(spark, sf, "nation").select(F.col("n_name").alias("k"))
    one = lambda a, sel: ordered.whole(sel, n.unionAll(n), "k").select(F.lit(a).alias("a"), F.lit("all").alias("b"), "whole")
    return one("all", n).unionByName(one("some", n.where("k <> 'CHINA' and k not like '%1'")))


@query("""
WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos, l_quantity::INT % 4 AS ind, l_quantity::INT % 3 AS kind FROM lineitem),
n AS (SELECT *, lead(ind) OVER (PARTITION BY l_orderkey ORDER BY pos) AS nxt FROM l)
SELECT l_orderkey, pos FROM n WHERE kind = 0 AND coalesce(nxt, 0) <= ind""")
def bare_headings(spark, sf):
    """Labels that host nothing deeper."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    q = F.col("l_quantity").cast("int")
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.row_number().over(w).cast("long").alias("pos"), F.concat(F.repeat(F.lit(" "), q % 4), F.when(q % 3 == 0, "(a)").otherwise("(a) x")).alias("line"))  # noqa: E741
    return ordered.heading_windows(l).select(F.col("doc_id").alias("l_orderkey"), "pos")


# Sources and sinks

@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'unstated' WHEN doc_id % 3 = 1 THEN 'right' ELSE 'wrong' END AS state, doc_id % 4 <> 0 AS stale FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)""")
def checksums(spark, sf):
    """S2, S3, ST4: digests against stated ones, and what is left to extract."""
    d = table(spark, sf, "documents").groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", _c("doc_id").alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    right = F.upper(F.sha2("content", 256))
    sums = d.where("doc_id % 3 <> 0").select("name", F.when(F.col("doc_id") % 3 == 1, right).otherwise(F.repeat(F.lit("0"), 64)).alias("sha256"))
    v = tables.verified(d, sums)
    done = d.where("doc_id % 4 = 0").select(F.sha2("content", 256).alias("sha256"))
    left = tables.stale(v.drop("sha256"), done).select("doc_id", F.lit(True).alias("stale"))
    state = F.when(F.col("ok").isNull(), "unstated").when(F.col("ok"), "right").otherwise("wrong")
    return v.select("doc_id", state.alias("state")).join(left, "doc_id", "left").withColumn("stale", F.coalesce("stale", F.lit(False)))


@query("""
SELECT 'a/' || n_name || '.xml' AS name, md5('<n>' || n_nationkey || '</n>') AS data, '' AS error FROM nation UNION ALL SELECT '..' || n_name, md5('ok'), '' FROM nation UNION ALL SELECT '../' || n_name, '', 'escapes its folder' FROM nation""")
def archives(spark, sf):
    """archives' entries, stored and deflated, folders left out, escaping names refused."""
    import io
    import zipfile

    def pack(batches):
        for batch in batches:
            made = []
            for name, text in zip(batch["path"], batch["text"], strict=True):
                b = io.BytesIO()
                with zipfile.ZipFile(b, "w") as z:
                    z.writestr("a/", "")
                    z.writestr(f"a/{name}.xml", text, zipfile.ZIP_DEFLATED)
                    z.writestr(f"..{name}", "ok", zipfile.ZIP_STORED)
                    z.writestr(f"../{name}", "x")
                made.append(b.getvalue())
            yield batch[["path"]].assign(content=made)

    named = table(spark, sf, "nation").select(F.col("n_name").alias("path"), _cat("<n>", _c("n_nationkey"), "</n>").alias("text"))
    zips = named.mapInPandas(pack, "path string, content binary")
    return tables.unzip(zips).select("name", F.coalesce(F.md5("data"), F.lit("")).alias("data"), F.coalesce("error", F.lit("")).alias("error"))


TABLES = "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region supplier".split()


@query(f"SELECT name FROM (VALUES {', '.join(f"('{t}')" for t in TABLES)}) t(name)")
def listing(spark, sf):
    """Files below a folder, by path; a table is a file or a folder of files."""
    return tables.listing(spark, sf, "*.parquet").select(F.regexp_extract("path", r"([^/]+)\.parquet(?:/[^/]*)?$", 1).alias("name")).distinct()


@query("SELECT user_id, sum(coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), 0))::BIGINT AS total, count(*) FILTER (WHERE try_cast(json_extract_string(props, '$.k') AS BIGINT) IS NULL) AS none FROM events GROUP BY user_id")
def json_values(spark, sf):
    """JSON values, null where they are missing or corrupt."""
    e = table(spark, sf, "events").select("user_id", tables.json_or_null(F.col("props"), "k long")["k"].alias("k"))
    return e.groupBy("user_id").agg(F.sum(F.coalesce("k", F.lit(0))).alias("total"), F.count_if(F.col("k").isNull()).alias("none"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'yes' ELSE 'Title ' || lang END AS title, array_to_string(['Vol, one', source], '|') AS sources, array_to_string(CASE WHEN doc_id % 3 = 0 THEN [] ELSE ['fire: wall', lang] END, '|') AS terms, 'H ' || doc_id AS h1,
  md5(trim(text, chr(10))) AS body FROM (SELECT * REPLACE ('Body ' || coalesce(text, '') AS text) FROM documents)""")
def markdown_round_trip(spark, sf):
    """Files as they are written, read again."""
    k = F.col("doc_id")
    front = ym.front_matter({"title": F.when(k % 2 == 0, "yes").otherwise(_cat("Title ", F.col("lang"))), "sources": F.array(F.lit("Vol, one"), F.col("source")), "defined_terms": F.when(k % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("fire: wall"), F.col("lang")))})
    d = table(spark, sf, "documents").select(_c("doc_id").alias("path"), ym.document(front, _cat("H ", _c("doc_id")), F.lit(None).cast("string"), _cat("Body ", F.coalesce("text", F.lit("")))).alias("content"))
    return tables.markdown(d).select(F.col("path").cast("long").alias("doc_id"), F.col("keys")["title"].alias("title"), F.array_join("sources", "|").alias("sources"), F.array_join("defined_terms", "|").alias("terms"), "h1", F.md5("body").alias("body"))


@query("""
SELECT 'p' || (n_nationkey % 6) AS doc, CASE WHEN n_nationkey % 6 IN (0, 1) THEN 'absent' WHEN n_nationkey % 6 = 2 THEN 'ambiguous' ELSE 'listed' END AS state, CASE WHEN n_nationkey % 6 IN (0, 1) THEN '' ELSE n_name || '.svg' END AS name FROM nation WHERE n_nationkey % 6 > 1 UNION ALL SELECT DISTINCT 'p' || (n_nationkey % 6), 'absent', '' FROM nation WHERE n_nationkey % 6 <= 1""")
def image_folders(spark, sf):
    """Images of packages, whose folder may be written in any case but must be one."""
    k = F.col("n_nationkey")
    folder = F.when(k % 6 <= 1, "XMLs").when((k % 6 == 2) & (k % 4 == 0), "IMAGES").when(k % 6 == 2, "images").otherwise("Images")
    f = table(spark, sf, "nation").select(_cat("p", (k % 6).cast("string")).alias("doc"), _cat("p", (k % 6).cast("string"), "/", folder, "/", F.col("n_name"), ".svg").alias("path"))
    return tables.images(f).select("doc", "state", F.coalesce("name", F.lit("")).alias("name"))


@query("""
WITH p AS (SELECT page_id, CASE page_id % 7 WHEN 0 THEN 500 WHEN 1 THEN 404 WHEN 2 THEN 404 ELSE 200 END AS last FROM pages)
SELECT 'u' || page_id AS url, CASE last WHEN 200 THEN 'present' WHEN 404 THEN 'missing' ELSE 'error' END AS what, CASE WHEN last = 404 AND page_id % 2 = 0 THEN 'image/png' WHEN last = 404 THEN 'unknown' ELSE '' END AS plan FROM p
UNION ALL SELECT 'u' || (SELECT min('u' || page_id)[2:] FROM p WHERE last = 500), 'stop', count(*) || ' without answer' FROM p WHERE last = 500 HAVING count(*) >= 5""")
def probes(spark, sf):
    """What probes of URLs found, what stops a run, and what is to be sent."""
    k = F.col("page_id")
    urls = table(spark, sf, "pages").select(_cat("u", _c("page_id")).alias("url"), k.alias("k"))
    last = F.when(k % 7 == 0, 500).when(k % 7 <= 2, 404).otherwise(200)
    p = table(spark, sf, "pages").select(_cat("u", _c("page_id")).alias("url"), F.lit(2).alias("attempt"), last.alias("status"))
    states, stop = tables.probed(urls, p.unionByName(p.select("url", F.lit(1).alias("attempt"), F.lit(503).alias("status"))))
    plan = tables.upload_plan(urls.select("url", _cat("f", _c("k"), F.when(F.col("k") % 2 == 0, ".png").otherwise(".xyz")).alias("path")), states)
    rows = states.select("url", F.col("state").alias("what")).join(plan.select("url", F.coalesce("content_type", F.lit("unknown")).alias("plan")), "url", "left").withColumn("plan", F.coalesce("plan", F.lit("")))
    return rows.unionByName(stop.select(F.col("subject").alias("url"), F.lit("stop").alias("what"), F.col("detail").alias("plan")))


@query("""SELECT event_id, '{"id":' || event_id || ',"auth":{"api_key":"[redacted]","keep":"' || event_type || '"},"Token": "[redacted]"}' AS text FROM events""")
def redaction(spark, sf):
    """K5: secrets of request bodies at any depth."""
    t = F.concat(F.lit('{"id":'), _c("event_id"), F.lit(',"auth":{"api_key":"s\\"'), _c("user_id"), F.lit('","keep":"'), F.col("event_type"), F.lit('"},"Token": "'), _c("value"), F.lit('"}'))
    return table(spark, sf, "events").select("event_id", tables.redact(t).alias("text"))


@query("""
SELECT 'index' AS what, md5('# Parts' || chr(10) || chr(10) || string_agg('- [' || p_brand || CASE WHEN s = '' THEN '' ELSE ' (' || upper(s) || ')' END || '](' || p_partkey || '.md)', chr(10) ORDER BY p_brand, s, p_partkey || '.md') || chr(10)) AS text FROM (SELECT *, CASE WHEN p_size % 4 = 0 THEN '' ELSE lower(p_type) END AS s FROM part)
UNION ALL SELECT 'report', md5('{"count":' || count(*) || ',"missing":[' || string_agg('{"url":"u' || n_nationkey || '","referenced_by":["' || CASE WHEN n_name < 'M' THEN n_name || '","M' ELSE 'M","' || n_name END || '"]}', ',' ORDER BY 'u' || n_nationkey) || '],"year":2025}') FROM nation""")
def index_and_report(spark, sf):
    """An index file in index order, and a JSON report of what is missing."""
    n = F.col("p_size")
    entries = table(spark, sf, "part").select(F.col("p_brand").alias("label"), F.when(n % 4 != 0, F.lower("p_type")).alias("state"), _cat(_c("p_partkey"), ".md").alias("path"))
    missing = table(spark, sf, "nation").select(_cat("u", _c("n_nationkey")).alias("url"), F.array(F.col("n_name"), F.lit("M")).alias("referenced_by"))
    return sinks.index_text(entries, "Parts").select(F.lit("index").alias("what"), F.md5("content").alias("text")).unionByName(sinks.report(missing, year=F.lit(2025)).select(F.lit("report").alias("what"), F.md5("report").alias("text")))


@query("""
SELECT 'kinds' AS block, source AS key, count(*) AS n FROM documents GROUP BY source UNION ALL SELECT 'none', '-', 0
UNION ALL SELECT 'shapes', CASE WHEN doc_id % 5 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'section overview' ELSE 'container overview' END ELSE lang END, count(*) FROM documents GROUP BY 2""")
def run_report(spark, sf):
    """The counts of a run, block by block; an empty block shows that it is."""
    k = F.col("doc_id")
    d = table(spark, sf, "documents").select("source", F.col("lang").alias("kind"), (k % 5 == 0).alias("overview"), F.when(k % 2 != 0, "C1").alias("container_num"))
    r = sinks.run_report(("kinds", census.tally(d, F.col("source"))), ("none", census.tally(d.where("false"), F.col("source"))), ("shapes", census.tally(d, census.unit_shape().alias("shape"))))
    return r.withColumn("key", F.coalesce("key", F.lit("-")))


@query("""
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL '6 hours' THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT user_id AS session, count(*) AS events FROM s GROUP BY user_id, k""")
def session_spans(spark, sf):
    """ST1: sessions that end when nothing came for six hours, by the operator of the streaming form."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("session"), "ts", F.col("event_type").alias("type"))
    return sessions.session_windows(e, "6 hours").select("session", "events")
