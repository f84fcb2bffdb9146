"""Guards: each gives a table of violations; a run writes only if all of them are empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators import positions
from quillspark.session import cut

VIOLATION = ("guard", "subject", "detail")


def violation(df: DataFrame, guard: str, subject: str, detail: str) -> DataFrame:
    """Rows of any guard in the common form."""
    return df.select(F.lit(guard).alias("guard"), F.col(subject).cast("string").alias("subject"), F.expr(detail).cast("string").alias("detail"))


def gathered(*violations: DataFrame) -> DataFrame:
    """All violations in one table: nothing is lost by stopping at the first."""
    return reduce(DataFrame.unionByName, violations)


def require_none(violations: DataFrame, most: int = 20) -> None:
    """Raise with the first violations and their number; evaluated and written once, before anything else is."""
    violations = cut(violations, "violations")
    rows = violations.orderBy(*VIOLATION).limit(most + 1).collect()
    if rows:
        more = violations.count() - min(len(rows), most)
        raise ValueError("\n".join([*(f"{r.guard}: {r.subject}: {r.detail}" for r in rows[:most]), *([f"… and {more} more"] if more > 0 else [])]))


def unique(records: DataFrame, key: str) -> DataFrame:
    """Keys that several records claim."""
    return violation(records.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "unique", key, "concat(n, ' records')")


def linked(units: DataFrame, rulings: DataFrame) -> DataFrame:
    """Clauses without a page, unless ruled."""
    from quillspark.operators.joins import ruled

    keys = ["volume", "kind", "id", "state"]
    return violation(ruled(units.where("url is null and kind = 'clause'"), rulings, keys).where("ruling is null"), "linked", "unit", "'no page'")


def parity(deltas: DataFrame) -> DataFrame:
    """Counts that differ from what is expected."""
    return violation(deltas.where("delta <> 0").withColumn("__k", F.concat_ws("/", "doc", "parent")), "parity", "__k", "concat('off by ', delta)")


def rendered(units: DataFrame) -> DataFrame:
    """C4: units that no rule renders."""
    return violation(units.where("error is not null"), "rendered", "unit", "error")


def fired(declared: DataFrame, used: DataFrame, superseded: DataFrame, key: str) -> DataFrame:
    """Rulings that nothing needed."""
    from quillspark.operators.ordered import dead

    return violation(dead(declared, used, superseded, key), "ruling fired", key, "'never used'")


def stated(pointers: DataFrame) -> DataFrame:
    """Pointers without an identity."""
    return violation(pointers.where("id is null or id = ''"), "identity stated", "ref", "'no identity'")


def forward_references(found: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """References found but not listed, or listed but not found."""
    from quillspark.operators.ordered import both_ways

    return violation(both_ways(found, listed, key), "forward reference", key, "side")


def partial_scope(writes: DataFrame, shared_dir: str, whole: bool) -> DataFrame:
    """A run over a part must not write what belongs to the whole (shared folder, indexes)."""
    bad = writes.where(F.col("path").contains(f"/{shared_dir}/") | F.col("path").endswith("INDEX.md"))
    return violation(bad.where(F.lit(not whole)), "partial run", "path", "'belongs to a whole run'")


def one_edition(urls: DataFrame, edition: str) -> DataFrame:
    """C11: links of another edition."""
    return violation(urls.where(F.col("edition") != edition), "edition", "url", "concat('edition ', edition)")


def plausible(urls: DataFrame, least: int = 100) -> DataFrame:
    """A list of links too short to be a whole crawl."""
    return violation(urls.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < least).withColumn("list", F.lit("links")), "plausible", "list", "concat('only ', n)")


def evidenced(rulings: DataFrame, least: int = 80) -> DataFrame:
    """Rulings without enough evidence."""
    return violation(rulings.where((F.length("evidence") < least) | F.col("evidence").isNull()), "evidence", "id", "concat(coalesce(length(evidence), 0), ' characters')")


def indexed(index: DataFrame) -> DataFrame:
    """C14: index entries outside their edition, or listed twice."""
    out = violation(index.where(~F.col("path").startswith(F.concat("edition", F.lit("/")))), "index", "path", "'outside its edition'")
    return out.unionByName(violation(index.groupBy("edition", "path").count().where("count > 1"), "index", "path", "'listed twice'"))


def acceptance(corpus: DataFrame, most_bytes: int = 131072) -> DataFrame:
    """Checks of a finished corpus (path, clause, kind, citation, content): lead token equals clause, citation and URL near the top, paragraphs on one line, size."""
    from quillspark.functions.text import designation

    lead = F.regexp_extract("path", r"([^/]+?)(?:-[^/]*)?\.md$", 1)
    name = F.regexp_extract("path", r"([^/]+)\.md$", 1)
    token = designation(F.col("clause"))
    a = violation(corpus.where(F.col("clause").isNotNull() & ~(name.startswith(F.concat(token, F.lit("-"))) | (name == token))).withColumn("__lead", lead), "lead token", "path", "concat('clause ', clause)")
    head = F.array_join(F.slice(F.split("content", "\n"), 1, 7), "\n")
    b = violation(corpus.where(~F.contains(head, F.lit("citation: "))), "citation near top", "path", "'no citation'")
    c = violation(corpus.where(F.octet_length("content") > most_bytes), "size", "path", "concat(octet_length(content), ' bytes')")
    return gathered(a, b, c)


def exact_names(corpus: DataFrame) -> DataFrame:
    """#1: a file name leads with a clause's token exactly if the file is that clause's; of one clause, volume and
    jurisdiction there is one file, and it lies in the volume's folder. corpus: path, clause, volume, jurisdiction."""
    from quillspark.functions.text import designation

    named = corpus.withColumn("__token", designation(F.col("clause"))).withColumn("__lead", F.substring_index(F.regexp_extract("path", r"([^/]+)\.md$", 1), "-", 1)).withColumn("__dir", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
    clauses = named.where("clause is not null")
    tokens = clauses.select(F.col("__token").alias("__lead")).distinct()
    hits = named.join(tokens, "__lead", "left_semi").where("clause is null or __token <> __lead")
    lost = clauses.where("__token <> __lead")
    twins = clauses.groupBy("clause", "volume", "jurisdiction").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("__k", F.concat_ws("|", "clause", "volume", "jurisdiction"))
    return gathered(
        violation(hits, "wrong hit", "path", "concat('found as ', __lead)"), violation(lost, "lost name", "path", "concat('clause ', clause)"),
        violation(twins, "two files of one clause", "__k", "concat(n, ' files')"), violation(clauses.where("not (__dir <=> volume)"), "outside its volume", "path", "volume"),
    )


def phrases_present(corpus: DataFrame, phrases: list[str]) -> DataFrame:
    """#2, #3: phrases that no line of any file holds whole."""
    wanted = corpus.sparkSession.createDataFrame([(p,) for p in phrases], "phrase string")
    there = positions.lines_with(positions.index(corpus, "path", "content", lines=True), phrases).select("phrase").distinct()
    return violation(wanted.join(there, "phrase", "left_anti"), "phrase", "phrase", "'in no line'")


def cited_reachable(corpus: DataFrame, kind: str, whole: bool, ruled: DataFrame | None = None) -> DataFrame:
    """#4, #8: what a file cites (a figure or a table) is in that file, or in files of one clause only; in a whole
    corpus it is somewhere, unless ``ruled`` (path, key) says that the source names what isn't there."""
    from quillspark.functions.text import JURISDICTIONS, fig_key

    if kind == "figure":
        shown, cited = r"!?\[Figure([^\]]*)\]", rf"(?i)\bsee Figure (?:(?:{'|'.join(JURISDICTIONS)})\s+)?([A-Za-z0-9][A-Za-z0-9.]*)"
        text, key = F.col("content"), fig_key
    else:
        shown, cited = r"(?m)^>?\s*#{2,4} Table ([^\s—|]+)", rf"\bTable (?:(?:{'|'.join(JURISDICTIONS)}) )?([A-Z][0-9]+[A-Z][0-9]+[a-z]?)\b"
        text, key = F.regexp_replace("content", r"(?m)^>?\s*#{2,4} Table .*$", ""), F.lower
    found = lambda t, p: F.explode(F.array_distinct(F.regexp_extract_all(t, F.lit(p), F.lit(1))))
    at = corpus.select("path", F.coalesce("clause", "path").alias("__of"), found(F.col("content"), shown).alias("__raw")).select("path", "__of", key(F.col("__raw")).alias("key")).where("key <> ''").distinct()
    refs = corpus.select("path", found(text, cited).alias("__raw")).select("path", key(F.col("__raw")).alias("key")).distinct()
    homes = at.groupBy("key").agg(F.count_distinct("__of").alias("n"))
    open_ = refs.join(at.select("path", "key"), ["path", "key"], "left_anti").join(homes, "key", "left")
    lost = open_.where("n is null") if whole else open_.where("false")
    if ruled is not None:
        lost = lost.join(ruled, ["path", "key"], "left_anti")
    return violation(open_.where("n > 1"), f"cited {kind}", "path", "concat(key, ' is in ', n, ' clauses')").unionByName(violation(lost, f"cited {kind}", "path", "concat(key, ' is nowhere')"))


def self_citing(corpus: DataFrame, permitted: DataFrame, lines: int = 7) -> DataFrame:
    """#5: citation within the first lines, and the address of clauses; ``permitted`` (path) have none, and must not have one."""
    head = F.array_join(F.slice(F.split("content", "\n"), 1, lines), "\n")
    c = corpus.withColumn("__cited", F.contains(head, F.lit("citation: "))).withColumn("__linked", F.contains(head, F.lit("web_url: ")))
    c = c.join(permitted.select("path", F.lit(True).alias("__free")).distinct(), "path", "left").withColumn("__free", F.coalesce("__free", F.lit(False)))
    return gathered(
        violation(c.where("not __cited"), "citation near top", "path", "'no citation'"),
        violation(c.where("clause is not null and not __free and not __linked"), "address near top", "path", "'no address'"),
        violation(c.where("clause is not null and __free and __linked"), "address near top", "path", "'has an address after all'"),
    )


def bare_labels(corpus: DataFrame) -> DataFrame:
    """#7: labels with nothing under them: list labels that host nothing deeper, subclause numbers before another one,
    a heading or the end, and callout labels that stand alone."""
    body = F.regexp_replace("content", r"(?s)\A---\n.*?\n---\n", "")
    w = Window.partitionBy("path").orderBy("pos")
    line = corpus.select("path", F.posexplode(F.split(body, "\n")).alias("pos", "line")).withColumn("quoted", F.col("line").startswith(">"))
    line = line.withColumn("alone", ~F.coalesce(F.lag("quoted").over(w), F.lit(False)) & ~F.coalesce(F.lead("quoted").over(w), F.lit(False)))
    bare = F.regexp_replace("line", r"^>\s?", "")
    line = line.withColumn("bare", bare).where("trim(bare) <> ''").withColumn("indent", F.length("bare") - F.length(F.ltrim("bare")))
    after = F.lead(F.struct("quoted", "bare", "indent")).over(w)
    line = line.withColumn("next", after).withColumn("same", F.coalesce(F.col("next.quoted") == F.col("quoted"), F.lit(False)))
    number = r"^\s*\*\*\([^)]*\)\*\*\s*$"
    item = F.col("bare").rlike(r"^\s*(\(([ivxlcdm]+|[IVXLCDM]+|[A-Za-z]|[0-9]+)\)|[-*])\s*$") & ~(F.col("same") & (F.col("next.indent") > F.col("indent")))
    sub = F.col("bare").rlike(number) & ~(F.col("same") & ~F.col("next.bare").rlike(number) & ~F.ltrim(F.col("next.bare")).rlike("^#{1,6} "))
    box = F.col("quoted") & F.col("alone") & F.trim("bare").rlike(r"^\*\*[^*].*\*\*$") & ~F.col("bare").rlike(number)
    return violation(line.where(item | sub | box), "bare label", "path", "concat('line ', pos + 1, ' of the body: ', line)")


def caveats(corpus: DataFrame, token: str, listed: DataFrame) -> DataFrame:
    """#9: the note of retained text stands once, as a paragraph of its own below the heading, in the files that the index lists (path) and in no other."""
    lines = F.split("content", "\n")
    own = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).startswith(token))
    at = F.get(own, F.lit(0))
    alone = (F.get(lines, at - 1) == "") & F.coalesce(F.get(lines, at + 1) == "", F.lit(False))
    below = F.exists(F.slice(lines, F.lit(1), F.greatest(at, F.lit(0))), lambda x: x.startswith("# "))
    c = corpus.where(F.contains("content", F.lit(token))).select("path", F.size(own).alias("n"), F.coalesce(alone & below, F.lit(False)).alias("ok"))
    from quillspark.operators.ordered import both_ways

    sides = both_ways(c, listed, "path")
    return gathered(violation(c.where("n <> 1"), "caveat", "path", "concat(n, ' times')"), violation(c.where("n = 1 and not ok"), "caveat", "path", "'not a paragraph below the heading'"), violation(sides, "caveat and index", "path", "side"))


def acceptance_pack(corpus: DataFrame, phrases: list[str], permitted: DataFrame, token: str, listed: DataFrame, whole: bool, most_bytes: int = 131072) -> DataFrame:
    """C13, all nine checks of a finished corpus (path, clause, volume, jurisdiction, content) in one table of violations."""
    large = violation(corpus.where(F.octet_length("content") > most_bytes), "size", "path", "concat(octet_length(content), ' bytes')")
    return gathered(exact_names(corpus), phrases_present(corpus, phrases), cited_reachable(corpus, "figure", whole), self_citing(corpus, permitted), large, bare_labels(corpus), cited_reachable(corpus, "table", whole), caveats(corpus, token, listed))
