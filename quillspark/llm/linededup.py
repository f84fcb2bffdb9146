"""Line dedup by winnowing over line hashes, with DataFrame functions only.

A *window* is the shortest run of lines from a given line on that has at least ``words`` words
(empty lines don't count). In each window the line with the least hash is its fingerprint, the
rightmost on a tie. Two equal runs of ``words`` words or more hold equal windows, and equal
windows choose equal fingerprints, so no such repeat is missed.

Fingerprints that stand at one position of the corpus only are dropped. The positions of the others
are joined, window by window: a window is matched with the first one of its content (128 bits) in
the order (doc_id, text digest, line). A match is extended to the left by the windows that begin at
earlier lines and to the right, line by line, by the shortest runs of ``words`` words that *end* at
later lines, each held against any earlier text. What agrees with one source at one distance (a
diagonal) is merged into a run; the union of a text's runs is deleted. So a line goes exactly if it
is in a run of ``words`` words or more that stands at an earlier position, too. No pairs of documents
are formed: groups only give their least member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import boxed, materialise, row_key, unboxed


def line_words(line: Column) -> Column:
    """The words of a line: what stands between spaces, tabs, carriage returns and form feeds."""
    return F.array_remove(F.split(F.translate(line, "\t\r\f\x0b", "    "), " "), "")


def line_table(docs: DataFrame) -> DataFrame:
    """__id, __key, __pos, __idx (among lines with words), __a, __b, __start, __end (in words) of each line with words.

    Hashes are taken before the exchange, so lines travel as 20 bytes; the grouping that brings a
    document together also drops rows that repeat both doc_id and text.
    """
    split = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), line_words)
    hashed = F.transform(split, lambda w: F.struct(F.xxhash64(w).alias("a"), F.xxhash64(F.lit("second"), w).alias("b"), F.size(w).alias("words")))
    per_doc = docs.select(F.col("doc_id").alias("__id"), row_key("doc_id", "text").alias("__key"), hashed.alias("__lines")).groupBy("__id", "__key").agg(F.first("__lines").alias("__lines"))
    lines = per_doc.select("__id", "__key", F.posexplode("__lines").alias("__pos", "__l")).where("__l.words > 0")
    upto = Window.partitionBy("__id", "__key").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    words = F.col("__l.words").cast("long")
    end = F.sum(words).over(upto)
    return lines.select("__id", "__key", "__pos", F.count(F.lit(1)).over(upto).alias("__idx"), F.col("__l.a").alias("__a"), F.col("__l.b").alias("__b"), (end - words).alias("__start"), end.alias("__end"))


def windows(lines: DataFrame, words: int) -> DataFrame:
    """The shortest runs of ``words`` words that begin at a line, and those that end at a line and don't
    begin so: fingerprint (__a, __b), __digest, __pos and __last (lines), __idx and __to (lines with words)."""
    doc = Window.partitionBy("__id", "__key")
    spans = {"f": doc.orderBy("__start").rangeBetween(0, words - 1), "b": doc.orderBy("__end").rangeBetween(1 - words, 0)}
    both = lines
    for k, span in spans.items():
        # a run's lines become its digest before the next sort, so that rows stay short
        lists = both.select("*", F.collect_list(F.struct("__a", "__b")).over(span).alias("__content"), F.min(F.struct("__a", "__b", (-F.col("__pos")).alias("__neg"))).over(span).alias("__f"), *((F.min if k == "b" else F.max)(c).over(span).alias(f"__far_{c}") for c in ("__pos", "__idx", "__start" if k == "b" else "__end")))
        digest = F.struct(F.xxhash64("__content").alias("a"), F.xxhash64(F.lit("second"), "__content").alias("b"))
        if k == "f":
            ends = [F.col(c).alias(n) for c, n in (("__pos", "__pos"), ("__far___pos", "__last"), ("__idx", "__idx"), ("__far___idx", "__to"))]
            full = F.col("__far___end") - F.col("__start") >= words
        else:
            ends = [F.col(c).alias(n) for c, n in (("__far___pos", "__pos"), ("__pos", "__last"), ("__far___idx", "__idx"), ("__idx", "__to"))]
            # one that has enough words without its last line is no run that begins so
            full = (F.col("__end") - F.col("__far___start") >= words) & (F.col("__start") - F.col("__far___start") >= words)
        run = F.when(full, F.struct(*ends, F.col("__f.__a").alias("__a"), F.col("__f.__b").alias("__b"), (-F.col("__f.__neg")).alias("__at"), digest.alias("__digest")))
        both = lists.select(*both.columns, run.alias(f"__run_{k}"))
    return both.select("__id", "__key", F.explode(F.array("__run_f", "__run_b")).alias("__w")).where("__w is not null").select("__id", "__key", "__w.*")


def repeated_runs(docs: DataFrame, words: int = 50) -> DataFrame:
    """Maximal runs that repeat earlier text, by source: __id, __key, __pos, __last (lines of the run), __from
    (the source's __id, __key, __pos). A run that several texts agree with in parts comes in parts, which may overlap."""
    w = materialise(windows(line_table(docs), words), "linededup")
    place = F.struct("__id", "__key", "__at")
    # written and joined by hint, so that both sides of the join are exchanges that Spark can split where a key is hot
    repeated = materialise(w.groupBy("__a", "__b").agg(F.min(place).alias("__lo"), F.max(place).alias("__hi")).where("__lo < __hi").select("__a", "__b"), "linededup-fingerprints")
    around = materialise(w.join(repeated.hint("merge"), ["__a", "__b"]).drop("__a", "__b", "__at"), "linededup-around")
    here = F.struct("__id", "__key", "__pos", "__idx")
    first = around.groupBy("__digest").agg(F.min(here).alias("__first"), F.max(here).alias("__far")).where("__first < __far").select("__digest", "__first")
    matched = around.join(materialise(first, "linededup-first").hint("merge"), "__digest").where(here > F.col("__first"))
    m = matched.select("__id", "__key", "__pos", "__last", "__idx", "__to", F.col("__first.__id").alias("__sid"), F.col("__first.__key").alias("__skey"), F.col("__first.__pos").alias("__spos"), (F.col("__idx") - F.col("__first.__idx")).alias("__diag"))
    diagonal = Window.partitionBy("__id", "__key", "__sid", "__skey", "__diag").orderBy("__idx", "__to")
    reach = F.max("__to").over(diagonal.rowsBetween(Window.unboundedPreceding, -1))
    m = m.withColumn("__new", F.when(reach >= F.col("__idx") - 1, 0).otherwise(1))
    m = m.withColumn("__run", F.sum("__new").over(diagonal.rowsBetween(Window.unboundedPreceding, 0)))
    source = F.struct(F.col("__sid").alias("__id"), F.col("__skey").alias("__key"), F.min("__spos").alias("__pos"))
    return m.groupBy("__id", "__key", "__sid", "__skey", "__diag", "__run").agg(F.min("__pos").alias("__pos"), F.max("__last").alias("__last"), source.alias("__from")).select("__id", "__key", "__pos", "__last", "__from")


def repeated_lines(docs: DataFrame, words: int = 50) -> DataFrame:
    """__id, __key and the array __gone of line numbers to delete, for documents that have any."""
    return repeated_runs(docs, words).groupBy("__id", "__key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("__pos", "__last"))))).alias("__gone"))


def dedup_lines(docs: DataFrame, words: int = 50) -> DataFrame:
    """``docs`` with later repeated runs of lines cut from ``text``, and n_lines, n_removed (long).

    Lines are compared word by word, so white space between words doesn't matter. A null text
    stays null (n_lines 0); an empty one has one empty line. Rows that repeat both doc_id and
    text count once as a source and share one result; a null doc_id comes before all others. Other
    columns pass, whatever their names; columns named n_lines and n_removed are replaced. All
    documents stay, also those of which no line is left (their text is empty). Empty lines inside a
    deleted run go with it. A run that repeats itself at once (one line over and over) keeps one period.
    """
    gone = repeated_lines(docs, words)
    d, keep = boxed(docs, ("n_lines", "n_removed"))
    j = d.join(gone.drop("__id"), "__key", "left")
    old = unboxed("text")
    lines = F.split(old, "\n", -1)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone")), lambda i: F.get(lines, i))
    text = F.when(F.col("__gone").isNull(), old).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(old.isNull(), 0).otherwise(F.size(lines)).cast("long")
    removed = F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long")
    return j.select(*(text.alias(c) if c == "text" else unboxed(c) for c in keep), n_lines.alias("n_lines"), removed.alias("n_removed"))


def oracle(documents: str = "documents", words: int = 50) -> str:
    """DuckDB SQL by maximal common runs: pairs of equal lines, one earlier, in islands on their diagonals; runs of ``words`` words go."""
    return f"""
    WITH l AS (
      SELECT doc_id, i - 1 AS pos, ls[i] AS line, len(ls) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {documents} WHERE text IS NOT NULL) t, unnest(range(1, len(ls) + 1)) AS u(i)
    ), w AS (
      SELECT doc_id, pos, list_filter(string_split(translate(line, chr(9) || chr(13) || chr(12) || chr(11), '    '), ' '), lambda x: x <> '') AS ws FROM l
    ), s AS (
      SELECT doc_id, pos, array_to_string(ws, ' ') AS words, len(ws) AS k, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM w WHERE len(ws) > 0
    ), pair AS (
      SELECT b.doc_id, b.pos, b.i, b.k, a.doc_id AS src, b.i - a.i AS diag FROM s a JOIN s b ON a.words = b.words AND (a.doc_id < b.doc_id OR a.doc_id = b.doc_id AND a.i < b.i)
    ), island AS (
      SELECT *, i - row_number() OVER (PARTITION BY doc_id, src, diag ORDER BY i) AS g FROM pair
    ), run AS (
      SELECT doc_id, min(pos) AS lo, max(pos) AS hi FROM island GROUP BY doc_id, src, diag, g HAVING sum(k) >= {words}
    ), gone AS (
      SELECT DISTINCT doc_id, p AS pos FROM run, unnest(range(lo, hi + 1)) AS u(p)
    )
    SELECT l.doc_id, max(l.n)::BIGINT AS n_lines, count(g.pos)::BIGINT AS n_removed, coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
    FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id
    """
