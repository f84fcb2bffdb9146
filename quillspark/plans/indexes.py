"""Index files put together from ordered segments: a root index, and one for each edition.

An index has a head of sections (census, gaps, retention, amendment) and its entries in index order.
All lines of all files are one ordered table; their places come from ranges of that order, and lines
are joined to segments of so many, so that no row and no task holds a whole file. A file is its segments in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators import scan
from quillspark.session import cut

LINE = ("file", "part", "label", "state", "path", "line")


def _line(df: DataFrame, file: Column, part: int, line: Column, label: Column | None = None, state: Column | None = None, path: Column | None = None) -> DataFrame:
    key = lambda c: (F.lit("") if c is None else F.coalesce(c, F.lit("")))
    return df.select(file.alias("file"), F.lit(part).alias("part"), key(label).alias("label"), key(state).alias("state"), key(path).alias("path"), line.alias("line"))


def _files(n: Column) -> Column:
    return F.concat(n.cast("string"), F.when(n == 1, " file").otherwise(" files"))


def index_lines(entries: DataFrame, gaps: DataFrame, retained: DataFrame, amendments: DataFrame) -> DataFrame:
    """Lines (file, part, label, state, path, line) of all indexes; in a file they stand by part, label, state and path.

    entries: edition, kind, dir, label, state, path. gaps (edition, gap): what is known to be missing.
    retained (edition, site, file): where text of an earlier state is kept. amendments (edition,
    amendment): null or no row gives "unknown". The counts are one aggregate with grouping sets: files by
    kind, by folder, by edition and of all.
    """
    e = entries.select("edition", "kind", "dir", "label", F.coalesce("state", F.lit("")).alias("state"), "path")
    n = e.groupingSets([["edition", "kind"], ["edition", "dir"], ["edition"], []], "edition", "kind", "dir").agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
    n = cut(n, "census")
    by_kind, by_dir, by_edition, total = (n.where(F.col("g") == g) for g in (1, 2, 3, 7))
    editions = e.select("edition").distinct()
    name = F.concat("edition", F.lit("/INDEX.md"))
    root = F.lit("INDEX.md")
    kinds = by_kind.groupBy("edition").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("kind", "n"))), lambda x: F.concat(x["kind"], F.lit(" "), x["n"])), ", ").alias("kinds"))
    dated = editions.join(amendments.groupBy("edition").agg(F.max("amendment").alias("amendment")), "edition", "left")
    sites = editions.join(retained.groupBy("edition").agg(F.count_distinct("site").alias("sites"), F.count_distinct("file").alias("files")), "edition", "left").na.fill(0)
    told = gaps.join(editions, "edition", "left_semi").select("edition", "gap").distinct()
    untold = editions.join(told.select("edition").distinct(), "edition", "left_anti")
    shown = F.concat(F.lit("- ["), F.col("label"), F.when(F.col("state") != "", F.concat(F.lit(" ("), F.upper("state"), F.lit(")"))).otherwise(""), F.lit("]("), F.col("path"), F.lit(")"))
    parts = [
        _line(total, root, 0, F.concat(F.lit("# Index\n\nAll editions: "), _files(F.col("n")), F.lit("\n"))),
        _line(by_edition.join(kinds, "edition"), root, 1, F.concat(F.lit("- ["), "edition", F.lit("]("), name, F.lit("): "), _files(F.col("n")), F.lit(" ("), "kinds", F.lit(")")), F.col("edition")),
        _line(by_edition, name, 0, F.concat(F.lit("# "), "edition", F.lit("\n\n"), _files(F.col("n")), F.lit("\n\n## Folders\n"))),
        _line(by_dir, name, 1, F.concat(F.lit("- "), "dir", F.lit(": "), _files(F.col("n"))), F.col("dir")),
        _line(editions, name, 2, F.lit("\n## Known gaps\n")),
        _line(told, name, 3, F.concat(F.lit("- "), "gap"), F.col("gap")),
        _line(untold, name, 3, F.lit("None is known.")),
        _line(sites, name, 4, F.when(F.col("sites") == 0, "\nNo text of an earlier state is kept.").otherwise(F.concat(F.lit("\nText of an earlier state is kept in "), F.col("sites").cast("string"), F.when(F.col("sites") == 1, " place of ").otherwise(" places of "), _files(F.col("files")), F.lit(".")))),
        _line(dated, name, 5, F.concat(F.lit("\nAmendment: "), F.coalesce("amendment", F.lit("unknown")), F.lit("\n\n## Files\n"))),
        _line(e, name, 6, shown, F.col("label"), F.col("state"), F.col("path")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def segments(lines: DataFrame, most: int = 1000) -> DataFrame:
    """(file, segment, text): lines in their order, ``most`` to a segment from 0 on; each line ends with a line feed.
    A file's content is its segments one after the other. Lines that agree in all keys are ordered by themselves."""
    placed = scan.places(lines, list(LINE))
    first = placed.groupBy("file").agg(F.min("place").alias("__first"))
    numbered = placed.join(first, "file").withColumn("n", F.col("place") - F.col("__first"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: F.concat(x["line"], F.lit("\n"))), "")
    return numbered.groupBy("file", F.floor(F.col("n") / most).alias("segment")).agg(text.alias("text"))
