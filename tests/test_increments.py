import random

from quillspark.operators import fold
from quillspark.plans import increments, indexes

SCHEMA = "path string, kind string, doc string, ord long, content string, prefix string"


def records(r, n, start=0):
    return [(f"p{r.randint(0, 25)}", r.choice(["glossary", "clause"]), f"v{r.randint(0, 4)}", start + i, r.choice(["x", "y", "v1/a", "v2/a"]), "v1") for i in range(n)]


def plain(rows):
    return sorted((r.path, r.outcome, r.canonical, r.records, r.contents, r.classes, tuple(r.documents)) for r in rows)


def test_deltas_equal_one_fold(spark):
    r = random.Random(2)
    a, b = records(r, 80), records(r, 50, 100)
    df = lambda x: spark.createDataFrame(x, SCHEMA)
    gone = [x for x in a if x[2] == "v3"] + [x for x in b if x[0] == "p7"]
    replaced = [(*a[0][:4], "other", "v1")] if a[0] not in gone else []
    left = [x for x in a + b if x not in gone and not (replaced and x == a[0])] + replaced
    keys = lambda x: spark.createDataFrame([(p, o) for p, _, _, o, _, _ in x], "path string, ord long")
    state = increments.Folded(8)
    for added, out in ((df(a), None), (df(b), None), (df(replaced) if replaced else None, keys(gone + ([a[0]] if replaced else []))), (None, None), (None, keys(gone))):
        state = increments.advance(spark, state, added, out)
    assert plain(increments.outcomes(spark, state).collect()) == plain(fold.resolve_unique(df(left)).collect())


def test_untouched_buckets_stay(spark):
    r = random.Random(5)
    first = increments.advance(spark, increments.Folded(16), spark.createDataFrame(records(r, 60), SCHEMA))
    again = increments.advance(spark, first, spark.createDataFrame([("p3", "clause", "v9", 999, "new", "v1")], SCHEMA))
    changed = [b for b in first.records.keys() | again.records.keys() if first.records.get(b) != again.records.get(b)]
    assert len(changed) == 1 and len(first.records) > 3
    assert [b for b in first.outcomes if first.outcomes[b] != again.outcomes[b]] == changed
    nothing = increments.advance(spark, again, None, spark.createDataFrame([], "path string, ord long"))
    assert nothing is again
    whole = increments.advance(spark, again, None, spark.createDataFrame([("p3", 999)], "path string, ord long"))
    assert plain(increments.outcomes(spark, whole).collect()) == plain(increments.outcomes(spark, first).collect())


def test_index_in_segments(spark):
    entries = [("2022", "clause", "v1", "A1", None, "v1/a.md"), ("2022", "page", "v2", "A1", "nsw", "v2/a.md"), ("2022", "clause", "v1", "A10", None, "v1/b.md"), ("2025", "clause", "v1", "B", None, "c.md")]
    e = spark.createDataFrame(entries, "edition string, kind string, dir string, label string, state string, path string")
    gaps = spark.createDataFrame([("2022", "Part G"), ("2022", "Part G"), ("1999", "x")], "edition string, gap string")
    kept = spark.createDataFrame([("2022", 1, "f"), ("2022", 2, "f")], "edition string, site int, file string")
    lines = indexes.index_lines(e, gaps, kept, spark.createDataFrame([("2022", "A2")], "edition string, amendment string"))
    for most in (1000, 3):
        parts = indexes.segments(lines, most).orderBy("file", "segment").collect()
        assert [r.segment for r in parts if r.file == "INDEX.md"] == ([0] if most == 1000 else [0]) and all(r.text.count("\n") > 0 for r in parts)
        files = {f: "".join(r.text for r in parts if r.file == f) for f in {r.file for r in parts}}
        assert files["INDEX.md"] == "# Index\n\nAll editions: 4 files\n\n- [2022](2022/INDEX.md): 3 files (clause 2, page 1)\n- [2025](2025/INDEX.md): 1 file (clause 1)\n"
        assert files["2022/INDEX.md"] == "# 2022\n\n3 files\n\n## Folders\n\n- v1: 2 files\n- v2: 1 file\n\n## Known gaps\n\n- Part G\n\nText of an earlier state is kept in 2 places of 1 file.\n\nAmendment: A2\n\n## Files\n\n- [A1](v1/a.md)\n- [A1 (NSW)](v2/a.md)\n- [A10](v1/b.md)\n"
        assert "None is known.\n\nNo text of an earlier state is kept.\n\nAmendment: unknown\n" in files["2025/INDEX.md"]
    assert indexes.segments(lines.limit(0)).count() == 0
