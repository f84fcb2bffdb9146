from edges import brief, empty, odd
from oracle import connect, same

from quillspark.llm import linededup, queries


def brute(docs, words):
    """The longest common run of every line with every earlier one of equal words, in the order of doc_id; runs of
    enough words go, with the empty lines inside them."""
    seen, gone = {}, {}
    for doc, text in sorted(docs):
        lines = [(i, tuple(x.split())) for i, x in enumerate((text or "").split("\n")) if x.split()]
        for a, (_, x) in enumerate(lines):
            for other, b in seen.setdefault(x, []):
                n = k = 0
                while a + k < len(lines) and b + k < len(other) and lines[a + k][1] == other[b + k][1]:
                    n += len(lines[a + k][1])
                    k += 1
                if n >= words:
                    gone.setdefault(doc, set()).update(range(lines[a][0], lines[a + k - 1][0] + 1))
            seen[x].append((lines, a))
    return {d: "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone.get(d, ())) for d, t in docs}


def test_query_equals_sql(spark, sf):
    same(queries.op3_linededup(spark, sf), connect(sf), linededup.oracle())


def test_against_brute_force(spark):
    import random

    r = random.Random(5)
    pool = [" ".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9))) for _ in range(12)]
    docs = [(i, "\n".join(r.choice([*pool, "", str(r.random())]) for _ in range(r.randint(1, 25)))) for i in range(120)]
    got = {x["doc_id"]: x["text"] for x in linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), words=10).collect()}
    assert got == brute(docs, 10)


def test_planted_passage(spark):
    p = "\n".join(f"w{i} of a passage that is here" for i in range(8))
    docs = [(1, "own start\n" + p), (2, p + "\nown end"), (3, "only\nown lines"), (4, "x\n" + p.replace(" of ", "   of\t") + "\ny")]
    got = {x["doc_id"]: (x["text"], x["n_removed"]) for x in linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (docs[0][1], 0), 2: ("own end", 8), 3: (docs[2][1], 0), 4: ("x\ny", 8)}


def test_runs_end_where_the_texts_part(spark):
    line = lambda n, name: " ".join(f"{name}{i}" for i in range(n))
    a, b, c = line(60, "a"), line(10, "b"), line(8, "c")
    docs = [(1, "\n".join([a, b, c, "one end"])), (2, "\n".join(["start", a, b, c, "other end"])), (3, "\n".join([c, b, a, "third"])), (4, "\n".join(["x", c, b, a])), (5, "\n".join([b, c]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x["doc_id"]: (x["text"], x["n_removed"]) for x in linededup.dedup_lines(df).collect()}
    assert got == {1: (docs[0][1], 0), 2: ("start\nother end", 3), 3: ("\n".join([c, b, "third"]), 1), 4: ("x", 3), 5: (docs[4][1], 0)}
    runs = {(r["__id"], r["__pos"], r["__last"], r["__from"]["__id"], r["__from"]["__pos"]) for r in linededup.repeated_runs(df).collect()}
    # the line of 60 words is first in document 1, what stands before it in document 4 is first in document 3
    assert runs == {(2, 1, 3, 1, 0), (3, 2, 2, 1, 0), (4, 1, 3, 3, 0), (4, 3, 3, 1, 0)}


def test_odd_rows(spark):
    got = linededup.dedup_lines(odd(spark)).collect()
    assert len(got) == odd(spark).count() and {"kept", "score", "__key", "__id"} <= set(got[0].asDict())
    by = {(r["doc_id"], r["text"]): (r["n_lines"], r["n_removed"]) for r in got}
    assert by[(2, None)] == (0, 0) and by[(3, "")] == (1, 0) and by[(None, None)] == (0, 0)
    assert [r["n_removed"] for r in got if r["doc_id"] == 6] == [39]  # each window of equal lines but the first repeats it: one line is left
    assert linededup.dedup_lines(empty(spark)).count() == 0
    assert linededup.dedup_lines(brief(spark), words=3).count() == brief(spark).count()
