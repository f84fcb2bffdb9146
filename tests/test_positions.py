import random
from collections import Counter

import pytest

from quillspark.operators import guards, positions, search


def test_passages_by_words(spark):
    p = spark.createDataFrame([(1, "a  b"), (2, "one two three four five six seven eight nine"), (3, " "), (4, None), (5, "zz"), (1, "a b"), (None, "a b")], "item_id int, text string")
    t = spark.createDataFrame([(1, "x a\nb y"), (2, "xa b"), (3, "0 one two three four five six seven eight nine"), (4, None), (5, ""), (6, "one two three four five six seven eight"), (1, "x a b"), (None, "a b")], "doc_id int, text string")
    assert sorted((r["item_id"], r["doc_id"]) for r in positions.containment(p, t).collect()) == [(1, 1), (2, 3)]
    assert positions.containment(p.where("false"), t).count() == 0 and positions.containment(p, t.where("false")).count() == 0


def test_passages_against_contains(spark):
    r = random.Random(4)
    word = lambda: r.choice(["the", "the", "the", "of", "of", "a", "b", "rare", f"w{r.randint(0, 30)}"])
    texts = [(i, " ".join(word() for _ in range(r.randint(0, 80)))) for i in range(60)]
    passages = [(i, " ".join(word() for _ in range(r.randint(1, 4)))) for i in range(80)]
    for i in range(80, 100):
        w = r.choice([t for _, t in texts if len(t.split()) > 9]).split()
        passages.append((i, "  ".join(w[(k := r.randint(0, 2)) : k + r.randint(3, 7)])))
    want = {(i, d) for i, p in passages for d, t in texts if f" {' '.join(p.split())} " in f" {t} "}
    got = [tuple(x) for x in positions.containment(spark.createDataFrame(passages, "item_id int, text string"), spark.createDataFrame(texts, "doc_id int, text string")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_lines_against_contains(spark):
    r = random.Random(9)
    piece = lambda: r.choice(["of", "the", "them", "loft", "he", " ", "", "a-b", "x"])
    texts = [(i, "\n".join(" ".join(piece() for _ in range(r.randint(0, 8))) for _ in range(r.randint(0, 5)))) for i in range(70)] + [(70, None), (3, "of the")]
    phrases = ["of the", "of", "t he", "the  of", " the", "the ", "he a-b x", "of\nthe", "nowhere", " ", "loft  "]
    index = positions.index(spark.createDataFrame(texts, "doc_id int, text string"), lines=True)
    want = Counter((p, d, sum(p in x for x in t.split("\n"))) for d, t in texts if t for p in phrases if any(p in x for x in t.split("\n")))
    assert Counter(map(tuple, search.phrases(index, phrases).select("phrase", "path", "lines").collect())) == want
    assert search.phrases(index, []).count() == 0
    with pytest.raises(ValueError):
        search.phrases(index, ["x", ""])


def test_words_that_would_do_don_t_multiply_candidates(spark, monkeypatch):
    n = 40
    texts = spark.createDataFrame([(i, f"x{i}of the{i} y of the{i} then") for i in range(n)], "doc_id int, text string")
    written, cut = {}, positions.cut

    def counted(df, name="cut", by=()):
        out = cut(df, name, by)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(positions, "cut", counted)
    got = {kind: sorted(map(tuple, search.phrases(index, ["of the", "y of the"]).collect())) for kind, index in (("all", positions.index(texts, lines=True)), ("few", positions.index(texts, lines=True, phrases=["of the", "y of the"])))}
    assert got["few"] == got["all"] == sorted((p, i, 1) for p in ("of the", "y of the") for i in range(n))
    # a candidate asks for one word at one place, however many words may stand there
    assert written["expected"] <= 3 * n


def test_index_for_phrases_holds_their_words(spark):
    texts = spark.createDataFrame([(1, "a loft them x\nunworthless of  the"), (2, None)], "doc_id int, text string")
    got = positions.index(texts, lines=True, phrases=["of the", "worth"])
    assert sorted((r.line, r.pos, r.word) for r in got.collect()) == [(0, 2, "them"), (1, 0, "unworthless"), (1, 1, "of"), (1, 3, "the")]
    assert search.phrases(got, ["of the", "worth"]).collect() == [("worth", 1, 1)]
    assert positions.index(texts, lines=True, phrases=[]).count() == 0
    with pytest.raises(ValueError):
        positions.index(texts, lines=True, phrases=["x", ""])


def test_common_words_don_t_open_the_join(spark):
    texts = spark.createDataFrame([(i, "the " * 50 + ("seldom the end" if i == 7 else "")) for i in range(30)], "doc_id int, text string")
    index = positions.index(texts)
    parts = positions.parts_of(spark.createDataFrame([(1, "the seldom the")], "item_id int, text string"))
    assert [(r.doc, r.start) for r in positions.occurrences(index, parts).collect()] == [(7, 49)]


def test_phrases_in_no_line(spark):
    c = spark.createDataFrame([("p", "one two\nthree"), ("q", None)], "path string, content string")
    assert [r.subject for r in guards.phrases_present(c, ["one t", "two\nthree", "two three", "hree"]).orderBy("subject").collect()] == ["two\nthree", "two three"]
