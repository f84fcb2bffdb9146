import random
import zlib

from edges import empty, odd
from pyspark.sql import functions as F

from quillspark.llm import queries, toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(r, n=400):
    bad = ("vile", "rotten", "filthy")
    docs, labels = [], []
    for i in range(n):
        w = [f"w{int(r.paretovariate(1.1))}" for _ in range(r.randint(5, 120))]
        toxic = r.random() < 0.2
        if toxic:
            for _ in range(1 + len(w) // 30):
                w[r.randrange(len(w))] = r.choice(bad)
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_rows(spark, sf):
    rows = queries.op1_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_learns_and_never_sees_held_out_labels(spark):
    docs, labels = corpus(random.Random(4))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["score"], r["predicted"], r["held_out"]) for r in toxicity.score(d, spark.createDataFrame(labels, LABELS)).collect()}
    out = [(got[i][1], t) for i, _, t in labels if got[i][2]]
    assert sum(p == t for p, t in out) / len(out) > 0.97
    flipped = [(i, q, 1 - t if got[i][2] else t) for i, q, t in labels]
    again = {r["doc_id"]: r["score"] for r in toxicity.score(d, spark.createDataFrame(flipped, LABELS)).collect()}
    assert again == {i: s for i, (s, _, _) in got.items()}


def test_counts_equal_plain_ones(spark):
    docs, labels = corpus(random.Random(9), 60)
    d, l = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(labels, LABELS)  # noqa: E741
    m = toxicity.fit(d, l, evidence=-1.0, strength=0.0)
    train = [(t, y) for (i, t), (_, _, y) in zip(docs, labels, strict=True) if zlib.crc32(str(i).encode()) % 4 != 2]
    n, t, df, k = [0, 0], [set(), set()], {}, {}
    for text, y in train:
        w = text.split()
        n[y] += len(w)
        t[y] |= set(w)
        for x in w:
            k.setdefault(x, [0, 0])[y] += 1
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    import math

    def p(x, y):
        return (max(k[x][y] - 0.75, 0) + 0.75 * len(t[y]) * df[x] / sum(df.values())) / n[y]

    assert m.ratios.keys() == k.keys() and all(abs(m.ratios[x] - math.log(p(x, 1) / p(x, 0))) < 1e-9 for x in k)


def plain_scores(docs, labels, evidence, strength):
    """All of ``score`` by plain dictionaries: models of all training rows and of either fold, crossed values, scores."""
    import math

    import numpy as np

    toxic = {}
    for i, _, t in labels:
        toxic[i] = max(toxic.get(i, 0), t)
    rows = [(t.split(), zlib.crc32(f"{i}/fold".encode()) % 2, toxic[i]) for i, t in docs if i in toxic and zlib.crc32(str(i).encode()) % 4 != 2]

    def model(folds):
        n, df = [{}, {}], [{}, {}]
        docs_of = [sum(f in folds and y == c for _, f, y in rows) for c in (0, 1)]
        for w, f, y in rows:
            if f in folds:
                for x in w:
                    n[y][x] = n[y].get(x, 0) + 1
                for x in set(w):
                    df[y][x] = df[y].get(x, 0) + 1
        total, every, out = [sum(c.values()) for c in n], sum(sum(c.values()) for c in df), {}
        for x in df[0].keys() | df[1].keys():
            seen = [df[c].get(x, 0) for c in (0, 1)]
            p = [(max(n[c].get(x, 0) - 0.75, 0) + 0.75 * len(n[c]) * sum(seen) / every) / total[c] for c in (0, 1)]
            g = 0.0
            for c in (0, 1):
                for o, e in ((seen[c], sum(seen) * docs_of[c] / sum(docs_of)), (docs_of[c] - seen[c], docs_of[c] - sum(seen) * docs_of[c] / sum(docs_of))):
                    g += 2 * o * math.log(o / e) if o else 0.0
            if g >= evidence and abs(math.log(p[1] / p[0])) >= strength:
                out[x] = math.log(p[1] / p[0])
        return out

    value = lambda m, w: sum(m.get(x, 0.0) for x in w) / (len(w) + 50)
    every, other = model((0, 1)), {0: model((1,)), 1: model((0,))}
    bins = {}
    for w, f, y in rows:
        bins.setdefault(round(value(other[f], w) / 0.002), [0, 0])[y] += 1
    xs, ps = toxicity.calibration([(b * 0.002, *n) for b, n in sorted(bins.items())])
    v = np.array([value(every, t.split()) for _, t in docs])
    return dict(zip((i for i, _ in docs), 0.99 * np.interp(v, xs, ps) + 0.01 / (1 + np.exp(-4 * v)), strict=True))


def test_scores_equal_plain_ones(spark):
    docs, labels = corpus(random.Random(15), 300)
    d, l = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(labels, LABELS)  # noqa: E741
    for evidence, strength in ((15.0, 1.0), (1.0, 0.2)):
        want = plain_scores(docs, labels, evidence, strength)
        assert len(set(want.values())) > 20
        for most in (200_000, 5):
            for max_known in (2_000_000, 0):
                got = {r["doc_id"]: r["score"] for r in toxicity.score(d, l, evidence=evidence, strength=strength, max_shipped=most, max_known=max_known).collect()}
                assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want), (evidence, most, max_known)


def test_parameters_are_chosen_without_held_out_rows(spark):
    docs, labels = corpus(random.Random(4))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    settings = [{"evidence": 15.0, "strength": 2.0}, {"evidence": -1.0, "strength": 0.0}]
    figures = toxicity.crossed(d, spark.createDataFrame(labels, LABELS), settings)
    assert [f["evidence"] for f in figures] == [15.0, -1.0] and figures[0]["loss"] < figures[1]["loss"] and figures[0]["auc"] > 0.95
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    flipped = [(i, q, 1 - t if out(i) else t) for i, q, t in labels]
    blank = spark.createDataFrame([(i, "vile" if out(i) else t) for i, t in docs], "doc_id long, text string")
    assert toxicity.crossed(blank, spark.createDataFrame(flipped, LABELS), settings) == figures


def test_labels_by_ids_that_are_text(spark):
    docs, labels = corpus(random.Random(4))
    d = spark.createDataFrame([(f"id-{i}", t) for i, t in docs], "doc_id string, text string")
    rows = toxicity.score(d, spark.createDataFrame([(f"id-{i}", q, t) for i, q, t in labels], LABELS.replace("long", "string"))).collect()
    want = {f"id-{i}": t for i, _, t in labels}
    out = [(r["predicted"], want[r["doc_id"]]) for r in rows if r["held_out"]]
    assert len(out) > 50 and sum(p == t for p, t in out) / len(out) > 0.95


def test_calibration_is_monotone():
    xs, ps = toxicity.calibration([(-1.0, 50, 1), (0.0, 20, 4), (0.1, 30, 2), (0.5, 1, 9), (0.7, 0, 20)])
    assert xs == sorted(xs) and ps == sorted(ps) and ps[0] < 0.1 and ps[-1] > 0.9
    assert toxicity.calibration([]) == ([0.0], [0.5])


def test_odd_rows(spark):
    none = spark.createDataFrame([], LABELS)
    got = toxicity.score(odd(spark), none).collect()
    assert len(got) == odd(spark).count() and {r["score"] for r in got if not (r["text"] or "").strip()} == {0.99 * 0.5 + 0.01 * 0.5}
    assert got[0]["word"] == "w" and isinstance(got[0]["score"], float)
    some = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (None, 1, 1), (3, None, 0), (5, 0, None)], LABELS)
    assert toxicity.score(odd(spark), some).count() == odd(spark).count() and toxicity.score(empty(spark), some).count() == 0
    assert toxicity.score(odd(spark).withColumn("text", F.lit(None).cast("string")), some).count() == odd(spark).count()


def test_a_model_that_is_not_shipped_whole_counts_wholly(spark):
    docs, labels = corpus(random.Random(6), 300)
    docs += docs[:20]
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)  # noqa: E741
    params = {"evidence": 0.5, "strength": 0.5}
    whole = [(r["doc_id"], r["score"]) for r in toxicity.score(d, l, **params).collect()]
    assert len(toxicity.fit(d, l, **params).ratios) > 40 and len({s for _, s in whole}) > 40
    for most in (0, 5, 40):
        ratios, others = toxicity._shipped(toxicity.rated(d, l, **params), most)
        assert len(ratios) <= most and others is not None
        got = [(r["doc_id"], r["score"]) for r in toxicity.score(d, l, max_shipped=most, **params).collect()]
        assert len(got) == len(whole) and all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-9 for a, b in zip(sorted(got), sorted(whole), strict=True))
