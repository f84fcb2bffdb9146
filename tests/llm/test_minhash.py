import random
import re

import numpy as np
import pyarrow as pa
from edges import brief, empty, odd
from oracle import connect, same

from quillspark.llm import minhash, queries


def shingles(text, k):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in re.split("[\x20\x09-\x0d]+", lower) if x]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, k=4, percent=80):
    s = [shingles(t, k) for _, t in docs]
    n = len(docs)
    adj = [[j for j in range(n) if j != i and s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j])] for i in range(n)]
    out = {}
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in adj[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[docs[i][0]] = (len(s[i]), min(docs[j][0] for j in seen))
    return out


def test_query_equals_sql(spark, sf):
    same(queries.op9_minhash(spark, sf), connect(sf), minhash.oracle())


def test_sets_are_those_of_plain_python():
    texts = ["A b\tC  d e", "", None, "one two", "É É É É É É", " x\x0b\x0cy z w v ", "a " * 50]
    for k in (2, 4, 5):
        got = minhash.shingle_sets(pa.array(texts, pa.string()), k)
        assert [len(g) for g in got] == [len(shingles(t, k)) for t in texts]
    a, b = minhash.shingle_sets(pa.array(["p q r s t u", "p q r s t v"]), 4)
    assert len(np.intersect1d(a, b)) == 2


def test_estimate_is_unbiased():
    r = np.random.default_rng(0)
    for j in (0.5, 0.8, 0.95):
        x = np.unique(r.integers(0, 2**63, 3000, dtype=np.int64).astype(np.uint64))
        cut = int(len(x) * (1 - j) / (1 + j))
        a, b = x[: len(x) - cut], x[cut:]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((minhash.signature(a, 960) == minhash.signature(b, 960)).mean() - true) < 0.06


def near_copies(r, n, lines=40):
    out, base = [], None
    for i in range(n):
        if i % 15 == 0:
            base = [f"w{r.randrange(5000)}" for _ in range(lines * 3)]
        t = list(base)
        for _ in range(r.choice((0, 1, 2, 4, 6, 9, 14, 30))):
            t[r.randrange(len(t))] = f"e{r.randrange(10**6)}"
        out.append((i, " ".join(t)))
    return out


def test_against_brute_force_with_chains_and_small_blocks(spark):
    docs = near_copies(random.Random(8), 150)
    for block in (4, 512):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_texts(spark.createDataFrame(docs, "doc_id long, text string"), block=block).collect()}
        assert got == brute(docs)


def test_odd_rows(spark):
    got = minhash.near_texts(brief(spark))
    rows = got.collect()
    assert len(rows) == brief(spark).count() and "__key" in got.columns and got.columns.count("kept") == 1
    by = {(r["doc_id"], r["text"]): (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert by[(2, None)] == (0, 2, True) and by[(3, "")] == (0, 3, True) and by[(None, None)] == (0, None, False) and by[(None, "null id")] == (1, None, False)
    assert by[(1, "a b c d e f")] == (3, 1, True)
    assert minhash.near_texts(empty(spark)).count() == 0 and minhash.near_texts(odd(spark)).count() == odd(spark).count()
