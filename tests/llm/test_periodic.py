import hashlib
import random
import zlib

import numpy as np
import pytest
from edges import brief, empty, odd
from pyspark.sql import functions as F

from quillspark.llm import periodic, queries


def brute(w, least=6, exponent=4):
    """Runs by trying every period: stretches where words q apart agree, by start and period, smallest period of an interval only."""
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def kept(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def expected(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = brute(w)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(kept(w, runs)))


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_periodic(spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sorted(map(tuple, got.collect())) == sorted(expected(*r) for r in docs)


def laid(lists):
    bounds = np.cumsum([0, *map(len, lists)])
    return np.array([i for x in lists for i in x], np.int64), bounds


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    r = random.Random(seed)
    lists = []
    for _ in range(25):
        x = [r.randint(0, 2) for _ in range(r.randint(0, 12))]
        for _ in range(r.randint(0, 2)):
            unit = [r.randint(0, 1 + seed) for _ in range(r.randint(1, 30))]
            x += unit * r.randint(1, 9) + unit[: r.randint(0, len(unit))]
            x = x * r.choice((1, 1, 1, 4, 5)) + [r.randint(0, 5)] * r.randint(0, 20)
        lists.append(x)
    x, bounds = laid(lists)
    for least, exponent in ((6, 4), (4, 4), (12, 5)):
        got = [[] for _ in lists]
        for d, *run in periodic.runs(x, bounds, least, exponent):
            got[d].append(tuple(run))
        assert got == [brute(w, least, exponent) for w in lists]


def test_hard_words():
    """Words of one letter, of Fibonacci, and long blocks that all begin alike."""
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    lists = [[7] * 2000, b, ([1] * 300 + [2]) * 8, [1, 2] * 700 + [1, 2, 3] * 300, ([1, 1, 2] * 5 + [3]) * 40]
    x, bounds = laid(lists)
    got = [[] for _ in lists]
    for d, *run in periodic.runs(x, bounds):
        got[d].append(tuple(run))
    assert got == [brute(w) for w in lists]


def test_long_words_take_no_time_of_their_square():
    import time

    n = 400_000
    for x in (np.zeros(n, np.int64), np.tile(np.arange(40_000), 10), np.tile(np.r_[np.zeros(999, np.int64), 1], n // 1000)):
        began = time.time()
        assert periodic.runs(x, np.array([0, n]))
        assert time.time() - began < 60


def test_z_function():
    r = random.Random(1)
    for _ in range(200):
        x = [r.randint(0, 1) for _ in range(r.randint(0, 40))]
        assert periodic.z_function(x) == [next((k for k in range(len(x) - i) if x[k] != x[i + k]), len(x) - i) for i in range(len(x))]


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(9, np.int64), np.array([0, 9]), exponent=3)


def test_odd_rows(spark):
    d = odd(spark).withColumn("runs", F.lit("mine"))
    got = periodic.find_runs(d).collect()
    assert len(got) == d.count() and {"kept", "score", "__key", "collapsed"} <= set(got[0].asDict())
    by = {(r.doc_id, r.text): r for r in got}
    assert by[2, None].n_words == 0 and by[3, ""].collapsed == "" and by[4, " \n\t "].runs == []
    assert [r.runs for r in got if r.doc_id == 6] == [[(0, 120, 3)]] and [r.collapsed for r in got if r.doc_id == 6] == ["line of words"]
    assert [tuple(map(tuple, r.runs)) for r in got if r.doc_id == 5] == [((1, 30_000, 1),)]
    assert periodic.find_runs(empty(spark)).count() == 0 and periodic.digests(empty(spark)).count() == 0
    rows = periodic.digests(brief(spark)).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(str(expected(r.doc_id, r.text)) for r in brief(spark).collect())
