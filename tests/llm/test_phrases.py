import random
import re
from collections import Counter

import numpy as np
import pytest
from edges import brief, empty, odd
from oracle import connect, same
from pyspark.sql import functions as F

from quillspark.llm import phrases, queries


def pieces(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower)]


def brute(docs, least, top, longest=4, share=80):
    """Phrases of (group, text) rows by plain dictionaries."""
    f, total = Counter(), Counter()
    for g, t in docs:
        for w in pieces(t):
            total[g] += len(w)
            f.update((g, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    f = {p: n for p, n in f.items() if n >= least}
    out = {}
    for p, a in f.items():
        if len(p) > 2:
            g, *w = p
            score, _, l, r = min((2_000_000 * a // (f[g, *w[:k]] + f[g, *w[k:]]), k, f[g, *w[:k]], f[g, *w[k:]]) for k in range(1, len(w)))  # noqa: E741
            longer = [n for q, n in f.items() if q[0] == g and len(q) > len(p) and any(list(q[i : i + len(w)]) == w for i in range(1, len(q) - len(w) + 1))]
            if not any(100 * n >= share * a for n in longer):
                out.setdefault(g, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((g, i + 1, p.decode(), -a, l, r, total[g], -s) for g, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]))  # noqa: E741


def made(n, seed):
    r = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "état", "x-y", "a", "日本"] + [f"w{i}" for i in range(25)]
    word = lambda: vocabulary[min(int(r.expovariate(0.3)), len(vocabulary) - 1)]
    fixed = ["New York state", "in the  house of\tthe", "a a a a a", "one two. three four"]
    return [(r.choice(["en", "de", None]), "".join(r.choice([" ", " ", "  ", "\t", ", ", ".", "!\n"]) + (r.choice(fixed) if r.random() < 0.1 else word()) for _ in range(r.randint(0, 60)))) for _ in range(n)]


def test_query_equals_sql(spark, sf):
    got = queries.op11_phrases(spark, sf)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for _, t in got.dtypes} == {"string", "bigint"}
    same(got, connect(sf), phrases.oracle())


@pytest.mark.parametrize("least,top,longest", [(5, 2000, 4), (3, 12, 3), (9, 40, 5)])
def test_against_brute_force(spark, monkeypatch, least, top, longest):
    monkeypatch.setattr(phrases, "SHARD_WORDS", 400)
    docs = made(150, least)
    got = phrases.collocations(spark.createDataFrame(docs, "lang string, text string").repartition(5), least=least, top=top, longest=longest).collect()
    assert sorted(map(tuple, got)) == brute([(g or "und", t) for g, t in docs], least, top, longest)


def test_bitmaps_cross_blocks(monkeypatch):
    """Counts of one shard against plain counting, with groups of first words of any size and words at the edges of blocks."""
    r = np.random.default_rng(2)
    x = r.integers(0, 6, 1500).astype(np.int32)  # 0 is a gap, 5 not frequent
    local, gids = np.array([4, 1, 3, 2]), np.array([70, 40, 10, 90])
    name = dict(zip(local.tolist(), gids.tolist(), strict=True))
    plain = lambda k: Counter(tuple(name[i] for i in x[j : j + k].tolist()) for j in range(len(x) - k + 1) if all(i in name for i in x[j : j + k].tolist()))
    for rows in (1, 7, 1 << 18):
        monkeypatch.setattr(phrases, "ROWS_AT_ONCE", rows)
        get = lambda known: {tuple(p): n for ps, ns in phrases.counted(x, local, gids, known) for p, n in zip(ps.tolist(), ns.tolist(), strict=True)}
        assert get(None) == plain(2)
        two = [k for k, n in plain(2).items() if n >= 40]
        three = get(np.array([*two, (123, 10)]))  # the last has a word that this shard has not
        assert three == {k: n for k, n in plain(3).items() if k[:2] in two and k[1:] in two}
        some = [k for k, n in three.items() if n >= 7]
        assert get(np.array(some)) == {k: n for k, n in plain(4).items() if k[:3] in some and k[1:] in some}


def test_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    row = spark.createDataFrame([(big, big, big + 1)], "a long, l long, r long").select(F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r)")).first()
    assert row[0] == 2_000_000 * big // (2 * big + 1)


def test_odd_rows(spark):
    d = odd(spark).unionByName(odd(spark).withColumn("lang", F.lit(None).cast("string"))).withColumn("phrase", F.lit("mine")).withColumn("n", F.lit(1))
    got = phrases.collocations(d, least=2).collect()
    assert ("en", "line of words") in {(r.lang, r.phrase) for r in got} and "und" in {r.lang for r in got}
    small = brief(spark)
    assert sorted(map(tuple, phrases.collocations(small, least=2).collect())) == brute([(r.lang or "und", r.text) for r in small.collect()], 2, 2000)
    assert phrases.collocations(empty(spark)).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", "a b c"), ("en", None)], "lang string, text string")).count() == 0
