import hashlib
import random
import re

from edges import empty, odd
from pyspark.sql import functions as F

from quillspark.llm import pii, queries

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    return kind == "email" or (16 <= len(d) <= 19 and luhn(d) if kind == "card" else 8 <= len(d) <= 15)


def base(text):
    return [(k, m.start(), m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], text) if ok(k, m[0])]


def line(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_query_equals_plain_rules(spark, sf):
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op5_pii(spark, sf).collect()
    assert len(rows) == len(text)
    for r in rows:
        b = base(text[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(line(b).encode()).hexdigest()
        assert set(line(b).split(",")) - {""} <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in b) for k in pii.KINDS]


def test_rules_in_java_match_plain_ones(spark):
    r = random.Random(7)
    texts = ["".join(r.choice(a) for _ in range(r.randint(0, 60))) for a in ("ab1290@.+-_ ()%é\n", "a1@..", "12.", "1234567890 -", "+12 ().-") for _ in range(400)]
    texts += ["".join(r.choice(("4111111111111111", "5500 0000 0000 0004", "+1 (269) 555-3296", "10.0.0.255", "a@b.c", " ", "-", ".", "1")) for _ in range(r.randint(1, 6))) for _ in range(400)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "00001.2.3.0255", "4111 1111-1111 1111", "+1 (269) 555-3296 4111111111111111", "a@b", "x..@y.z.", "9" * 30 + ".1.1.1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: line([(s["kind"], s["start"], s["end"]) for s in r["__base"]]) for r in pii.find_pii(df, support=10**6).collect()}
    assert got == {i: line(base(t)) for i, t in enumerate(texts)}


def test_long_texts_do_not_blow_up(spark):
    texts = ["a" * 300_000, "a@" + "b." * 60_000, "1 " * 100_000, "+1" + "(" * 200_000, "9" * 200_000, "a@b.c " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in pii.find_pii(df).select("doc_id", F.size("__base").alias("n")).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 0, 4: 0, 5: 20_000}


def test_patterns_discover_unseen_identifiers(spark):
    docs = [(i, f"words {i} mail to user{i}@host{i}.example today and more") for i in range(40)]
    docs += [(100 + i, f"other {i} mail to user{i}(at)host{i} today and more") for i in range(2)]
    docs += [(200 + i, f"room number {i} was full") for i in range(30)]
    got = {r["doc_id"]: r["spans"] for r in pii.digests(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[100] == "email:16:30" and got[101].startswith("email:16:") and all(got[200 + i] == "" for i in range(30))


def graph(docs, rounds=3, confidence=0.9, support=5, doubt=0.1):
    """Spans that the pattern-instance graph adds, by plain dictionaries."""
    import math
    from collections import defaultdict

    def shape(v):
        v = re.sub(r"(?<![A-Za-z0-9])(?:[A-Za-z]+[0-9]|[0-9]+[A-Za-z])[A-Za-z0-9]*", "\1", v)
        return re.sub("[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", v)).replace("\1", "x")

    tokens, edges, seed, seen = [], defaultdict(set), {}, set()
    for i, text in sorted(set(docs)):
        rules = [(k, m.start(), m.end(), ok(k, m[0])) for k in PLAIN for m in re.finditer(PLAIN[k], text) if k != "card" or len(re.sub("[^0-9]", "", m[0])) >= 12]
        found = list(re.finditer(pii.TOKEN, text))
        gaps = [text[a:b] for a, b in zip([0, *(m.end() for m in found)], [*(m.start() for m in found), len(text)], strict=True)]
        for n, m in enumerate(found):
            v = m[0].rstrip(".,;:!?)\"'")
            if not v:
                continue
            left, right = (gaps[n].lower().split() or [""])[-1], (gaps[n + 1].lower().split() or [""])[0]
            touch = [(k, y) for k, a, b, y in rules if a < m.start() + len(v) and m.start() < b]
            inst = v.lower()
            if touch:
                seen.add(inst)
            for k in sorted(k for k, y in touch if y):
                seed[inst] = min(seed.get(inst, k), k)
            for p in (("L", left, shape(v)), ("R", shape(v), right), ("B", left, right)):
                edges[p].add(inst)
            tokens.append((i, m.start(), m.start() + len(v), inst, bool(touch)))
    decided = {x: (seed.get(x, "-"), float(x in seed)) for x in seen}
    scores, best = dict(decided), {}
    for _ in range(rounds):
        odds = defaultdict(float)
        for p, xs in edges.items():
            for k in pii.KINDS:
                s = [scores[x][1] for x in xs if x in scores and scores[x][0] == k]
                against = sum(x in scores and scores[x][0] != k for x in xs) + doubt * sum(x not in scores for x in xs)
                conf = sum(s) / (sum(s) + against + 0.5)
                if len(s) >= support and conf >= confidence:
                    for x in (x for x in xs - seen if len(re.sub(r"[\W_]", "", x)) >= 5):
                        odds[x, k] += math.log1p(-conf)
        best = {}
        for (x, k), o in odds.items():
            best[x] = max(best.get(x, (0.0, "")), (1 - math.exp(o), k))
        scores = decided | {x: (k, s) for x, (s, k) in best.items()}
    return {(i, best[x][1], a, b) for i, a, b, x, touched in tokens if not touched and best.get(x, (0,))[0] >= confidence}


def test_discovery_equals_plain_graph(spark):
    r = random.Random(31)
    before, after = ["mail to", "call", "from host", "room", "see\tpage", "the"], ["today", "now\nor", "and more", "or", "z" * 90]
    things = [lambda: f"u{r.randint(1, 60)}@h{r.randint(1, 3)}.example", lambda: f"u{r.randint(1, 9)}(at)h{r.randint(1, 3)}", lambda: f"+1 ({r.randint(200, 299)}) 555-{r.randint(1000, 9999)}", lambda: f"0{r.randint(150, 160)} 555 0{r.randint(100, 130)}", lambda: f"10.0.{r.randint(0, 400)}.{r.randint(0, 99)}", lambda: str(r.randint(1, 300)), lambda: f"x{r.randint(1, 30)},"]
    docs = []
    for i in range(500):
        b = r.randrange(len(before))
        parts = [f"{before[k]} {(things[k] if r.random() < 0.6 and k < len(things) else r.choice(things))()} {r.choice(after)}" for k in (b, r.randrange(len(before)))]
        docs.append((i, f"Start {i % 7} " + " x ".join(parts)))
    docs += docs[:30]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for params in ({}, {"support": 3, "confidence": 0.6}, {"rounds": 1, "confidence": 0.5, "doubt": 0.0}, {"rounds": 0}):
        want = graph(docs, **params)
        got = {(r["doc_id"], s["kind"], s["start"], s["end"]) for r in pii.find_pii(df, **params).collect() for s in r["__spans"] if s not in r["__base"]}
        assert got == want, params
        assert (len(want) > 5) == (params.get("rounds", 1) > 0), (params, len(want))


def test_mixed_contexts_and_digit_groups(spark):
    docs = [(i, f"letter {i} call +49 171 555{i:04d} today") for i in range(60)] + [(100 + i, f"other call 0171 555 0{i:03d} today {'w' * 50}{i}") for i in range(20)]
    docs += [(200 + i, f"chapter {i} of the book") for i in range(20)]
    got = {r["doc_id"]: r["spans"] for r in pii.digests(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[100 + i] == "phone:11:24" for i in range(20)) and not any(got[200 + i] for i in range(20))


def test_mask(spark):
    df = spark.createDataFrame([(1, "a x@y.zz b +1 (269) 555-3296."), (2, None), (3, ""), (4, "é x@y.zz")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in pii.mask(df).collect()} == {1: "a <EMAIL> b <PHONE>.", 2: None, 3: "", 4: "é <EMAIL>"}


def test_odd_rows(spark):
    assert pii.digests(odd(spark)).count() == odd(spark).count()
    m = pii.mask(odd(spark))
    assert m.columns == odd(spark).columns and m.count() == odd(spark).count() and pii.mask(empty(spark)).count() == 0 and pii.digests(empty(spark)).count() == 0
