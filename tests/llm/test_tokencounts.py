import public_tokenizers as P
import pytest
import tiktoken
from edges import empty, odd

import __spark_entry__ as entry
from quillspark.llm import tokencounts
from quillspark.llm.common import ranks

PATH = P.path("byte_bpe_50k.tiktoken")
PLAIN = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})


def brute(text, sections):
    """Tokens of each section, crossing ones of each, and those outside all, byte by byte."""
    owner = [[k for k, (a, b) in enumerate(sections) if a <= i < b] for i, ch in enumerate(text) for _ in ch.encode()]
    n, crossing, outside, at = [0] * len(sections), [0] * len(sections), 0, 0
    for token in PLAIN.encode_ordinary(text):
        size = len(PLAIN.decode_single_token_bytes(token))
        held = [k[0] if k else None for k in owner[at : at + size]]
        at += size
        own = [k for k in held if k is not None]
        if not own:
            outside += 1
            continue
        best = max(dict.fromkeys(own), key=lambda k: (own.count(k), -sections[k][0]))
        n[best] += 1
        crossing[best] += set(held) != {best}
    return n, crossing, outside


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {}
    for r in entry.queries()["op2_token_counts"](spark, sf).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == set(texts)
    for doc, text in texts.items():
        rows = sorted(got[doc], key=lambda r: r["section"])
        at, sections = 0, []
        for x in text.split("\n"):
            sections.append((at, min(at + len(x) + 1, len(text))))
            at += len(x) + 1
        n, crossing, outside = brute(text, sections)
        assert [(r["start"], r["end"]) for r in rows] == sections and not outside
        assert [r["n_tokens"] for r in rows] == n and [r["n_crossing"] for r in rows] == crossing
        assert {r["doc_tokens"] for r in rows} == {sum(n)} == {len(PLAIN.encode_ordinary(text))}


def test_gaps_and_crossing_tokens(spark):
    import random

    r = random.Random(3)
    docs = []
    for i in range(200):
        text = "".join(r.choice(["hello", " world", "\n\n\n", "  ", "日本", "é", "😀", "12345", "'s", " international"]) for _ in range(r.randint(0, 12)))
        cuts = sorted(r.randint(0, len(text)) for _ in range(2 * r.randint(0, 5)))
        sections = list(zip(cuts[::2], cuts[1::2], strict=True))
        r.shuffle(sections)
        docs.append((i, text, sections))
    d = spark.createDataFrame(docs, "doc_id long, text string, parts array<struct<a:int,b:int>>")
    got = {}
    for x in tokencounts.count_tokens(d, PATH, P.PATTERN, "parts").collect():
        got.setdefault(x["doc_id"], {})[x["section"]] = (x["n_tokens"], x["n_crossing"])
    crossed = 0
    for i, text, sections in docs:
        n, crossing, outside = brute(text, sections)
        want = dict(enumerate(zip(n, crossing, strict=True))) | ({None: (outside, 0)} if outside else {})
        assert got.get(i, {}) == want
        crossed += sum(crossing)
    assert crossed > 50


def test_overlap_is_refused():
    with pytest.raises(ValueError, match="overlap"):
        tokencounts.attributed(tokencounts.np.array([1, 1, 1]), b"abc", [(0, 2), (1, 3)])


def test_odd_rows(spark):
    got = tokencounts.count_tokens(odd(spark), PATH, P.PATTERN).collect()
    assert sum(r["n_tokens"] for r in got) == sum(len(PLAIN.encode_ordinary(r["text"] or "")) for r in odd(spark).collect())
    assert [(r["start"], r["end"], r["n_tokens"]) for r in got if r["doc_id"] == 2] == [(0, 0, 0)]
    assert tokencounts.count_tokens(empty(spark), PATH, P.PATTERN).count() == 0
