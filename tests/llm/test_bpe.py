import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from edges import empty, odd
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import bpe, queries
from quillspark.llm.common import ranks

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab's'tré 1٣２ \n\t !?.日本ﬁ😀")), max_size=120), st.integers(1, 9), st.integers(2, 40))
def test_any_tree_gives_the_same_ids(text, chars, piece):
    core = tiktoken.Encoding("p", pat_str=P.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})
    c = bpe.TreeCodec(PATH, P.PATTERN, leaf_chars=chars, leaf_bytes=piece)
    ids = c.encode(text)
    assert ids == core.encode_ordinary(text)
    assert c.decode(ids, leaf=3) == text.encode()


def test_long_runs(plain):
    r = random.Random(3)
    c = bpe.TreeCodec(PATH, P.PATTERN, leaf_chars=64, leaf_bytes=64)
    for alphabet in ("a", "ab", "thein", "日本語漢字", " ", "!", "0123456789", "a b", "é"):
        text = "".join(r.choice(alphabet) for _ in range(3000))
        assert c.encode(text) == plain.encode_ordinary(text)


def test_query_on_documents(spark, sf, plain):
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op4_bpe(spark, sf).collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = plain.encode_ordinary(text[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_odd_rows(spark):
    df = bpe.decode_ids(bpe.encode_texts(odd(spark), PATH, P.PATTERN), PATH, P.PATTERN)
    got = df.collect()
    assert len(got) == odd(spark).count() and all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in got) and got[0]["kept"] == "k"
    assert bpe.encode_texts(empty(spark), PATH, P.PATTERN).count() == 0 and bpe.digests(empty(spark), PATH, P.PATTERN).count() == 0
