import zlib

import numpy as np
import public_tokenizers as P
from edges import empty, odd
from tokenizers import Tokenizer

from quillspark.llm import packing, queries

PATH = P.path("byte_bpe_50k.json")


def check(rows, texts, size=2048):
    """Each document's ids lie in its pieces exactly once; sequences are gapless and full but for one."""
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = np.array([*t.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    fills = []
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        fills.append(at)
    assert max(fills, default=0) <= size and sum(f < size for f in fills) <= 1


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(queries.op8_packing(spark, sf).collect(), texts)


def test_many_partitions_and_levels(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").repartition(20)
    rows = packing.pack(d, PATH, P.PATTERN, size=512, open_windows=4, fan_in=3).collect()
    check(rows, {r["doc_id"]: r["text"] for r in d.collect()}, 512)
    assert len({r["sequence_id"] for r in rows}) <= -(-sum(r["length"] for r in rows) // 512)


def test_special_strings_are_text(spark):
    d = spark.createDataFrame([(1, "a<|endoftext|>b"), (2, None), (3, "")], "doc_id long, text string")
    rows = packing.pack(d, PATH, P.PATTERN).collect()
    check(rows, {1: "a<|endoftext|>b", 2: None, 3: ""})
    assert {r["doc_id"]: r["length"] for r in rows}[2] == 1


def test_odd_rows(spark):
    rows = packing.pack(odd(spark), PATH, P.PATTERN).collect()
    t = Tokenizer.from_file(PATH)
    want = sum(len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in odd(spark).collect())
    assert sum(r["length"] for r in rows) == want and any(r["doc_id"] is None for r in rows)
    assert packing.pack(empty(spark), PATH, P.PATTERN).count() == 0


def test_added_tokens_in_query_and_pipeline(spark, tmp_path):
    import corpus_pipeline

    end = "<|endoftext|>"
    texts = dict(enumerate([f"a{end}b", end, f"{end}{end} x  {end}\n\n y", f"<|endoftext {end[:-1]}", None, "plain"]))
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    t = Tokenizer.from_file(PATH)
    for rows in (queries.op8_packing(spark, str(tmp_path)).collect(), corpus_pipeline.pack(spark, d, "").collect()):
        assert {r["doc_id"] for r in rows} == set(texts)
        for r in rows:
            ids = np.array([*t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 1], "<u4")
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
