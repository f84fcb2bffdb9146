from edges import empty, odd
from test_linededup import brute as brute_lines
from test_minhash import brute as brute_near
from test_packing import check
from test_pii import base

import corpus_pipeline as p
from quillspark.llm import toxicity


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    a = p.materialise(p.drop_toxic(spark, docs, sf), "t1")
    predicted = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert texts(a) == {i: t for i, t in texts(docs).items() if predicted[i] == 0}
    b = p.materialise(p.dedup_lines(spark, a, sf), "t2")
    want = brute_lines(list(texts(a).items()), 50)
    assert texts(b) == {i: t for i, t in want.items() if t == texts(a)[i] or t.split()}
    c = p.materialise(p.dedup_texts(spark, b, sf), "t3")
    near = brute_near(list(texts(b).items()), k=5)
    assert texts(c) == {i: t for i, t in texts(b).items() if near[i][1] == i}
    d = p.materialise(p.mask_pii(spark, c, sf), "t4")
    assert texts(d).keys() == texts(c).keys()
    for i, t in texts(c).items():
        if not base(t or ""):
            assert texts(d)[i] == t
        else:
            assert all(t[x:y] not in texts(d)[i] for k, x, y in base(t) if k == "email")
    for df in (a, b, c, d):
        assert df.columns == columns and df.where("n_chars <> length(text)").count() == 0
    check(p.pack(spark, d, sf).collect(), texts(d))


def test_run_packs_what_the_stages_keep(spark, sf):
    rows = p.run(spark, sf)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and rows.count() > 0
    assert len(p.STAGES) == 5 and p.ORACLE_SQL is None


def test_odd_rows(spark, sf):
    for docs in (odd(spark), empty(spark)):
        for name, stage in p.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns, name
            out.count()
        assert (p.STAGES[-1][1](spark, docs, sf).count() > 0) == (docs.count() > 0)
    left = {(r["doc_id"], r["text"]) for r in p.dedup_lines(spark, odd(spark), sf).collect()}
    assert {(2, None), (3, ""), (None, None)} <= left
