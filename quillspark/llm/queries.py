"""The queries of this subpackage: opN_<name>, and the pipeline. Thin: each calls its operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokens
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import bpe, embeddings, htmltext, linededup, media, minhash, mixing, packing, periodic, phrases, pii, tokencounts, toxicity
from quillspark.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count_tokens(table(spark, sf_dir, "documents"), tokens.path("byte_bpe_50k.tiktoken"), tokens.PATTERN)


def op3_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokens.path("byte_bpe_50k.tiktoken"), tokens.PATTERN)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of the rules and those that the pattern-instance graph adds. On the driver's tables up to sf0.1 the graph adds none:
    what a rule doesn't take there stands in no context that the seeds share."""
    return pii.digests(table(spark, sf_dir, "documents"))


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokens.path("byte_bpe_50k.json"), tokens.PATTERN, added_tokens=True)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_texts(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op10_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"), F.md5("text").alias("text_md5"))
    return mixing.mix(docs, key=("doc_id", "text_md5")).select("doc_id", "size", "source_size", "target", "taken")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_token_counts, op3_linededup, op4_bpe, op5_pii, op6_vectors, op7_telephony, op8_packing, op9_minhash, op10_htmltext, op11_phrases, op12_periodic, op13_mixing, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op3_linededup": linededup.oracle(), "op6_vectors": embeddings.oracle(), "op9_minhash": minhash.oracle(), "op11_phrases": phrases.oracle(), "op13_mixing": mixing.oracle()}
