"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

toxicity    drops documents that the class-conditional models predict to be toxic
line dedup  deletes later repeated runs of lines; a document with no words left goes
MinHash     keeps the least doc_id of each component of near-duplicates (5-word shingles, 0.8)
PII         replaces personal data by marks
packing     packs the tokens into sequences of 2048

Every stage bears nulls in any column, empty and very long texts, repeated rows and an empty table,
and passes columns of any name on. Ties are decided by doc_id, then by a digest of the text. A row
that repeats another wholly meets the same fate, but for the last stage, where each is packed.
"""

from __future__ import annotations

import public_tokenizers as tokens
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import linededup, minhash, packing, pii, toxicity
from quillspark.llm.common import materialise, table


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars (where there is one) brought up to date."""
    out = df.select(*(F.col(f"`{c}`") for c in docs.columns))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go. Null and empty texts stay, unless the share of toxic rows alone reaches the
    threshold. Without toxic or without ordinary labels outside the held-out fold all rows have that share as score."""
    return _columns(toxicity.score(docs, table(spark, sf_dir, "labels")).where("predicted = 0"), docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of 50 words or more go, up to the last line that agrees; so do documents of which the deletion
    leaves no word. Others without words stay. A null doc_id comes before all others, equal ids in the order of their texts' digests."""
    found = linededup.dedup_lines(docs)
    left = F.regexp_replace("text", "\\s+", "") != ""
    return _columns(found.where((F.col("n_removed") == 0) | left), docs)


def dedup_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of least doc_id (all its rows, if it is repeated);
    documents without words or without an id stay."""
    found = minhash.near_texts(docs, shingle=5)
    return _columns(found.where("kept or doc_id is null or n_shingles = 0"), docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes marks; all documents stay. Spans that overlap become one mark, of the first."""
    return _columns(pii.mask(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens; every document lies in them wholly, an empty one as its end token. doc_id is a long here."""
    return packing.pack(docs, tokens.path("byte_bpe_50k.json"), tokens.PATTERN, added_tokens=True)


STAGES = [("toxicity", drop_toxic), ("line dedup", dedup_lines), ("MinHash near-dedup", dedup_texts), ("PII", mask_pii), ("packing", pack)]

#: Learnt models, MinHash and token ids have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
