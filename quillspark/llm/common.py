"""Helpers the operators of this subpackage share: tables, lineage cuts, tokenizer files."""

from __future__ import annotations

import base64
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.session import cut as materialise  # noqa: F401
from quillspark.session import shared_dir  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables, read by Spark (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Merge ranks of a ``.tiktoken`` file: a line holds base64 bytes and the rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The tiktoken encoder of a rank file, one per Python worker."""
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


def boxed(docs: DataFrame, drop: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """(__key, __doc): each row's key, and the row as one struct without the columns of ``drop``, with the names
    kept. In a struct no column of a caller can clash with a column that an operator joins to it."""
    keep = [c for c in docs.columns if c not in drop]
    return docs.select(row_key("doc_id", "text").alias("__key"), F.struct(*(F.col(f"`{c}`") for c in keep)).alias("__doc")), keep


def unboxed(name: str):
    return F.col(f"__doc.`{name}`")


def row_key(*cols: str):
    """128 bits that identify a row's values; nulls and empty strings differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))
