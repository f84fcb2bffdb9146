"""Sinks: corpus files, indexes, reports."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Write (path, content) below ``root`` (a folder that all executors share), byte for byte; gives (path, bytes).

    Each file is written beside its place and renamed, so a task that runs twice leaves the same
    bytes. Paths that leave the folder are refused. For object stores keep the table as Parquet.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes = []
            for path, content in zip(b["path"], b["content"], strict=True):
                to = os.path.normpath(os.path.join(root, path))
                if not to.startswith(os.path.normpath(root) + os.sep):
                    raise ValueError(f"{path} leaves its folder")
                os.makedirs(os.path.dirname(to), exist_ok=True)
                data = content.encode()
                with open(f"{to}.{os.getpid()}", "wb") as f:
                    f.write(data)
                os.replace(f"{to}.{os.getpid()}", to)
                sizes.append(len(data))
            yield pd.DataFrame({"path": b["path"], "bytes": sizes})

    return files.select("path", "content").mapInPandas(run, "path string, bytes long")


def index_text(entries: DataFrame, title: str) -> DataFrame:
    """One row: an index of (label, state, path) in index order. An index is one file by definition; entries are short."""
    item = F.struct("label", F.coalesce("state", F.lit("")).alias("state"), "path")
    lines = F.transform(F.array_sort(F.collect_list(item)), lambda e: F.concat(F.lit("- ["), e["label"], F.when(e["state"] != "", F.concat(F.lit(" ("), F.upper(e["state"]), F.lit(")"))).otherwise(""), F.lit("]("), e["path"], F.lit(")")))
    return entries.agg(F.concat(F.lit(f"# {title}\n\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("content"))


def report(missing: DataFrame, **scalars: Column) -> DataFrame:
    """A JSON report of rows (url, referenced_by) in order, with scalar facts beside them."""
    rows = F.array_sort(F.collect_list(F.struct("url", F.array_sort("referenced_by").alias("referenced_by"))))
    return missing.agg(F.to_json(F.struct(F.count(F.lit(1)).alias("count"), rows.alias("missing"), *(v.alias(k) for k, v in scalars.items()))).alias("report"))


def run_report(*counts: tuple[str, DataFrame]) -> DataFrame:
    """(block, key, n) of several grouped counts; a block without rows shows a zero row."""
    spark = counts[0][1].sparkSession
    out = None
    for name, df in counts:
        key, n = df.columns
        rows = df.select(F.lit(name).alias("block"), F.col(key).cast("string").alias("key"), F.col(n).cast("long").alias("n"))
        zero = spark.range(1).select(F.lit(name).alias("block"), F.lit(None).cast("string").alias("key"), F.lit(0).cast("long").alias("n"))
        rows = rows.unionByName(zero.join(rows.limit(1).select("block"), "block", "left_anti"))
        out = rows if out is None else out.unionByName(rows)
    return out
