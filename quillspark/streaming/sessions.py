"""Streaming forms: sessions polled until they end, slices that reconcile, and event-time extensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_events(events: DataFrame, delay: str = "15 minutes") -> DataFrame:
    """Each event once, however often polling returns it; state is dropped behind the watermark."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["id"])


def session_windows(events: DataFrame, gap: str = "10 minutes", delay: str = "15 minutes") -> DataFrame:
    """Sessions that end when nothing came for a while: the end gate of a polled list."""
    return events.withWatermark("ts", delay).groupBy("session", F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("events"), F.max_by("type", "ts").alias("last"))


def tumbling(events: DataFrame, width: str, delay: str, *keys: str) -> DataFrame:
    """Extension: counts and sums in event-time windows, late rows dropped behind the watermark."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def reconciling_sink(path: str, key: str, slice_: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: a batch replaces the slices it holds and leaves the others.

    Slices are partitions of a Parquet table, overwritten dynamically, so a batch that runs twice
    leaves the same files.
    """

    def write(batch: DataFrame, _: int) -> None:
        batch.dropDuplicates([key]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(slice_).parquet(path)

    return write
