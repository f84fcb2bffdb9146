"""Sessions that end: state and timers over a growing event list.

A session of a key begins with its first event. It ends with a status that says so (done, failed), is
blocked when a status asks for an action, or expires when the cap has passed since its first event.
The next event begins a new one. What an event time says decides, not when rows arrive: an event
at or after the cap closes the session as expired before it is taken, and a timer closes it when the
watermark passes the cap and no such event has come. So the same events give the same sessions in one batch or in many.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from quillspark.session import shared_dir

SESSIONS = "session string, number long, started long, ended long, events long, state string"
OPEN = StructType([StructField(n, LongType()) for n in ("number", "started", "events")])


class Lifecycle(StatefulProcessor):
    """State of a key: how many sessions it had, and of the open one when it started and how many events it has (0: none is open)."""

    def __init__(self, cap: int):
        self.cap = cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def _row(self, key, number: int, started: int, ended: int, events: int, state: str) -> tuple:
        return (key[0], number, started, ended, events, state)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        number, started, events = self.open.get() if self.open.exists() else (0, 0, 0)
        timer = self._timer(started) if events else None
        out = []
        batch = pd.concat(list(rows)).sort_values(["us", "id"])
        for us, ends in zip(batch["us"].tolist(), batch["ends"].tolist(), strict=True):
            if events and us >= started + self.cap:
                out.append(self._row(key, number, started, started + self.cap, events, "expired"))
                events = 0
            if not events:
                number, started = number + 1, us
            events += 1
            if isinstance(ends, str) and ends:
                out.append(self._row(key, number, started, us, events, ends))
                events = 0
        self.open.update((number, started, events))
        now = self._timer(started) if events else None
        if timer != now:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if now is not None:
                self.handle.registerTimer(now)
        yield pd.DataFrame(out, columns=["session", "number", "started", "ended", "events", "state"])

    def _timer(self, started: int) -> int:
        """Milliseconds, rounded up: a timer fires when the watermark has passed it."""
        return -(-(started + self.cap) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, started, events = self.open.get()
        out = []
        if events:
            out.append(self._row(key, number, started, started + self.cap, events, "expired"))
            self.open.update((number, started, 0))
        yield pd.DataFrame(out, columns=["session", "number", "started", "ended", "events", "state"])

    def close(self) -> None:
        pass


def lifecycles(events: DataFrame, cap_seconds: int, delay: str = "0 seconds") -> DataFrame:
    """(session, number, started, ended, events, state) of sessions that have ended, times in microseconds.

    events: a stream of session, ts, id (orders events of one time) and ends: what an event ends its
    session as (done, failed, blocked), null or empty for others. Events without session or time are
    left out, and those later than the watermark (``delay``) are dropped. A key's events of one batch are held at
    once: bound batches by what the source takes in a trigger. Needs the RocksDB state store.
    """
    e = events.where("session is not null and ts is not null").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    e = e.select(F.col("session").cast("string").alias("session"), "ts", F.unix_micros("ts").alias("us"), F.col("id").cast("long").alias("id"), F.coalesce("ends", F.lit("")).alias("ends"))
    return e.groupBy("session").transformWithStateInPandas(statefulProcessor=Lifecycle(cap_seconds * 1_000_000), outputStructType=SESSIONS, outputMode="Append", timeMode="EventTime")


def replay(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """All that a stream gives for what its source holds now, as a table in the shared folder; where a run of this name has stopped, another goes on."""
    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf)
    home = f"{shared_dir(spark)}/{name}"
    spark.conf.set(conf, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = stream.writeStream.format("parquet").option("path", f"{home}/rows").option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set(conf, before)
    return spark.read.schema(stream.schema).parquet(f"{home}/rows")
