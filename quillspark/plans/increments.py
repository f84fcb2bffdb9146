"""The fold of a corpus kept up to date: only the paths that a delta touches are folded again.

The state is a table of records as digests (path, kind, document, ordinal) and one of outcomes, both
dealt out to buckets by a hash of the path, each bucket a folder of its own. A delta reads and writes the
buckets its paths fall into; the others stay where they are, and the state names where each bucket is.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.fold import digests, resolve_digests
from quillspark.session import cut, shared_dir

RECORDS = "path string, kind string, doc string, ord bigint, __d binary, __nd binary"
OUTCOMES = "path string, outcome string, canonical bigint, records bigint, contents bigint, classes bigint, documents array<string>"


@dataclass(frozen=True)
class Folded:
    """Where the buckets of a fold's records and outcomes are. A state is never changed: a delta gives another."""

    buckets: int = 256
    records: dict[int, str] = field(default_factory=dict)
    outcomes: dict[int, str] = field(default_factory=dict)


def _read(spark: SparkSession, at: dict[int, str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*at.values()) if at else spark.createDataFrame([], schema)


def outcomes(spark: SparkSession, state: Folded) -> DataFrame:
    """The whole fold, as ``fold.resolve_unique`` gives it."""
    return _read(spark, state.outcomes, OUTCOMES)


def _write(df: DataFrame, buckets: int, name: str, old: dict[int, str], hit: set[int]) -> dict[int, str]:
    """The buckets' places after those of ``hit`` are replaced by what ``df`` has for them."""
    spark = df.sparkSession
    home = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.withColumn("bucket", _bucket(buckets)).write.partitionBy("bucket").parquet(home)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(home).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = {b: f"{home}/bucket={b}" for b in hit if files.exists(path(f"{home}/bucket={b}"))}
    return {b: p for b, p in old.items() if b not in hit} | there


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("int")


def advance(spark: SparkSession, state: Folded, added: DataFrame | None = None, withdrawn: DataFrame | None = None) -> Folded:
    """The state after records are ``added`` (path, kind, doc, ord, content, prefix; ord tells records of a path
    apart) and others ``withdrawn`` (path, ord). A record that is withdrawn and added in one delta is replaced.

    Read: the buckets that the delta's paths fall into. Folded again: its paths. A path whose last record is withdrawn
    has no outcome any more; withdrawing what isn't there changes nothing. The driver sees numbers of buckets.
    """
    new = cut(digests(added), "delta") if added is not None else spark.createDataFrame([], RECORDS)
    gone = withdrawn.select("path", F.col("ord").cast("long").alias("ord")).distinct() if withdrawn is not None else spark.createDataFrame([], "path string, ord bigint")
    touched = cut(new.select("path").unionByName(gone.select("path")).distinct().withColumn("bucket", _bucket(state.buckets)), "touched")
    hit = {r["bucket"] for r in touched.select("bucket").distinct().collect()}
    if not hit:
        return state
    at = lambda d: {b: p for b, p in d.items() if b in hit}
    kept = _read(spark, at(state.records), RECORDS).join(gone, ["path", "ord"], "left_anti").unionByName(new.selectExpr(*(f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in spark.createDataFrame([], RECORDS).schema)))
    records = _write(kept, state.buckets, "fold-records", state.records, hit)
    paths = touched.select("path")
    again = resolve_digests(_read(spark, {b: records[b] for b in hit if b in records}, RECORDS).join(paths, "path", "left_semi"))
    still = _read(spark, at(state.outcomes), OUTCOMES).join(paths, "path", "left_anti")
    columns = [f.name for f in still.schema]
    done = _write(still.unionByName(again.select(*columns)), state.buckets, "fold-outcomes", state.outcomes, hit)
    return Folded(state.buckets, records, done)


def whole(spark: SparkSession, deltas: list[tuple[DataFrame | None, DataFrame | None]], buckets: int = 256) -> DataFrame:
    """Outcomes after several deltas (added, withdrawn) in turn."""
    return outcomes(spark, reduce(lambda s, d: advance(spark, s, *d), deltas, Folded(buckets)))
