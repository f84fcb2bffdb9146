"""Sessions, and code for the Python workers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def session(master: str = "local[8]", **conf: str) -> SparkSession:
    """A local session as the tests and the benchmark use it."""
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.enabled": "true", "spark.driver.memory": "8g"}
    b = SparkSession.builder.master(master).appName("quillspark")
    for k, v in (base | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers that share this machine's files import the package, wherever the driver was started.
    Other machines need it installed or sent with --py-files."""
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, path)))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master (tests on one machine) may name none: a temporary folder is made then and
    recorded as the context's checkpoint directory, so that later calls reuse it. On a cluster its
    executors would not see such a folder, so a session without the setting is refused.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quillspark-"))
        named = sc.getCheckpointDir()
    return named


def cut(df: DataFrame, name: str = "cut", by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` computed now and cut off from its plan: a Parquet table in the shared folder, read back.

    For operators that use an intermediate table so often that its plan would multiply. Unlike a
    cache the files outlive executors, and unlike an RDD checkpoint they are columnar, so later
    steps read only the columns they name. ``by``: columns whose values become folders, so that
    later steps read only the values they ask for. The driver's JVM deletes the table when it ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that ``cut`` has written and that nothing reads any more, before the driver ends."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        at = path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
