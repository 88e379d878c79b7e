"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins with heavy keys are split by measured partition size, also where that costs a later shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Documents can be long: few rows per batch keep a Python task's memory small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(app: str = "muniment", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; everything else stays the cluster's."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local") and "spark.sql.shuffle.partitions" not in conf:
        # Start wide and let the runtime join small partitions: it cannot split a shuffle made too narrow.
        cores = spark.sparkContext.defaultParallelism
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", str(max(current, 3 * cores)))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made up only for a local session (tests); on a cluster an unset
    folder is an error, because written stages must outlive a lost executor.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="muniment-")
    spark.sparkContext.setCheckpointDir(base)
    return base


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The readers of the result start from files, so several consumers do not repeat the work
    above it and a lost executor never forces a recomputation of it.
    """
    spark = df.sparkSession
    path = path or fresh_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch: texts are long, and a batch is held by the JVM and by Python at once.
BATCH_ROWS = "1000"


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows; the session hands Python few of them at a time from now on, if it gave more."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= int(BATCH_ROWS):
        conf.set(key, BATCH_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df


def spread_rows(df: DataFrame, at_once: int | None = None) -> DataFrame:
    """Give CPU-heavy work on compact rows at least one task per core, and one for every ``at_once`` rows.

    A small columnar file is one input split however long its rows take to parse, so tasks by bytes alone grow longer with
    the table. Inputs that already have enough splits are left alone, so nothing is moved that need not be.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if at_once:
        wanted = max(wanted, -(-df.count() // at_once))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
