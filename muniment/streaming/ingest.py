"""Incremental ingest: the stream's own checkpoint is the resume point."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muniment.functions import ids
from muniment.operators import shred, validate
from muniment.sources import records
from muniment.sources.records import VISIBLE

BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_records(spark: SparkSession, root: str, name_regex: str = VISIBLE, files_per_batch: int = 1_000_000) -> DataFrame:
    """Streaming ``raw_records`` of a directory tree: every new record file once, in batches of bounded size, read in its own encoding."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
        .where(ids.file_name(F.col("path")).rlike(name_regex))
    )
    return records.decoded(files).select("path", "xml", "length", "text_problem")


def ingest_available(
    raw: DataFrame,
    sink_dir: str,
    checkpoint: str,
    each_batch: Callable[[DataFrame, int], None] | None = None,
) -> dict[str, DataFrame]:
    """Run everything the stream ``raw`` has to offer through the per-record steps, then stop.

    The state is the table of ids that earlier batches wrote. A record whose id an earlier batch holds, or
    another record of its batch with a smaller path, is a row of ``rejects`` and goes no further. Every batch writes
    to folders of its own number, overwrites them and looks only at smaller numbers, so a batch repeated after a
    failure changes nothing. Returns the written tables.
    """
    spark = raw.sparkSession
    parsed = shred.parse_records(raw)
    empty = spark.createDataFrame([], parsed.schema)
    rejected = spark.createDataFrame([], "path STRING, pid STRING, message STRING")
    ids_of = "pid STRING, path STRING, batch BIGINT"

    def checked(rows: DataFrame) -> DataFrame:
        return validate.validate_inline(shred.shred_versions(rows, keep=["path"]))

    def repeats(stored: DataFrame, number: int) -> DataFrame:
        """Records of a batch whose id is taken. Ids and paths alone travel."""
        own = stored.where(F.col("pid").isNotNull()).select("path", "pid")
        earlier = spark.read.schema(ids_of).parquet(f"{sink_dir}/ids").where(F.col("batch") < number) if number else spark.createDataFrame([], ids_of)
        taken = earlier.select("pid", F.lit("").alias("path")).unionByName(own).groupBy("pid").agg(F.min("path").alias("_first"))
        message = F.concat(F.lit("another record has the id: "), F.col("pid"))
        return own.join(taken, "pid").where(F.col("path") > F.col("_first")).select("path", "pid", message.alias("message"))

    def write(batch: DataFrame, number: int) -> None:
        target = f"{sink_dir}/parsed/batch={number}"
        batch.write.mode("overwrite").parquet(target)
        stored = spark.read.schema(batch.schema).parquet(target)
        repeats(stored, number).write.mode("overwrite").parquet(f"{sink_dir}/rejects/batch={number}")
        stored.where(F.col("pid").isNotNull()).select("pid", "path").write.mode("overwrite").parquet(f"{sink_dir}/ids/batch={number}")
        again = spark.read.schema(rejected.schema).parquet(f"{sink_dir}/rejects/batch={number}")
        stored = stored.join(again.select("path"), "path", "left_anti").select(*stored.columns)
        checked(stored).write.mode("overwrite").parquet(f"{sink_dir}/versions/batch={number}")
        if each_batch:
            each_batch(stored, number)

    query = (
        parsed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = {n: _written(spark, f"{sink_dir}/{n}", e) for n, e in (("parsed", empty), ("versions", checked(empty)), ("rejects", rejected))}
    return found | {"parsed": found["parsed"].join(found["rejects"].select("path"), "path", "left_anti").select(*empty.columns)}


def _written(spark: SparkSession, path: str, empty: DataFrame) -> DataFrame:
    """The batches written so far; no rows when the stream has offered nothing yet."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath):
        return empty
    return spark.read.schema(empty.schema).option("recursiveFileLookup", "true").parquet(path)
