"""Where a run's tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muniment.functions import ids
from muniment.model import RunOptions


_AS_TEXT = ("ntriples", "inventories")

#: Resource versions that a bucket should hold before there are more buckets: a folder and a file cost the same whatever they hold.
BUCKET_ROWS = 500_000
_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


def target_root(opts: RunOptions) -> str:
    """Plain targets are written to the target directory itself, others below ``data/ocfl-root``."""
    base = opts.target_dir.rstrip("/")
    return base if opts.plain else f"{base}/data/ocfl-root"


def write_resources(
    df: DataFrame, path: str, opts: RunOptions, mode: str = "append", bucket_characters: int = 3
) -> None:
    """Resource versions with their version metadata, partitioned by the start of the layout's first tuple.

    Three characters give 4,096 partitions, for targets of many millions of objects; small targets take fewer.
    """
    out = df.select(
        "*",
        F.lit(opts.user).alias("version_user"),
        F.lit(opts.user_uri).alias("version_address"),
        ids.layout_path(F.col("object_id")).alias("object_dir"),
        ids.layout_bucket(F.col("object_id"), bucket_characters).alias("bucket"),
    )
    # Rows of a bucket meet before they are written; the rebalance splits large buckets and joins small ones.
    out.hint("rebalance", F.col("bucket")).write.mode(mode).partitionBy("bucket").parquet(path)


def bucket_characters(rows: int) -> int:
    """Characters of the buckets of a target of so many resource versions: 16, 256 or 4,096 folders."""
    return 1 + sum(rows > BUCKET_ROWS * 16**k for k in (1, 2))


def write_ntriples(df: DataFrame, path: str, mode: str = "append") -> None:
    """N-Triples lines of every resource version."""
    df.where(F.col("nt") != "").select(F.regexp_replace("nt", r"\n$", "").alias("value")).write.mode(mode).text(path)


def write_inventories(df: DataFrame, path: str, mode: str = "append") -> None:
    """One inventory document per line."""
    df.select(F.col("inventory").alias("value")).write.mode(mode).text(path)


def write_rejects(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(path)


def write_report(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(path)


def append_ledger(done: DataFrame, path: str) -> None:
    done.write.mode("overwrite").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def published(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table of all published runs below a target root; None if there is none. Folders of unfinished runs are not read."""
    if not _exists(spark, f"{root}/runs"):
        return None
    runs = spark.read.schema("run STRING").option("recursiveFileLookup", "true").parquet(f"{root}/runs")
    if name in _AS_TEXT:
        stored = spark.read.schema("value STRING, run STRING").text(f"{root}/{name}")
    else:
        # Names of partitions are texts: a run "007" must not be read as a number. Said beforehand, so that the folders are listed once.
        before = spark.conf.get(_INFERENCE)
        spark.conf.set(_INFERENCE, "false")
        try:
            stored = spark.read.parquet(f"{root}/{name}")
        finally:
            spark.conf.set(_INFERENCE, before)
    return stored.join(runs, "run", "left_semi")


def existing_objects(spark: SparkSession, opts: RunOptions) -> DataFrame | None:
    """Ids of the objects that the target already holds; None for a run without a target or a fresh one.

    Every object of a run has its versions, which are a few narrow rows in plain files; its resources lie in up to thousands of folders.
    """
    stored = published(spark, target_root(opts), "versions") if opts.target_dir else None
    return None if stored is None else stored.select("object_id").distinct()


def write_outputs(tables: dict[str, DataFrame], opts: RunOptions, run_id: str | None = None) -> str:
    """Store a whole run below the target and return its id.

    Every table goes to a folder of the run, which a repetition under the same id overwrites. The run counts once its row
    is in ``runs``, so one that dies half way leaves nothing that is read. The ledger comes after that: it lists finished work only.
    """
    root, run_id = target_root(opts), run_id or f"r{uuid.uuid4().hex}"
    at = lambda name: f"{root}/{name}/run={run_id}"
    write_resources(tables["resources"].drop("nt"), at("resources"), opts, "overwrite", bucket_characters(tables["resources"].count()))
    write_ntriples(tables["ntriples"], at("ntriples"), "overwrite")
    write_inventories(tables["inventory"], at("inventories"), "overwrite")
    for name in ("manifest", "version_state", "versions", "fixity"):
        tables[name].write.mode("overwrite").parquet(at(name))
    write_rejects(tables["rejects"], at("rejects"), "overwrite")
    write_report(tables["report"], at("report"), "overwrite")
    spark = tables["resources"].sparkSession
    spark.range(1).select(F.lit(run_id).alias("run")).write.mode("overwrite").parquet(f"{root}/runs/{run_id}")
    append_ledger(tables["ledger"], f"{opts.ledger_dir or f'{root}/ledger'}/run={run_id}")
    return run_id
