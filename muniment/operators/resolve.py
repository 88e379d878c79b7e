"""Joins to the content index, to the target and to small mapping tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muniment.operators import spread


def index_by_id(index: DataFrame, key: str = "internal_id") -> DataFrame:
    """One row per id: number of files and the attributes of the first path."""
    rest = [c for c in index.columns if c != key]
    return (
        index.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_files"), F.min_by(F.struct(*rest), F.col("path")).alias("_first"))
        .select(key, "n_files", "_first.*")
    )


def resolve_content(
    versions: DataFrame, index: DataFrame, key: str = "internal_id",
) -> DataFrame:
    """Exactly one file per referenced id: ``resolved``, ``unresolved`` (none) or ``ambiguous`` (several)."""
    joined = versions.join(index_by_id(index, key), key, "left")
    n = F.coalesce(F.col("n_files"), F.lit(0))
    return joined.withColumn("n_files", n).withColumn(
        "resolution", F.when(n == 1, "resolved").when(n == 0, "unresolved").otherwise("ambiguous")
    )


def conflicts(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows whose id the target already has."""
    return df.join(target.select(key).distinct(), key, "left_semi")


def without_existing(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows whose id the target does not have yet."""
    return df.join(target.select(key).distinct(), key, "left_anti")


def rename_properties(props: DataFrame, mapping: DataFrame, name: str = "name") -> DataFrame:
    """Property names through a (source, target) mapping; unmapped names stay.

    The join strategy is left to Spark: it broadcasts the mapping only when its measured size is small,
    and splits a heavy name otherwise.
    """
    small = mapping.select(F.col("source").alias(name), F.col("target").alias("_target"))
    return (
        props.join(small, name, "left")
        .withColumn(name, F.coalesce("_target", name))
        .select(*props.columns)
    )
