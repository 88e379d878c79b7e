"""Error policy: what happens to objects that cannot be migrated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT_COLUMNS = ("pid", "path", "stage", "message")


class MigrationFailure(RuntimeError):
    """Raised at the first reject of a fail-fast run."""


def as_rejects(df: DataFrame, stage: str, message: Column | None = None) -> DataFrame:
    """Rows in the shape of the reject table."""
    path = F.col("path") if "path" in df.columns else F.lit(None)
    pid = F.col("pid") if "pid" in df.columns else F.lit(None)
    return df.select(
        pid.cast("string").alias("pid"),
        path.cast("string").alias("path"),
        F.lit(stage).alias("stage"),
        (message if message is not None else F.col("message")).alias("message"),
    )


def partition_rejects(df: DataFrame, rejects: DataFrame, continue_on_error: bool, key: str = "pid") -> DataFrame:
    """``df`` without any object that has a reject; fail-fast raises on the first one instead."""
    if not continue_on_error:
        first = rejects.take(1)
        if first:
            row = first[0].asDict()
            raise MigrationFailure(f"{row.get('stage')}: pid={row.get('pid')!r}, message={row.get('message')!r}")
        return df
    bad = rejects.where(F.col(key).isNotNull()).select(key).distinct()
    return df.join(bad, key, "left_anti")
