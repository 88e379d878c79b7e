"""Group-wise work that stays even when one group holds a large part of all rows.

A plain window or a collected list puts a whole group into one task. The functions here cut every
group into *slices* (a monotone function of the order column, such as the day of a timestamp),
do the row-level work per (group, slice), and carry what crosses a slice border through a summary
with one row per (group, slice). The only window that spans a whole group runs over that summary.

``slice_by=MEASURED`` needs no knowledge of the order column: rows are range-partitioned by group and order, with
borders that Spark takes from a sample of the rows, and a partition is a slice. A group of any size and any
crowding (all its rows in one day, say) is cut into slices of about equal size. The cut rows are written once, as
the summary and the rows must see the same borders, also when a task is repeated.

``slice_by=None`` means the caller knows the group is bounded (one source record): a plain window.
Group keys must not be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muniment.session import stage

SLICE = "_slice"
#: Slices of about equal row counts, whatever the values of the order columns.
MEASURED = "measured"


def by_prefix(col: str, length: int = 10) -> Column:
    """Slice of an ISO date string: string prefixes are monotone in string order."""
    return F.substring(F.col(col), 1, length)


def by_day(col: str) -> Column:
    return F.to_date(F.col(col))


def by_range(col: str, width: int) -> Column:
    return F.floor(F.col(col) / F.lit(width))


def _before(keys):
    return Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def _sliced(df: DataFrame, keys: list[str], order: list[str], slice_by: Column | str) -> DataFrame:
    if not isinstance(slice_by, str):
        return df.withColumn(SLICE, slice_by)
    if slice_by != MEASURED:
        raise ValueError(f"unknown slices: {slice_by}")
    # An explicit number keeps the runtime from joining or splitting partitions; rows equal in keys and order stay together.
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.repartitionByRange(slices, *keys, *order).withColumn(SLICE, F.spark_partition_id()), "slices")


def number_rows(
    df: DataFrame, keys: list[str], order: list[str], slice_by: Column | str | None, out: str, total: str
) -> DataFrame:
    """0-based position of each row in its group and the group's row count; ``order`` must be unique."""
    if slice_by is None:
        w = Window.partitionBy(*keys)
        return df.withColumn(out, F.row_number().over(w.orderBy(*order)) - 1).withColumn(
            total, F.count(F.lit(1)).over(w)
        )
    df = _sliced(df, keys, order, slice_by)
    summary = (
        df.groupBy(*keys, SLICE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(_before(keys)), F.lit(0)))
        .withColumn(total, F.sum("_n").over(Window.partitionBy(*keys)))
        .drop("_n")
    )
    local = df.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*order)) - 1)
    return (
        local.join(summary, [*keys, SLICE], "left")
        .withColumn(out, F.col("_offset") + F.col("_local"))
        .drop(SLICE, "_local", "_offset")
    )


def carry_forward(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], slice_by: Column | str | None,
    closing: dict[str, Column] | None = None,
) -> DataFrame:
    """At each row the latest non-null ``values`` of its group up to and including that row.

    ``closing`` are carried to the end of what shares the row's first order column: the latest non-null value
    of all rows whose first order column is at most the row's. Slices must not part rows that are equal in it.
    Both kinds share one shuffle, one sort and one summary. ``order`` must be unique within a group.
    """
    closing = closing or {}
    at = F.struct(*order)
    latest = {n: F.max_by(v, F.when(v.isNotNull(), at)) for n, v in {**values, **closing}.items()}

    def carried(within: list[str]) -> dict[str, Column]:
        group = Window.partitionBy(*within)
        rows = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        peers = group.orderBy(order[0]).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return {n: F.last(v, ignorenulls=True).over(rows) for n, v in values.items()} | {n: latest[n].over(peers) for n in closing}

    if slice_by is None:
        return df.select("*", *[c.alias(n) for n, c in carried(keys).items()])
    df = _sliced(df, keys, order[:1] if closing else order, slice_by)
    summary = df.groupBy(*keys, SLICE).agg(*[c.alias(f"_s_{n}") for n, c in latest.items()])
    summary = summary.select(
        *keys,
        SLICE,
        *[F.last(f"_s_{n}", ignorenulls=True).over(_before(keys)).alias(f"_b_{n}") for n in latest],
    )
    local = df.select("*", *[c.alias(f"_l_{n}") for n, c in carried([*keys, SLICE]).items()])
    joined = local.join(summary, [*keys, SLICE], "left")
    for n in latest:
        joined = joined.withColumn(n, F.coalesce(f"_l_{n}", f"_b_{n}"))
    return joined.drop(SLICE, *[f"_l_{n}" for n in latest], *[f"_b_{n}" for n in latest])


def next_value(
    df: DataFrame, keys: list[str], order: list[str], value: str, slice_by: Column | str | None, out: str
) -> DataFrame:
    """``value`` of the following row of the group, null at its last row; ``order`` must be unique."""
    if slice_by is None:
        return df.withColumn(out, F.lead(value).over(Window.partitionBy(*keys).orderBy(*order)))
    df = _sliced(df, keys, order, slice_by)
    summary = df.groupBy(*keys, SLICE).agg(F.min_by(value, F.struct(*order)).alias("_first"))
    summary = summary.select(
        *keys, SLICE, F.lead("_first").over(Window.partitionBy(*keys).orderBy(SLICE)).alias("_after")
    )
    w = Window.partitionBy(*keys, SLICE).orderBy(*order)
    local = df.select("*", F.lead(value).over(w).alias("_following"), F.lead(F.lit(True)).over(w).alias("_inside"))
    return (
        local.join(summary, [*keys, SLICE], "left")
        .withColumn(out, F.when(F.col("_inside"), F.col("_following")).otherwise(F.col("_after")))
        .drop(SLICE, "_following", "_inside", "_after")
    )


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], value: str, slice_by: Column | str | None, out: str, total: str
) -> DataFrame:
    """Sum of ``value`` up to each row of its group and the group's total; ``order`` must be unique."""
    rows = (Window.unboundedPreceding, 0)
    if slice_by is None:
        w = Window.partitionBy(*keys)
        return df.withColumn(out, F.sum(value).over(w.orderBy(*order).rowsBetween(*rows))).withColumn(
            total, F.sum(value).over(w)
        )
    df = _sliced(df, keys, order, slice_by)
    summary = (
        df.groupBy(*keys, SLICE)
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_offset", F.coalesce(F.sum("_sum").over(_before(keys)), F.lit(0)))
        .withColumn(total, F.sum("_sum").over(Window.partitionBy(*keys)))
        .drop("_sum")
    )
    local = df.withColumn(
        "_local", F.sum(value).over(Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(*rows))
    )
    return (
        local.join(summary, [*keys, SLICE], "left")
        .withColumn(out, F.col("_offset") + F.col("_local"))
        .drop(SLICE, "_local", "_offset")
    )


def attach_extreme(
    df: DataFrame, keys: list[str], picks: dict[str, tuple[str, Column]], slice_by: Column | str | None
) -> DataFrame:
    """Every row with its group's ``min``/``max``/``sum`` of an expression: ``{out: (kind, expression)}``."""
    kinds = {"min": F.min, "max": F.max, "sum": F.sum}
    if slice_by is None:
        w = Window.partitionBy(*keys)
        return df.select("*", *[kinds[k](e).over(w).alias(n) for n, (k, e) in picks.items()])
    if isinstance(slice_by, str):
        # No order is asked for: the aggregate is combined before its shuffle, and the join's heavy left side is split at run time.
        return df.join(df.groupBy(*keys).agg(*[kinds[k](e).alias(n) for n, (k, e) in picks.items()]), keys, "left")
    df = df.withColumn(SLICE, slice_by)
    w = Window.partitionBy(*keys)
    summary = df.groupBy(*keys, SLICE).agg(*[kinds[k](e).alias(n) for n, (k, e) in picks.items()])
    summary = summary.select(*keys, SLICE, *[kinds[k](F.col(n)).over(w).alias(n) for n, (k, _) in picks.items()])
    return df.join(summary, [*keys, SLICE], "left").drop(SLICE)
