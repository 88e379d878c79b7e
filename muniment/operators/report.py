"""Totals, exact percentiles and profiles."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muniment.operators import spread
from muniment.session import stage


def run_report(writes: DataFrame, rejects: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Objects, versions, resources and bytes written, and objects failed.

    Distinct counts come from two-step aggregations: rows are first reduced to one per object (or
    resource), so no task ever holds the set of a whole group.
    """
    by = by or []
    per_resource = writes.groupBy(*by, "object_id", "resource_id").agg(
        F.count(F.lit(1)).alias("n_versions"), F.sum(F.coalesce("bytes", F.lit(0))).alias("bytes")
    )
    per_object = per_resource.groupBy(*by, "object_id").agg(
        F.count(F.lit(1)).alias("n_resources"), F.sum("n_versions").alias("n_versions"), F.sum("bytes").alias("bytes")
    )
    totals = per_object.groupBy(*by).agg(
        F.count(F.lit(1)).alias("objects"),
        F.sum("n_resources").alias("resources"),
        F.sum("n_versions").alias("resource_versions"),
        F.sum("bytes").alias("bytes"),
    )
    failed = rejects.select(*by, "pid", "path").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("failures"))
    # Without dimensions both sides are one row, joined on a constant.
    keys = by or ["_one"]
    if not by:
        totals, failed = totals.withColumn("_one", F.lit(1)), failed.withColumn("_one", F.lit(1))
    counts = ("objects", "resources", "resource_versions", "bytes", "failures")
    return totals.join(failed, keys, "full_outer").select(
        *by, *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in counts]
    )


#: Ranks are first told to within one part in so many.
ACCURACY = 10_000


def latency_percentiles(
    df: DataFrame, by: list[str], value: str, points: list[float], slice_by: Column | None
) -> DataFrame:
    """Exact nearest-rank percentiles per group, one row per group and point.

    Selection in two passes: sketches, merged per group, give each point an interval of values that its rank lies in; then the rows below the interval are
    counted, and only those inside are told apart by value. Both are combined before the shuffle, and no window runs over more than the values inside. Should an interval miss its
    rank, the groups concerned are taken by ``percentiles_by_histogram``, sliced by ``slice_by``.
    """
    known = df.where(F.col(value).isNotNull())
    margin = 2 / ACCURACY
    asked = [q for p in points for q in (max(0.0, p - margin), min(1.0, p + margin))]
    borders = known.groupBy(*by).agg(F.count(F.lit(1)).alias("_total"), F.percentile_approx(value, asked, ACCURACY).alias("_at"))
    each = F.array(*[
        F.struct(F.lit(p).alias("point"), F.greatest(F.ceil(F.lit(p) * F.col("_total")), F.lit(1)).alias("rank"), F.col("_at")[2 * i].alias("low"), F.col("_at")[2 * i + 1].alias("high"))
        for i, p in enumerate(points)
    ])
    borders = stage(borders.select(*by, "_total", each.alias("_points")), "percentile-borders")
    keyed = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in by]
    renamed = borders.select(*[F.col(c).alias(f"_b_{c}") for c in by], "_total", "_points")
    joined = known.select(*by, value).join(renamed, reduce(and_, keyed)) if by else known.select(value).join(renamed)
    # A row counts for a point if it does not lie above its interval; below it, its value does not matter.
    met = joined.select(*by, value, "_total", F.explode(F.filter("_points", lambda p: F.col(value) <= p["high"])).alias("_p"))
    inside = F.when(F.col(value) >= F.col("_p.low"), F.col(value))
    counts = met.groupBy(*by, "_total", F.col("_p.point").alias("point"), F.col("_p.rank").alias("_rank"), inside.alias("percentile")).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*by, "point").orderBy(F.col("percentile").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    summed = counts.withColumn("_upto", F.sum("_n").over(order))
    hit = F.col("percentile").isNotNull() & (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank"))
    found = stage(summed.where(hit).select(*by, "point", "percentile", F.col("_total").alias("n")), "percentiles")
    if found.count() == len(points) * borders.count():
        return found
    whole = found.groupBy(*by).count().where(F.col("count") == len(points)).drop("count")
    same = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in by] or [F.lit(True)]
    ready = found.alias("_l").join(whole.alias("_r"), reduce(and_, same), "left_semi")
    left = known.alias("_l").join(whole.alias("_r"), reduce(and_, same), "left_anti")
    return ready.unionByName(percentiles_by_histogram(left, by, value, points, slice_by))


def percentiles_by_histogram(
    df: DataFrame, by: list[str], value: str, points: list[float], slice_by: Column | None
) -> DataFrame:
    """The same from the histogram of all distinct values, cumulated slice by slice."""
    histogram = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    summed = spread.running_sum(histogram, by, [value], "_n", slice_by, "_upto", "_total")
    wanted = F.explode(F.array(*[F.lit(p) for p in points]))
    return (
        summed.select(*by, value, "_n", "_upto", "_total", wanted.alias("point"))
        .withColumn("_rank", F.greatest(F.ceil(F.col("point") * F.col("_total")), F.lit(1)))
        .where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
        .select(*by, "point", F.col(value).alias("percentile"), F.col("_total").alias("n"))
    )


def profile(df: DataFrame, dimensions: list[str], measures: dict[str, Column]) -> DataFrame:
    """Counts and sums over the hierarchy of ``dimensions``, subtotals included (null = all)."""
    return (
        df.rollup(*dimensions)
        .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"), *[F.sum(e).alias(n) for n, e in measures.items()])
    )
