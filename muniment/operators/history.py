"""Version history of objects and datastreams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muniment.operators import spread


def version_history(df: DataFrame, key: str | list[str], created: str, slice_by: Column | str | None = None) -> DataFrame:
    """One row per object version: distinct created strings in string order, 0-based, with first/last flags."""
    keys = [key] if isinstance(key, str) else key
    dates = df.select(*keys, created).distinct()
    numbered = spread.number_rows(dates, keys, [created], slice_by, "version_index", "_total")
    return numbered.select(
        *keys,
        created,
        F.col("version_index").cast("int").alias("version_index"),
        (F.col("version_index") == 0).alias("is_first"),
        (F.col("version_index") == F.col("_total") - 1).alias("is_last"),
    )


def changed_per_version(
    df: DataFrame,
    key: str,
    created: str,
    ds: str,
    position: str,
    slice_by: Column | str | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per changed datastream version of each object version.

    The list order of a version is (first-seen position of the datastream in its object, position of the
    row): both are columns, so a reader sorts by ``ds_pos, doc_pos``.
    """
    columns = [key, created, ds, position, *(carry or [])]
    placed = spread.attach_extreme(df.select(*columns), [key, ds], {"ds_pos": ("min", F.col(position))}, slice_by)
    return placed.withColumnRenamed(position, "doc_pos")


def was_changed(df: DataFrame, key: str, created: str, ds: str, ds_id: str) -> DataFrame:
    """Per object version: did datastream ``ds_id`` change in it? A map-side combined flag, no lists."""
    return df.groupBy(key, created).agg(F.max(F.col(ds) == ds_id).alias("was_changed"))


def ds_extent(df: DataFrame, keys: list[str], order: list[str], pick: list[str]) -> DataFrame:
    """First and last version of every datastream and the number of versions, as one aggregation."""
    at = F.struct(*order)
    aggs = [F.count(F.lit(1)).alias("n_versions")]
    for c in pick:
        aggs.append(F.min_by(c, at).alias(f"first_{c}"))
        aggs.append(F.max_by(c, at).alias(f"last_{c}"))
    return df.groupBy(*keys).agg(*aggs)


def rank_ds_versions(df: DataFrame, keys: list[str], order: list[str], slice_by: Column | str | None = None) -> DataFrame:
    """Every datastream version flagged as first / last of its datastream in time order."""
    at = F.struct(*order)
    marked = spread.attach_extreme(df, keys, {"_first": ("min", at), "_last": ("max", at)}, slice_by)
    return (
        marked.withColumn("is_first", F.col("_first") == at)
        .withColumn("is_last", F.col("_last") == at)
        .drop("_first", "_last")
    )


def with_create_date(
    df: DataFrame, keys: list[str], order: list[str], created: str, slice_by: Column | str | None = None
) -> DataFrame:
    """Every datastream version with the created value of its datastream's first version."""
    columns = [*order, *([created] if created not in order else [])]
    first = spread.attach_extreme(df, keys, {"_first": ("min", F.struct(*columns))}, slice_by)
    return first.withColumn("create_date", F.col(f"_first.{created}")).drop("_first")


def asof_state(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], slice_by: Column | str | None = None
) -> DataFrame:
    """Carry each value forward on its own: complete state at every version."""
    return spread.carry_forward(df, keys, order, values, slice_by)


def head_only(df: DataFrame, object_key: str, resource: list[str], order: list[str], created: str) -> DataFrame:
    """One version per object: the last write of each resource, stamped with the object's first version date."""
    keys = [object_key, *resource]
    rest = [c for c in df.columns if c not in keys]
    heads = (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_head"))
        .select(*keys, "_head.*")
    )
    first = df.groupBy(object_key).agg(F.min(created).alias("version_date"))
    return heads.join(first, object_key, "left")


def snapshot_at(
    df: DataFrame, keys: list[str], order: list[str], upto: Column | None = None, deleted: Column | None = None
) -> DataFrame:
    """Everything live at a point: the latest row of each resource at or before it, minus deleted ones.

    ``upto`` is the condition of the point; leave it out when ``df`` is already filtered at its scan.
    """
    rest = [c for c in df.columns if c not in keys]
    live = (
        (df if upto is None else df.where(upto))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
    )
    return live if deleted is None else live.where(~deleted)


def target_objects(
    df: DataFrame,
    atomic: bool,
    object_id: Column,
    resource_id: Column,
    created: str,
    on_object: Column,
    slice_by: Column | str | None = None,
) -> DataFrame:
    """Versions per target object.

    Archival: one target per source object. Atomic: one per resource; rows with ``on_object`` belong to the
    object itself. The version numbering is made anew for every target.
    """
    target = F.when(on_object, object_id).otherwise(resource_id) if atomic else object_id
    return version_history(df.withColumn("target_id", target), "target_id", created, slice_by)
