"""Object and datastream states, and the deletions they ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muniment import model as M
from muniment.operators import spread


def object_state(properties: Column) -> Column:
    """State of an object from its ordered property array: the first state property; null when missing."""
    return F.try_element_at(
        F.transform(F.filter(properties, lambda p: p["name"] == M.STATE_PROPERTY), lambda p: p["value"]), F.lit(1)
    )


def missing_state(objects: DataFrame) -> DataFrame:
    """Rejects of objects without state information."""
    return objects.where(F.col("object_state").isNull()).select(
        "pid", F.concat(F.lit("no state property in "), "pid").alias("message")
    )


def object_doomed(state: Column, delete_inactive: bool) -> Column:
    words = [M.OBJECT_DELETED] + ([M.OBJECT_INACTIVE] if delete_inactive else [])
    return F.coalesce(state.isin(words), F.lit(False))


def datastream_doomed(state: Column, delete_inactive: bool) -> Column:
    letters = [M.DS_DELETED] + ([M.DS_INACTIVE] if delete_inactive else [])
    return F.coalesce(state.isin(letters), F.lit(False))


def apply_deletes(
    objects: DataFrame,
    datastreams: DataFrame,
    key: str,
    resource: str,
    object_state: str,
    ds_state: str,
    delete_inactive: bool,
    run_ts: str,
) -> DataFrame:
    """Tombstones ``(key, resource, scope, deleted_at)``; an object without deletions gives no row.

    A deleted object takes all its datastreams with it (scope ``object`` for its own row, ``datastream`` for
    theirs); otherwise single datastreams go by their own state.
    """
    states = objects.select(key, F.col(object_state).alias("_object_state"))
    ds = datastreams.select(key, resource, F.col(ds_state).alias("_ds_state"))
    joined = ds.join(states, key, "left")
    gone = object_doomed(F.col("_object_state"), delete_inactive) | datastream_doomed(F.col("_ds_state"), delete_inactive)
    of_datastreams = joined.where(gone).select(key, F.col(resource).cast("string").alias("resource"), F.lit("datastream").alias("scope"))
    of_objects = states.where(object_doomed(F.col("_object_state"), delete_inactive)).select(
        key, F.lit(None).cast("string").alias("resource"), F.lit("object").alias("scope")
    )
    return of_datastreams.unionByName(of_objects).withColumn("deleted_at", F.lit(run_ts))
