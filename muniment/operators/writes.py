"""Which resources a version writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muniment.operators import spread


def resources_to_write(changed: DataFrame, touched: DataFrame, key: str, version: str, resource: str) -> DataFrame:
    """(key, version, resource) of every description or object a version (re)writes.

    ``changed`` are the resources whose own content changed, ``touched`` those named by metadata of other
    datastreams. A touched resource counts only once it exists, that is from its first change on.
    """
    own = changed.select(key, version, resource).distinct()
    first = changed.groupBy(key, resource).agg(F.min(version).alias("_first"))
    named = (
        touched.select(key, version, resource).distinct().join(first, [key, resource])
        .where(F.col("_first") <= F.col(version))
        .select(key, version, resource)
    )
    return own.unionByName(named).distinct()
