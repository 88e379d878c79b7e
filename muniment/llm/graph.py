"""Connected components of a link table, by turns of large and small stars; nothing of the graph reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muniment.session import stage


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link, the root being the smallest node of its component.

    Each turn ties every node's larger neighbours, then its smaller ones, to the least node it sees; the number of turns grows with the
    logarithm of the longest path. Minima are aggregated before the shuffle and joined back, so that a
    node with very many links is split like any skewed join. Each turn is written once.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = stage(links.where(F.col(a) != F.col(b)).select(u, v).distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
