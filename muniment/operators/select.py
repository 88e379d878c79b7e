"""Which objects a run takes: limit, id list, resume point, ledger; in that order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muniment.operators import spread
from muniment.session import stage

_LOCAL = (1 << 33) - 1

# Fixed value: the id that stands for "no id before" at position 0.
FIRST_RUN = "foo"


def filter_pids(df: DataFrame, pid_list: DataFrame | None, key: str) -> DataFrame:
    """Keep the listed ids; no list or an empty list accepts everything."""
    if pid_list is None or pid_list.isEmpty():
        return df
    listed = pid_list.select(F.col(pid_list.columns[0]).alias(key)).distinct()
    return df.join(listed, key, "left_semi").select(*df.columns)


def with_positions(ids: DataFrame, order: list[str], out: str = "position") -> DataFrame:
    """0-based position of every row in ``order``, without a global window.

    Range partitions are sorted in parallel and written once (so partition numbers cannot change under
    a re-run of a task); a table with one row per partition then gives each partition its offset.
    """
    ordered = (
        ids.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    kept = stage(ordered, "positions").withColumn("_part", F.shiftrightunsigned("_mid", 33))
    # One row per partition of the sort: the window and the broadcast are bounded by the partition count.
    offsets = (
        kept.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_offset",
            F.coalesce(
                F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .drop("_n")
    )
    return (
        kept.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_LOCAL)))
        .drop("_part", "_mid", "_offset")
    )


def limit_objects(ids: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` objects in scan order; negative takes all, zero none."""
    if n < 0:
        return ids
    return with_positions(ids, order).where(F.col("position") < n).drop("position")


def resume_after(
    ids: DataFrame, position: int, last_id: str, key: str, order: list[str], resume: bool = True
) -> DataFrame:
    """Skip the first ``position`` ids, after checking that the id before the resume point is the expected one.

    The check ignores case. With ``resume=False`` everything is taken but the check still applies. At
    position 0 the expected id is the first-run marker.
    """
    placed = with_positions(ids, order)
    if position > 0:
        before = placed.where(F.col("position") == position - 1).select(key).take(1)
        reached = bool(placed.where(F.col("position") == position).take(1))
        found = str(before[0][0]) if before else None
        if reached and (found is None or found.lower() != last_id.lower()):
            raise ValueError(f"resume point {position} does not follow {last_id!r} (found {found!r})")
    elif last_id.lower() != FIRST_RUN:
        raise ValueError(f"resume point 0 does not follow {last_id!r}")
    kept = placed.where(F.col("position") >= position) if resume else placed
    return kept.drop("position")


def pending(ids: DataFrame, ledger: DataFrame | None, key: str) -> DataFrame:
    """Ids without a successful entry in the ledger."""
    if ledger is None:
        return ids
    return ids.join(ledger.where(F.col("status") == "done").select(key).distinct(), key, "left_anti")


def select_objects(
    ids: DataFrame,
    key: str,
    order: list[str],
    limit: int = -1,
    pid_list: DataFrame | None = None,
    position: int = 0,
    last_id: str = FIRST_RUN,
    resume: bool = False,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """Limit, then id list, then resume point or ledger. Works on ids and paths only, never on whole records."""
    chosen = filter_pids(limit_objects(ids, limit, order), pid_list, key)
    if position > 0 or last_id.lower() != FIRST_RUN:
        chosen = resume_after(chosen, position, last_id, key, order, resume)
    return pending(chosen, ledger, key) if resume else chosen
