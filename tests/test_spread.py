"""The sliced forms against plain loops, on groups where one key holds most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from muniment.operators import spread

KEYS = ["key"]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    out, used = [], set()
    for i in range(600):
        key = "hot" if rnd.random() < 0.6 else rnd.choice("abcdefg")
        at = rnd.randrange(2000)
        if (key, at) not in used:
            used.add((key, at))
            out.append((key, at, i if rnd.random() < 0.2 else None, rnd.randrange(9)))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "key string, at int, v int, n int")


def slices(width):
    return spread.by_range("at", width) if isinstance(width, int) else width


def groups(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        by.setdefault(r[0], []).append(r)
    return by


@pytest.mark.parametrize("width", [None, 1, 50, 5000, spread.MEASURED])
def test_number_rows(df, rows, width):
    got = spread.number_rows(df, KEYS, ["at"], slices(width), "i", "total")
    want = {(k, r[1]): (i, len(g)) for k, g in groups(rows).items() for i, r in enumerate(g)}
    assert {(r.key, r.at): (r.i, r.total) for r in got.collect()} == want


@pytest.mark.parametrize("width", [None, 1, 50, 5000, spread.MEASURED])
def test_carry_forward(df, rows, width):
    got = spread.carry_forward(
        df, KEYS, ["at"], {"c": F.col("v"), "e": F.when(F.col("n") == 3, F.col("at"))}, slices(width)
    )
    want = {}
    for k, g in groups(rows).items():
        c = e = None
        for r in g:
            c = r[2] if r[2] is not None else c
            e = r[1] if r[3] == 3 else e
            want[(k, r[1])] = (c, e)
    assert {(r.key, r.at): (r.c, r.e) for r in got.collect()} == want


@pytest.mark.parametrize("width", [None, 1, 50, 5000, spread.MEASURED])
def test_next_value(df, rows, width):
    got = spread.next_value(df, KEYS, ["at"], "v", slices(width), "_next")
    want = {(k, r[1]): (g[i + 1][2] if i + 1 < len(g) else None) for k, g in groups(rows).items() for i, r in enumerate(g)}
    assert {(r.key, r.at): r._next for r in got.collect()} == want


@pytest.mark.parametrize("width", [None, 1, 50, 5000, spread.MEASURED])
def test_running_sum(df, rows, width):
    got = spread.running_sum(df, KEYS, ["at"], "n", slices(width), "upto", "total")
    want = {}
    for k, g in groups(rows).items():
        for i, r in enumerate(g):
            want[(k, r[1])] = (sum(x[3] for x in g[: i + 1]), sum(x[3] for x in g))
    assert {(r.key, r.at): (r.upto, r.total) for r in got.collect()} == want


@pytest.mark.parametrize("width", [None, 1, 50, 5000, spread.MEASURED])
def test_attach_extreme(df, rows, width):
    got = spread.attach_extreme(
        df, KEYS, {"lo": ("min", F.col("at")), "hi": ("max", F.col("at")), "s": ("sum", F.col("n"))}, slices(width)
    )
    want = {(k, r[1]): (g[0][1], g[-1][1], sum(x[3] for x in g)) for k, g in groups(rows).items() for r in g}
    assert {(r.key, r.at): (r.lo, r.hi, r.s) for r in got.collect()} == want


def test_hot_group_is_not_one_window_partition(df):
    """The only whole-group window of the sliced form runs over the summary."""
    plan = spread.number_rows(df, KEYS, ["at"], spread.by_range("at", 50), "i", "t")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [row_number" in line]
    assert windows and all("_slice" in line for line in windows)


@pytest.mark.parametrize("width", [None, 1, 50, 5000, spread.MEASURED])
def test_carry_to_the_end_of_equal_first_columns(df, rows, width):
    coarse = df.withColumn("block", F.floor(F.col("at") / 25) * 25)
    by = spread.by_range("block", width) if isinstance(width, int) else width
    got = spread.carry_forward(coarse, KEYS, ["block", "at"], {"c": F.col("v")}, by, {"e": F.col("v")})
    want = {}
    for k, g in groups(rows).items():
        for i, r in enumerate(g):
            last = lambda some: next((x[2] for x in reversed(some) if x[2] is not None), None)
            want[(k, r[1])] = (last(g[: i + 1]), last([x for x in g if x[1] // 25 <= r[1] // 25]))
    assert {(r.key, r.at): (r.c, r.e) for r in got.collect()} == want


def test_measured_slices_cut_a_crowded_group_evenly(spark):
    """Nearly all rows lie in one group and one day; no slice holds over twice its share."""
    n, slices = 40_000, int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(n).select(
        F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(F.lit(-1)).alias("key"),
        (F.lit(1_700_000_000_000) + F.col("id") * 7 % 1000).alias("at"), "id",
    )
    cut = spread._sliced(rows, KEYS, ["at", "id"], spread.MEASURED).groupBy("key", spread.SLICE).agg(
        F.count("*").alias("n"), F.min(F.struct("at", "id")).alias("lo"), F.max(F.struct("at", "id")).alias("hi")
    )
    hot = sorted((r for r in cut.collect() if r.key == -1), key=lambda r: r[spread.SLICE])
    assert sum(r.n for r in hot) == n - n // 50 and max(r.n for r in hot) <= 2 * n / slices
    assert all(tuple(a.hi) < tuple(b.lo) for a, b in zip(hot, hot[1:]))
