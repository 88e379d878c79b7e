"""Exact percentiles by selection, inventories by one sweep over versions."""

from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from muniment.operators import inventory, report


def plain_percentile(values, p):
    values = sorted(values)
    return values[max(1, math.ceil(p * len(values))) - 1]


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_percentiles_are_exact(spark, monkeypatch, accuracy):
    """Also with sketches so coarse that intervals hold many rows; ties, one-row groups, nulls in value and key."""
    monkeypatch.setattr(report, "ACCURACY", accuracy)
    dice = random.Random(accuracy)
    rows = [(dice.choice(["a", "b", None]), dice.choice([None, 7, dice.randint(0, 50), dice.randint(0, 100_000)])) for _ in range(5000)] + [("one", 3), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(6)
    points = [0.0, 0.5, 0.9, 0.99, 1.0]
    got = {(r.k, r.point): (r.percentile, r.n) for r in report.latency_percentiles(df, ["k"], "v", points, None).collect()}
    groups = {k: [v for g, v in rows if g == k and v is not None] for k in ("a", "b", None, "one")}
    assert got == {(k, p): (plain_percentile(v, p), len(v)) for k, v in groups.items() for p in points}


def test_percentiles_where_an_interval_misses(spark, monkeypatch):
    """Intervals that hold nothing: every group is taken by its histogram."""
    df = spark.range(1000).select(F.lit("a").alias("k"), (F.col("id") % 37).alias("v"))
    monkeypatch.setattr(F, "percentile_approx", lambda value, asked, accuracy: F.array(*[F.lit(-5).cast("long") for _ in asked]))
    got = report.latency_percentiles(df, ["k"], "v", [0.5], None).collect()
    assert [(r.percentile, r.n) for r in got] == [(plain_percentile([i % 37 for i in range(1000)], 0.5), 1000)]


def test_inventory_of_many_versions(spark):
    n = 5000
    dice = random.Random(4)
    intervals, versions, live, states = [], [(f"o", v, f"c{v}", "m", "u", None) for v in range(1, n + 1)], {}, {}
    for v in range(1, n + 1):
        path = f"p{dice.randrange(6)}"
        if path in live:
            intervals[live[path]][4] = v
        if dice.random() < 0.8 or path not in live:
            live[path] = len(intervals)
            intervals.append(["o", path, f"d{dice.randrange(9)}", v, None])
        else:
            del live[path]
        state = {}
        for p, i in live.items():
            state.setdefault(intervals[i][2], []).append(p)
        states[f"v{v}"] = {d: sorted(ps) for d, ps in state.items()}
    manifest = spark.createDataFrame([("o", f"d{i}", f"v1/content/{i}") for i in range(9)], "object_id string, digest string, content_path string")
    made = inventory.inventory_json(manifest, spark.createDataFrame(intervals, "object_id string, path string, digest string, from_version int, to_version int"), spark.createDataFrame(
        versions, "object_id string, version int, created string, message string, user_name string, user_address string"), "sha256")
    assert "Join" not in made._jdf.queryExecution().executedPlan().toString()
    [row] = made.collect()
    document = json.loads(row.inventory)
    assert row.head == document["head"] == f"v{n}" and list(document["versions"]) == [f"v{v}" for v in range(1, n + 1)]
    assert {k: v["state"] for k, v in document["versions"].items()} == states
    assert document["versions"]["v3"] | {"state": 0} == {"created": "c3", "message": "m", "user": {"name": "u"}, "state": 0} and document["manifest"]["d2"] == ["v1/content/2"]
