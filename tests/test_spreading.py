"""Work dealt by rows, files written by tasks, and the reader against texts between elements."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from muniment.plans import record_queries, source_queries
from muniment.session import spread_rows
from muniment.sources import records


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    """A small columnar file is one split: its rows are dealt to more tasks than there are cores."""
    one = spark.range(1000).repartition(1)
    n = spark.sparkContext.defaultParallelism
    assert spread_rows(one).rdd.getNumPartitions() == n
    dealt = spread_rows(one, 10)
    assert dealt.rdd.getNumPartitions() == 100 > n and dealt.distinct().count() == 1000
    assert spread_rows(dealt, 10).rdd.getNumPartitions() == 100
    monkeypatch.setattr(record_queries, "AT_ONCE", 20)
    assert record_queries.order_records(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() > n


def test_one_file_per_id(spark):
    """Many ids in few folders; rows of one id are lines of one file, a null value is an empty line."""
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(600)] + [(7, "again"), (8, None), (None, "no id")], "id bigint, value string")
    root = source_queries._one_file_per_id(rows, "files")
    files = records.scan_records(spark, root).select(F.col("xml").alias("value"), F.col("path").alias("f")).collect()
    want = [f"t{i}\n" for i in range(600) if i not in (7, 8)] + ["again\nt7\n", "\nt8\n", "no id\n"]
    assert Counter(r.value for r in files) == Counter(want)
    assert len({r.f.rpartition("/")[0] for r in files}) <= source_queries.FOLDERS
