"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` an optional
comma-separated choice (``all`` for every query). Each query runs once to warm up, then up to ``BENCH_RUNS`` times
(default 3, fewer once they took 15 seconds together); the median counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from muniment.plans.queries import QUERIES
from muniment.session import build_session

HEADLINE = (
    "version_history", "changed_per_version", "rank_ds_versions", "asof_state", "head_only", "snapshot_at", "apply_deletes",
    "resolve_by_digest", "filename_history", "shred_versions", "validate_inline", "validate_content", "extract_dc", "ntriples",
    "manifest", "version_state", "latency_percentiles", "run_report", "migrated_resources",
)


def run(spark, fn, sf_dir: str) -> float:
    start = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = build_session(
        "muniment-bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, QUERIES[name], sf_dir)
        taken: list[float] = []
        while len(taken) < runs and sum(taken) < 15:
            taken.append(run(spark, QUERIES[name], sf_dir))
        times[name] = round(statistics.median(taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale.group(1)) if scale else sf_dir, "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
