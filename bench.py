"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then ``BENCH_RUNS`` timed times; every run
executes the whole plan through the ``noop`` sink (no collect to the driver).
Prints one JSON line: per-query median seconds and their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reelstar.plans.queries import QUERIES  # noqa: E402
from reelstar.session import local_session  # noqa: E402

HEADLINE = [
    "json_parse_watch",
    "stream_watch_ingest",
    "dq_report",
    "scd2_apply",
    "watch_sessions",
    "fact_watch_sessions",
    "daily_engagement",
    "churn_features",
    "two_day_churn",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session("reelstar-bench", cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    del rows
    spark.stop()


if __name__ == "__main__":
    main()
