"""Time the registered queries and print one JSON line.

BENCH_SF_DIR  table folder, default /root/testdata/sf0.1
BENCH_CPUS    local cores, default 8
BENCH_QUERIES comma separated names, default all
BENCH_RUNS    runs per query, the fastest counts, default 2

Every query is executed in full: all its columns are computed and written to the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tidegauge.plans.registry import QUERIES  # noqa: E402

# input rows of a query, for the rates reported next to the times
RATE_TABLES = {
    "log_events": "events",
    "metric_event_keys": "events",
    "dedupe": "events",
    "request_batches": "events",
    "rollup_week": "lineitem",
    "select_series": "lineitem",
    "stream_equals_batch": "events",
}


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = session(cpus)
    spark.range(1000).selectExpr("sum(id)").collect()

    seconds: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
        print(f"{name} {best:.3f}", file=sys.stderr)

    rates = {}
    for name, table in RATE_TABLES.items():
        if name in seconds:
            rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
            rates[name] = round(rows / seconds[name])
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
                "spark": pyspark.__version__,
                "runs": f"best of {runs}",
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
