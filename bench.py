"""Times the headline queries and prints one JSON line.

Reads ``$BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on
``local[$BENCH_CPUS]``. Every query runs once to warm up and then
``$BENCH_REPEATS`` times (default 1); the best time counts. Results go to
Spark's ``noop`` sink, so whole results are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks.queries import queries

HEADLINE = (
    "normalize",
    "clean",
    "quality_bronze",
    "quality_by_day",
    "clean_rows",
    "quarantine_rows",
    "deduplicate",
    "enrich",
    "gold_daily_zone",
    "quality_silver",
    "rule_trend",
    "run_bronze",
    "run_gold",
)


def session(cpus: str) -> SparkSession:
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = session(cpus)
    every = queries()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        best = float("inf")
        for attempt in range(repeats + 1):
            started = time.perf_counter()
            every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:
                best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    record = {"metric": "total_query_seconds", "value": total, "unit": "sec"}
    print(json.dumps({**record, "queries": times, "sf": sf_dir.rsplit("/sf", 1)[-1]}))


if __name__ == "__main__":
    main()
