"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table directory and ``BENCH_CPUS`` the number of cores. All
queries run once to warm up the JVM; then each runs ``BENCH_RUNS`` times and its median
counts. Results go to the ``noop`` sink, so every row is computed and none is kept.
"""

from __future__ import annotations

import itertools
import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickloom.fixtures.queries import queries, write_csv  # noqa: E402
from clickloom.plans import batch  # noqa: E402
from clickloom.sources.scratch import scratch_folder  # noqa: E402

HEADLINE = [
    "dedupe_events",
    "enrich",
    "cleaned_events",
    "activity_by_region_hour",
    "device_statistics",
    "user_activity",
    "top_users",
    "daily_activity",
    "region_rollup",
    "top_regions",
    "recent_days",
    "distinct_users",
    "distinct_regions",
    "raw_profile",
    "run_summary",
    "valid_rows",
    "corrupt_rows",
    "read_cleaned",
]


def timed(job, runs: int) -> float:
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        job()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clickloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def drain(name: str):
        query = queries()[name]
        return lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save()

    folder = scratch_folder(spark)
    csv_path = write_csv(spark, sf_dir, folder)
    ids = (f"run-{n}" for n in itertools.count())
    jobs = {name: drain(name) for name in HEADLINE}
    jobs["whole_run"] = lambda: batch.run(spark, csv_path, folder, next(ids))
    for job in jobs.values():
        job()
    results = {name: timed(job, runs) for name, job in jobs.items()}
    rows = queries()["clickstream_raw"](spark, sf_dir).count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
                "raw_rows": rows,
                "whole_run_rows_per_sec": round(rows / results["whole_run"]),
            }
        )
    )


if __name__ == "__main__":
    main()
