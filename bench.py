"""Time the registered queries and print one JSON line.

Settings: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8), BENCH_RUNS (3),
BENCH_QUERIES (comma-separated names; all by default). Each query is run once to warm up and then
BENCH_RUNS times; its figure is the median, the headline the sum of all figures. Every row and
column of a result is computed.
"""

from __future__ import annotations

import importlib
import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402


def _session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _seconds(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    queries = importlib.import_module("__spark_entry__").queries()
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else list(queries)

    spark = _session(os.environ.get("BENCH_CPUS", "8"))
    figures = {}
    for name in names:
        _seconds(queries[name], spark, sf_dir)
        figures[name] = round(statistics.median(_seconds(queries[name], spark, sf_dir) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(figures.values()), 4),
                "unit": "sec",
                "queries": figures,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
