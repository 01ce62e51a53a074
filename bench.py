"""Time the registered queries.  Prints one JSON line.

Each query runs once to warm up and then three times into the ``noop`` sink; its
time is the median.  Building the query counts, since some do work then.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from storeflow.catalog import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("storeflow-bench")
        .config("spark.sql.shuffle.partitions", CPUS if CPUS.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    seconds, cold = {}, {}
    for name in QUERIES:
        cold[name] = round(timed(spark, name), 3)
        seconds[name] = round(statistics.median(timed(spark, name) for _ in range(RUNS)), 3)
    report = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "cold": cold,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": CPUS,
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
