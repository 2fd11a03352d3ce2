"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: median seconds of RUNS warm runs each, as one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, os.environ.get("PYTHONPATH"))))

HEADLINE = (
    "X1_denormalize",
    "A18_long_features",
    "A12_histograms",
    "W5_deltas",
    "W5_long_deltas",
    "R1_pivot",
    "A22_cardinality",
    "W10_tumbling",
    "A26_trace_roll_up",
    "C24_parameterized_routes",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    from pyspark.sql import SparkSession

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    from skeinspark.plans.catalog import QUERIES

    seconds = {}
    for name in HEADLINE:
        took = []
        for _ in range(RUNS + 1):  # the first compiles
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        seconds[name] = round(median(took[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "telemetry_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
