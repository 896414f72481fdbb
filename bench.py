"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the
local cores, BENCH_RUNS the warm runs of which the median counts. The action is
a ``noop`` write, so every row and column is computed and none leaves Spark.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from testbed import catalog

HEADLINE = [
    "scan_readings_csv",
    "daily_sensor_average",
    "join_readings_utilization",
    "join_hot_utilization",
    "interruption_days_expanded",
    "label_horizon_documented",
    "label_horizon_as_coded",
    "matrix_parquet_roundtrip",
    "split_train_validation",
    "assemble_features",
    "tree_train_predict",
    "eval_confusion",
    "score_features",
    "request_status",
    "score_requests",
    "score_requests_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="upkeep-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf.group(1)) if sf else None,
                "cpus": cores,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
