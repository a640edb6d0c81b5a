"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the number
of local threads. Every query runs once to warm up, then ``BENCH_RUNS`` times;
its best time counts. ``loop_profile_lineitem`` is the plan to beat: two jobs
per column over a cached table, as a hand-written profile does it. It and the
estimated profile alone are reported beside the queries and are not part of the
total.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.operators import profile
from tarn.plans.queries import QUERIES, table
from tarn.plans.settings import scale_settings
from tarn.sources import listed_bytes

HEADLINE = [
    "bronze_normalize",
    "bronze_json_pages",
    "bronze_csv_roundtrip",
    "bronze_documents_roundtrip",
    "silver_conform",
    "silver_partition_roundtrip",
    "gold_rollup",
    "gold_preview",
    "gold_write_roundtrip",
    "rollup_lineitem",
    "profile_site",
    "profile_approx",
    "profile_lineitem",
    "profile_orders",
    "profile_documents",
    "metadata_silver",
    "metadata_lineitem",
    "control_silver",
    "run_stamp_orders",
    "chain_gold",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def loop_profile(df: DataFrame) -> None:
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    for name in df.columns:
        df.filter(F.col(name).isNull()).count()
        df.select(name).distinct().count()
    df.unpersist(blocking=True)


def best(run, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tarn-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sizes = scale_settings(listed_bytes(spark, sf_dir), spark.sparkContext.defaultParallelism)
    for key, value in sizes.items():
        spark.conf.set(key, value)
    times = {}
    for name in HEADLINE:
        times[name] = best(lambda: consume(QUERIES[name](spark, sf_dir)), runs)
        print(f"{name} {times[name]}", file=sys.stderr)
    lineitem = table(spark, sf_dir, "lineitem")
    beside = {
        "loop_profile_lineitem": best(lambda: loop_profile(lineitem), runs),
        "estimate_lineitem": best(lambda: consume(profile(lineitem, approx=True)), runs),
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "beside": beside,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
