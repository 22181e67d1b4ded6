"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: local cores; BENCH_QUERIES:
comma-separated names instead of the headline list; BENCH_WARMUP=0: do not run
every query once before it is timed. The untimed run compiles the plans' code,
which says nothing about the plans. BENCH_RUNS: timed runs of each query, whose
median counts (3).
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from pyspark.sql import SparkSession

from tagloom.plans.queries import QUERIES
from tagloom.session import configure

HEADLINES = (
    "consumption_power",
    "order_tags",
    "payment_mode",
    "latest_orders",
    "log_tags",
    "page_type_counts",
    "browse_time",
    "url_browse",
    "last_login",
    "last_browsed_product",
    "purchased_products",
    "purchased_product_list",
    "attr_all",
    "attr_nativePlace",
    "product_ratings",
    "brand_ratings",
    "category_ratings",
    "type_slots",
    "rfm_score",
    "rfm_segments",
    "als_rmse",
    "als_favor_types",
    "profile_upsert",
    "profile",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tagloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        # No Python call site is recorded per column: plans are built faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("BENCH_WARMUP", "1") != "0":
        for name in names:
            run(spark, name, sf_dir)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = {name: median(run(spark, name, sf_dir) for _ in range(runs)) for name in names}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
