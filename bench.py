"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores. Every query is
run once to warm up and then timed: once if that takes over five seconds, else
three times for the median. Its result goes to a sink that drops it.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tallygrid.checks import catalog

HEADLINE = (
    "scan_project",
    "filter_predicates",
    "star_join",
    "fact_join",
    "agg_summary",
    "agg_count_distinct",
    "overlap_join",
    "overlap_explode",
    "prorate_overlap",
    "dense_rank_two_orders",
    "segment_profile",
    "mart_registry",
    "mart_discounts",
    "mart_invoice_core",
    "mart_detail",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "2000")  # a run has more compiled stages than the default keeps
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    times = {}
    for name in chosen:
        run(spark, name, sf_dir)
        taken = [run(spark, name, sf_dir)]
        if taken[0] < 5:
            taken += [run(spark, name, sf_dir) for _ in range(2)]
        times[name] = round(statistics.median(taken), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}))


if __name__ == "__main__":
    main()
