"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1) and
``BENCH_CPUS`` the local cores (default 8). Every query runs once to compile
and once on the clock, into a sink that reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

import catalogue

HEADLINE = (
    "profile_lineitem_estimated",
    "profile_lineitem",
    "profile_documents",
    "numeric_profile_extendedprice",
    "text_digit_profile_lineitem",
    "reconcile_lineitem",
    "reconcile_lineitem_counts",
    "reconcile_orders_report",
    "reconcile_orders_bag",
    "reconcile_documents",
    "reconcile_orders_by_key",
    "reconcile_orders_mismatches",
    "conform_orders",
    "contract_losses_orders",
    "null_violations_documents",
    "drift_report_orders",
    "union_aligned_orders",
    "cast_loss_orders",
    "fit_decimals_lineitem",
    "cast_elements_embeddings",
    "missing_rows_documents",
    "missing_rows_lineitem",
    "month_coverage_orders",
    "scan_months_by_date",
    "failure_summary_events",
    "read_positional_lineitem",
    "write_partitioned_lineitem",
    "migrate_orders_difference",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
