"""One-pass operators against the plainer shapes they replace.

Usage: python benchmarks/compare_shapes.py [SF_DIR]

The plainer shapes are written here from their description: a profile with one
query per column whose digits come from a row-at-a-time Python function, and a
comparison by two subtractions with separate counts and samples.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import catalogue
import movecheck as mc


def sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


@F.udf(T.IntegerType())
def text_length(value):
    return None if value is None else len(repr(value))


def profile_per_column(df) -> None:
    for field in df.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, T.NumericType):
            sink(df.select(text_length(value).alias("n")).agg(F.max("n")))
        elif isinstance(field.dataType, T.StringType):
            df.agg(F.max(F.length(value))).collect()
        else:
            df.agg(F.count(value)).collect()


def bag_differences(left, right) -> None:
    """Both bag differences, counted by side in one grouped query."""
    sides = [
        a.exceptAll(b).select(F.lit(name).alias("side")) for name, a, b in (("left", left, right), ("right", right, left))
    ]
    sink(sides[0].unionByName(sides[1]).groupBy("side").count())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    replica = catalogue.lineitem_replica(lineitem)
    cases = {
        "profile, text digit sizes, one pass": lambda: sink(mc.text_digit_profile(lineitem)),
        "profile, all measures, one pass per kind": lambda: sink(mc.profile_columns(lineitem)),
        "profile, one query per column with a Python function": lambda: profile_per_column(lineitem),
        "reconcile report, one shuffle": lambda: sink(mc.reconcile(lineitem, replica).report(5)),
        "two bag differences, counted": lambda: bag_differences(lineitem, replica),
    }
    for name, run in cases.items():
        times = []
        for _ in range(3):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        print(f"{name}: best of 3 {min(times):.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
