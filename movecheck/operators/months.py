"""Months as ``yyyymm`` keys: spine, range test, coverage, gaps."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.names import column, resolve

KEY_FORMAT = "yyyyMM"


def _first_day(key: str) -> date:
    if not re.fullmatch(r"\d{6}", key):
        raise ValueError(f"not a yyyymm key: {key!r}")
    return date(int(key[:4]), int(key[4:]), 1)


def _next_month(day: date) -> date:
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)


def month_keys(first: str, last: str) -> list[str]:
    """The keys ``first``..``last``, both included, for use in a filter."""
    day, end = _first_day(first), _first_day(last)
    keys = []
    while day <= end:
        keys.append(f"{day:%Y%m}")
        day = _next_month(day)
    return keys


def months_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """The same keys as a frame with one ``yyyymm`` text column."""
    start, end = _first_day(first), _first_day(last)
    if start > end:
        return spark.createDataFrame([], "yyyymm string")
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 month"))
    return spark.range(0, 1, 1, 1).select(
        F.explode(F.transform(days, lambda d: F.date_format(d, KEY_FORMAT))).alias("yyyymm")
    )


def in_months(value: Column, dtype: T.DataType, first: str, last: str) -> Column:
    """Range test on a date or timestamp, in its own type so that scans see it."""
    start, end = _first_day(first), _next_month(_first_day(last))
    return (value >= F.lit(start).cast(dtype)) & (value < F.lit(end).cast(dtype))


def month_coverage(df: DataFrame, ts: str, first: str, last: str) -> DataFrame:
    """Rows per month of a date or timestamp column, 0 for empty months.

    Rows are counted per month before anything is shuffled, so a month that
    holds most rows costs no more than another.
    """
    (ts,) = resolve(df, [ts])
    dtype = df.schema[ts].dataType
    # Months are grouped as numbers; only the few results are made into text.
    counts = (
        df.filter(in_months(column(ts), dtype, first, last))
        .groupBy((F.year(column(ts)) * 100 + F.month(column(ts))).alias("month"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lpad(F.col("month").cast("string"), 6, "0").alias("yyyymm"), "n_rows")
    )
    spine = months_between(df.sparkSession, first, last)
    return spine.join(counts, "yyyymm", "left").select(
        "yyyymm", F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows")
    )


def missing_months(df: DataFrame, ts: str, first: str, last: str) -> DataFrame:
    """The months of the range in which the column has no row."""
    return month_coverage(df, ts, first, last).filter("n_rows = 0").select("yyyymm")
