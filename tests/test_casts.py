from __future__ import annotations

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.casts import lost, safe_cast

TEXTS = [
    "", " ", "1", " 1 ", "\t1\n", "\x001\x7f", "+1", "-1", "- 1", "1-URGENT", "1.5", ".5", "5.", "1e3", "1E-3", "1e", "--1",
    "127", "128", "-128", "-129", "32768", "2147483648", "9223372036854775807", "9223372036854775808", "00000000000000000001",
    "NaN", "nan", "Infinity", "-inf", "+INF", "infinit", "1d", "1f", "0x1p3", "1_000", "1,000", "١٢", " 1",
    "true", "TRUE", "t", "yes", "y", "no", "0", "on", "truth", "2022-07-01", "2022-7-1", "2022", "2022-13-01", "+12022-01-01",
    "2022-07-01 10:00:00", "2022-07-01T10:00:00Z", "T10:30", "10:30:15", "20220701", "x2022-01-01", "now", "epoch", "1e400",
    "99999999999999999999999999999999999999", "1e-400", "decimal", "12 34", " 1", "+.5e+2", "-0", "1L", "1s", "220-01-01",
]
TARGETS = [
    "tinyint", "smallint", "int", "bigint", "float", "double", "decimal(38,9)", "decimal(5,2)", "boolean", "date",
    "timestamp", "timestamp_ntz",
]


def compare(spark, values, ddl, targets):
    own = T.DataType.fromDDL(ddl)
    frame = spark.createDataFrame([(v,) for v in values], f"x {ddl}")
    x = F.col("x")
    for target in targets:
        wanted = T.DataType.fromDDL(target)
        plain = x.try_cast(wanted).cast("string").alias("plain")
        ours = safe_cast(x, own, wanted).cast("string").alias("ours")
        gone = lost(x, own, wanted).alias("lost")
        for r in frame.select(x, plain, ours, gone).collect():
            assert r.plain == r.ours, (r.x, target)
            assert r.lost == (r.x is not None and r.plain is None), (r.x, target)


def test_texts_cast_as_try_cast_does(spark):
    # Times without a date take today's, so only their success is compared.
    texts = [t for t in TEXTS if t not in ("T10:30", "10:30:15")]
    compare(spark, [*texts, None], "string", TARGETS)


def test_times_without_a_date(spark):
    frame = spark.createDataFrame([("T10:30",), ("10:30:15",)], "x string")
    casts = safe_cast(F.col("x"), T.StringType(), T.TimestampType())
    assert [r[0] for r in frame.select(casts.isNull()).collect()] == [
        r[0] for r in frame.select(F.col("x").try_cast("timestamp").isNull()).collect()
    ]


@pytest.mark.parametrize("ddl", ["float", "double"])
def test_floats_cast_as_try_cast_does(spark, ddl):
    ends = [float(s * 2**b + d) for b in (7, 15, 31, 63) for s in (1, -1) for d in (-1.5, -1, -0.5, 0, 0.5, 1, 1.5)]
    values = [*ends, math.nan, math.inf, -math.inf, 0.0, -0.0, 1e300 if ddl == "double" else 1e30, None]
    values += [999.99, 999.994, 999.995, 999.999, 1000.0, 1000.0000000001, -999.995, -1000.5, 1e29, 9.99e28, 1e38, 1.5e-9]
    compare(spark, values, ddl, ["tinyint", "smallint", "int", "bigint", "decimal(5,2)", "decimal(38,9)", "string"])


def test_whole_numbers_cast_as_try_cast_does(spark):
    values = [s * 2**b + d for b in (7, 15, 31) for s in (1, -1) for d in (-1, 0, 1)] + [0, -(2**63), 2**63 - 1, None]
    compare(spark, values, "bigint", ["tinyint", "smallint", "int", "decimal(5,2)", "float", "boolean", "string"])
    compare(spark, [99, 100, 999, 1000, 1001, -999, -1000, *values], "bigint", ["decimal(5,2)", "decimal(3,0)", "decimal(38,20)"])
    compare(spark, [v for v in values if v is None or abs(v) < 2**31], "int", ["tinyint", "smallint", "bigint"])


def test_decimals_cast_as_try_cast_does(spark):
    texts = ["999.994", "999.995", "-999.995", "1000", "-1000", "1000.001", "0", "127.9", "128", "-129", "12345678901234567890"]
    values = [Decimal(t) for t in texts] + [None]
    compare(spark, values, "decimal(38,18)", ["decimal(5,2)", "decimal(38,9)", "decimal(10,0)", "tinyint", "double", "string"])
