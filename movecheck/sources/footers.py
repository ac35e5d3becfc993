"""Row counts, nulls and ends of columns from file footers, scanning only what they lack.

ORC and Parquet files end with statistics of each column. Spark's newer file
reader answers whole aggregates from them, if all of an aggregate can be: so what
footers know is asked apart from what they do not. They know the counts of all
but nested columns, whose parts have statistics of their own, and the ends of
whole numbers, booleans and dates. Ends of floats are left to a scan, as footers
pass over NaN; so are texts, which footers may cut short, decimals and
timestamps.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.names import column, resolve
from movecheck.functions.types import FLOAT_TYPES, INTEGRAL_TYPES
from movecheck.operators.profile import RANGED_TYPES
from movecheck.operators.tidy import in_groups, text

FOOTER_TYPES = (*INTEGRAL_TYPES, T.BooleanType, T.DateType)
NESTED_TYPES = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
FORMATS = ("orc", "parquet")
RESULT = ("column_name", "data_type", "n_rows", "n_nulls", "min_value", "max_value")


def _rows(df: DataFrame, names: Sequence[str], ranged: set[str]) -> DataFrame:
    """One row per column, with ends for the ranged ones, by one aggregate."""
    wanted = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(names):
        wanted.append(F.count(column(name)).alias(f"n{i}"))
        if name in ranged:
            value, dtype = column(name), df.schema[name].dataType
            if isinstance(dtype, FLOAT_TYPES):
                # -0.0 and 0.0 are equal, so either could come out: make it 0.0.
                value = value + F.lit(0.0).cast(dtype)
            wanted += [F.min(value).alias(f"low{i}"), F.max(value).alias(f"high{i}")]
    ends = lambda i, name, end: F.col(f"{end}{i}").cast("string") if name in ranged else text(None)
    rows = [
        F.struct(
            *[
                v.alias(c)
                for v, c in zip(
                    (text(name), text(df.schema[name].dataType.simpleString()), F.col("n_rows"), F.col("n_rows") - F.col(f"n{i}"),
                     ends(i, name, "low"), ends(i, name, "high")),
                    RESULT,
                )
            ]
        )
        for i, name in enumerate(names)
    ]
    return df.agg(*wanted).select(F.inline(F.array(*rows)))


def _of_footers(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The table through the reader that answers aggregates from footers.

    The settings belong to a session of their own, which shares all else.
    """
    session = spark.newSession()
    listed = spark.conf.get("spark.sql.sources.useV1SourceList").split(",")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(name for name in listed if name.strip() != fmt))
    session.conf.set(f"spark.sql.{fmt}.aggregatePushdown", "true")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session.read.format(fmt).load(path)


def pushed_aggregates(spark: SparkSession, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None) -> DataFrame:
    """What footers know of the columns: counts, and the ends of the types they keep whole.

    Nested columns are left out. No page of data is read. The frame belongs to a session whose reader does so;
    it fails when run if a file has no statistics.
    """
    if fmt not in FORMATS:
        raise ValueError(f"no footers in {fmt}; one of {', '.join(FORMATS)}")
    df = _of_footers(spark, path, fmt)
    names = resolve(df, columns) if columns is not None else df.columns
    names = [n for n in names if not isinstance(df.schema[n].dataType, NESTED_TYPES)]
    if not names:
        raise ValueError("no column that footers know")
    return _rows(df, names, {n for n in names if isinstance(df.schema[n].dataType, FOOTER_TYPES)})


def footer_profile(spark: SparkSession, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None) -> DataFrame:
    """column_name, data_type, n_rows, n_nulls, min_value, max_value, source, for every column.

    ``source`` says where the ends come from: ``footer``, or ``scan`` where
    footers cannot tell; nested columns have none. A table without statistics is
    scanned for everything. The footers are read when this is called, and give
    one row per column; the scan reads only the columns that need it.
    """
    plain = spark.read.format(fmt).load(path)
    names = resolve(plain, columns) if columns is not None else plain.columns
    flat = [n for n in names if not isinstance(plain.schema[n].dataType, NESTED_TYPES)]
    try:
        known = {r["column_name"]: tuple(r) for r in pushed_aggregates(spark, path, fmt, flat).collect()} if flat else {}
    except (PySparkException, Py4JJavaError):
        # Some file has no statistics.
        known = {}
    footer = [n for n in names if n in known and isinstance(plain.schema[n].dataType, FOOTER_TYPES)]
    scanned = [n for n in names if n not in footer and (n not in known or isinstance(plain.schema[n].dataType, RANGED_TYPES))]
    kinds = "column_name string, data_type string, n_rows bigint, n_nulls bigint, min_value string, max_value string"
    done = [known[n] for n in names if n in known and n not in scanned]
    parts = [spark.createDataFrame(done, kinds).withColumn("source", F.when(F.col("column_name").isin(footer), "footer"))]
    for group in in_groups(scanned):
        ranged = {n for n in group if isinstance(plain.schema[n].dataType, RANGED_TYPES)}
        source = F.when(F.col("column_name").isin(sorted(ranged)), "scan")
        parts.append(_rows(plain, group, ranged).withColumn("source", source))
    return reduce(DataFrame.unionAll, parts)
