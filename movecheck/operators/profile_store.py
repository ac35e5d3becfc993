"""Profiles kept as states per partition, merged instead of measured again.

A state is one row per partition and column: counts, ends and digit sizes as
:func:`profile_columns` finds them, a distinct-count sketch and, for numbers, a
quantile sketch. All of these merge: a profile of any set of partitions, or of
the whole table, comes from their states alone, and a new or changed partition
costs a scan of that partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from movecheck.functions.names import column, resolve
from movecheck.operators.profile import NUMERIC_TYPES, PROFILE_COLUMNS, RANGED_TYPES, _passes, countable
from movecheck.operators.tidy import in_groups, text

#: Binary logarithm of a distinct sketch's slots, and its relative standard deviation.
DISTINCT_SLOTS = 14
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_SLOTS / 2)
#: Size of a quantile sketch; ranks are off by less than this at 99 % confidence.
QUANTILE_SIZE = 400
RANK_ERROR = 0.01
# Sketches per aggregate.
SKETCHED_COLUMNS = 8

PART = "part"
SKETCHES = ("distinct_sketch", "quantile_sketch")
MEASURES = tuple(c for c in PROFILE_COLUMNS if c not in ("column_name", "data_type", "n_distinct"))
STATE_SCHEMA = (
    "column_name string, data_type string, n_rows bigint, n_nulls bigint, min_value string, max_value string, "
    "max_length int, max_precision int, max_integer_digits int, max_scale int, n_unmeasured bigint, "
    "distinct_sketch binary, quantile_sketch binary, part string"
)


def _sketches(df: DataFrame, names: Sequence[str], part: Column) -> DataFrame:
    """part, column_name and the two sketches."""
    out = []
    for group in in_groups(names, SKETCHED_COLUMNS):
        wanted, rows = [], []
        for i, name in enumerate(group):
            dtype, value = df.schema[name].dataType, column(name)
            found = [F.lit(None).cast("binary")] * 2
            if countable(dtype):
                hashed = F.when(value.isNotNull(), F.xxhash64(value))
                wanted.append(F.hll_sketch_agg(hashed, F.lit(DISTINCT_SLOTS)).alias(f"d{i}"))
                found[0] = F.col(f"d{i}")
            if isinstance(dtype, NUMERIC_TYPES):
                number = value.cast("double")
                wanted += [F.kll_sketch_agg_double(number, F.lit(QUANTILE_SIZE)).alias(f"q{i}"), F.count(F.nanvl(number, F.lit(None))).alias(f"n{i}")]
                found[1] = F.when(F.col(f"n{i}") > 0, F.col(f"q{i}"))
            rows.append(F.struct(text(name).alias("column_name"), *[f.alias(s) for f, s in zip(found, SKETCHES)]))
        if wanted:
            out.append(df.groupBy(part.alias(PART)).agg(*wanted).select(PART, F.inline(F.array(*rows))))
    return reduce(DataFrame.unionAll, out) if out else df.sparkSession.createDataFrame([], f"{PART} string, column_name string, distinct_sketch binary, quantile_sketch binary")


def profile_states(df: DataFrame, by: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per value of ``by`` and column: what a profile of those rows needs.

    ``by`` names a column of few values, as partitions have; it is kept as text,
    null included, and profiled only if it is among ``columns``.
    """
    (by,) = resolve(df, [by])
    names = resolve(df, columns) if columns is not None else [c for c in df.columns if c != by]
    if not names:
        raise ValueError("no column to profile")
    part = column(by).cast("string").alias(PART)
    sizes = _passes(df, names, by=[part]).drop("n_distinct")
    # One row per state on each side; a null partition is a partition.
    united = sizes.unionByName(_sketches(df, names, column(by).cast("string")), allowMissingColumns=True)
    rest = ["data_type", *MEASURES, *SKETCHES]
    return united.groupBy(PART, "column_name").agg(*[F.max(c).alias(c) for c in rest]).select("column_name", *rest, PART)


def refresh_profile_store(
    df: DataFrame, path: str, by: str, parts: Sequence | None = None, columns: Sequence[str] | None = None
) -> None:
    """Write the states of the given partitions, or of all, in place of their former ones.

    Other partitions' states stay. With ``parts`` the filter is on the column
    itself, so partitioned tables are pruned to those folders. A given partition
    without rows leaves states of nothing, so that no former state survives.
    """
    (by,) = resolve(df, [by])
    rows = df if parts is None else df.filter(column(by).isin(list(parts)))
    states = profile_states(rows, by, columns)
    if parts is not None:
        names = resolve(df, columns) if columns is not None else [c for c in df.columns if c != by]
        kinds = [(str(p), n, df.schema[n].dataType.simpleString()) for p in parts for n in names]
        given = df.sparkSession.createDataFrame(kinds, "part string, column_name string, data_type string")
        none = given.join(states.select(PART, "column_name"), [PART, "column_name"], "left_anti")
        zero = F.lit(0).cast("bigint")
        states = states.unionByName(none.withColumns({"n_rows": zero, "n_nulls": zero}), allowMissingColumns=True)
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def read_profile_store(spark: SparkSession, path: str) -> DataFrame:
    """The states of all partitions; filter on ``part`` to profile some of them."""
    return spark.read.schema(STATE_SCHEMA).parquet(path)


def merged_profile(states: DataFrame) -> DataFrame:
    """The columns of :func:`profile_columns`, for all partitions that states are of.

    Everything but ``n_distinct`` is exact; that is estimated with a relative
    standard deviation of ``DISTINCT_ERROR``. A column whose type changed between
    partitions has a row per type.
    """
    names = {t().simpleString() if not t.__name__.startswith("Decimal") else "decimal" for t in RANGED_TYPES}
    # As many as there are types.
    types = [r[0] for r in states.select("data_type").distinct().collect() if r[0].split("(")[0] in names]

    def end(which: str, pick) -> Column:
        found = [pick(F.when(F.col("data_type") == t, F.col(which).try_cast(t))).cast("string") for t in types]
        return F.coalesce(*found, F.lit(None).cast("string")).alias(which)

    distinct, known = F.hll_union_agg("distinct_sketch"), F.count("distinct_sketch")
    n_rows = F.sum("n_rows")
    wanted = {
        "n_rows": n_rows, "n_nulls": F.sum("n_nulls"), "min_value": end("min_value", F.min), "max_value": end("max_value", F.max),
        "n_distinct": F.when(known > 0, F.hll_sketch_estimate(distinct)),
        **{c: F.max(c) for c in ("max_length", "max_precision", "max_integer_digits", "max_scale")},
        "n_unmeasured": F.sum("n_unmeasured"),
    }
    return states.groupBy("column_name", "data_type").agg(*[v.alias(c) for c, v in wanted.items()]).select(*PROFILE_COLUMNS)


def merged_quantiles(states: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """column_name, probability, value: estimated quantiles of the numeric columns.

    A value's rank is within ``RANK_ERROR`` of the probability. Columns without a
    number have no rows; NaN is no number.
    """
    merged = states.filter("quantile_sketch is not null").groupBy("column_name").agg(
        F.kll_merge_agg_double("quantile_sketch", F.lit(QUANTILE_SIZE)).alias("sketch")
    )
    rows = [
        F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
        for p in probabilities
    ]
    return merged.select("column_name", F.inline(F.array(*rows)))
