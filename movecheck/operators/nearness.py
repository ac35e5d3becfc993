"""Comparing rows whose measured column may be off by an absolute distance.

Rounding both sides tells 1.0049 from 1.0051 at two places although they are
0.0002 apart. Here values fall into cells half a distance wide. Two values of
one cell are near enough, and in another cell the nearest value is its smallest
or its largest. So a cell needs to know no more than the ends of its neighbours:
no pair of rows is made, however many rows share a cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.names import column, resolve
from movecheck.functions.types import FLOAT_TYPES, INTEGRAL_TYPES
from movecheck.operators.reconcile import COPIES, ONLY_LEFT, ONLY_RIGHT, SIDE, compared, shared_columns

# Values in cells further apart than this are further apart than the distance.
REACH = 3
# Numbers of more half distances than this are compared for equality.
FINEST = 2.0**50


def _number(value: Column, width: float) -> Column:
    """Whether the value has a cell: not null, NaN, infinite or too large."""
    return F.coalesce(F.abs(value / F.lit(width)) < F.lit(FINEST), F.lit(False)) & ~F.isnan(value)


def reconcile_within(
    left: DataFrame,
    right: DataFrame,
    measured: str,
    distance: float,
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of either side without a row near them on the other.

    Two rows are near if all their columns are equal but ``measured``, and that
    differs, as a double, by ``distance`` at most. One row may be near several.
    Nulls, NaN and infinities are near their likes alone; a number of over 2^49
    distances is near its equals. ``cols`` names the compared columns, measured
    included or not; by default all. Returns side, the columns, and n_copies,
    how often the row is on that side.

    Shuffles rows once by all columns (copies collapse before), and cells once
    by their columns; rows meet their cell by one join on a unique key.
    """
    if not distance > 0:
        raise ValueError("distance must be above 0; use reconcile for equality")
    (measured,) = resolve(left, [measured])
    if cols is not None:
        cols = [*cols, *([measured] if measured not in resolve(left, cols) else [])]
    pairs = shared_columns(left, right, cols)
    partner = dict(pairs)[measured]
    kinds = (*FLOAT_TYPES, *INTEGRAL_TYPES, T.DecimalType)
    for df, name in ((left, measured), (right, partner)):
        if not isinstance(df.schema[name].dataType, kinds):
            raise TypeError(f"not a number: {name}")
    # The measured column is compared as a double on both sides.
    left = left.withColumn(measured, column(measured).cast("double"))
    right = right.withColumn(partner, column(partner).cast("double"))
    names = [a for a, _ in pairs]
    exact = [n for n in names if n != measured]
    width = distance / 2

    sides = []
    for df, on_left in zip(compared((left, right), pairs, None), (True, False)):
        counts = (F.lit(int(on_left)).cast("bigint").alias("__l"), F.lit(int(not on_left)).cast("bigint").alias("__r"))
        sides.append(df.select("*", *counts))
    value = column(measured)
    rows = (
        sides[0].unionAll(sides[1]).groupBy(*[column(n) for n in names])
        .agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))
        # Text of what has no cell; equal numbers of either sign of zero agree.
        .withColumn("__odd", F.when(~_number(value, width), F.coalesce(value.cast("string"), F.lit("null"))))
        .withColumn("__cell", F.when(F.col("__odd").isNull(), F.floor(value / F.lit(width))).otherwise(F.lit(0)).cast("bigint"))
    )
    place = [*[column(n) for n in exact], F.col("__odd"), F.col("__cell")]
    ends = rows.groupBy(*place).agg(
        *[f(F.when(F.col(c) > 0, value)).alias(f"{c}_{f.__name__}") for c in ("__l", "__r") for f in (F.min, F.max)],
        *[(F.max(c) > 0).alias(f"{c}_in") for c in ("__l", "__r")],
    )
    # Each cell tells its neighbours its ends; odd values have none.
    offsets = F.when(F.col("__odd").isNull(), F.sequence(F.lit(-REACH), F.lit(REACH))).otherwise(F.array(F.lit(0)))
    told = ends.withColumn("__by", F.explode(offsets)).withColumn("__cell", F.col("__cell") + F.col("__by"))
    by = F.col("__by")
    # Seen from the cell told: by > 0 comes from below, so its largest counts.
    heard = told.groupBy(*place).agg(
        *[F.max(F.when(by > 0, F.col(f"{c}_max"))).alias(f"{c}_below") for c in ("__l", "__r")],
        *[F.min(F.when(by < 0, F.col(f"{c}_min"))).alias(f"{c}_above") for c in ("__l", "__r")],
        *[F.bool_or((by == 0) & F.col(f"{c}_in")).alias(f"{c}_here") for c in ("__l", "__r")],
    )
    own, other = rows.alias("own"), heard.alias("heard")
    keys = [*exact, "__odd", "__cell"]
    same = [column(f"{n}").eqNullSafe(column(f"__k{i}")) for i, n in enumerate(keys)]
    other = heard.select(*[column(n).alias(f"__k{i}") for i, n in enumerate(keys)], *[c for c in heard.columns if c not in keys])
    met = own.join(other, reduce(Column.__and__, same))

    def alone(side: str, opposite: str) -> Column:
        near = (
            F.col(f"{opposite}_here")
            | F.coalesce(value - F.col(f"{opposite}_below") <= F.lit(distance), F.lit(False))
            | F.coalesce(F.col(f"{opposite}_above") - value <= F.lit(distance), F.lit(False))
        )
        return (F.col(side) > 0) & ~near

    found = F.array(
        F.when(alone("__l", "__r"), F.struct(F.lit(ONLY_LEFT).alias(SIDE), F.col("__l").alias(COPIES))),
        F.when(alone("__r", "__l"), F.struct(F.lit(ONLY_RIGHT).alias(SIDE), F.col("__r").alias(COPIES))),
    )
    entries = met.withColumn("__found", F.explode(F.array_compact(found)))
    return entries.select(F.col(f"__found.{SIDE}"), *[column(n) for n in names], F.col(f"__found.{COPIES}"))
