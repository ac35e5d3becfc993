"""Comparing two tables: as sets or bags of rows, and by key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.names import column, name_key, names_by_key, resolve
from movecheck.functions.types import FLOAT_TYPES, common_type, comparable
from movecheck.operators.tidy import in_groups

# On which side a row was found.
ONLY_LEFT = "only_left"
ONLY_RIGHT = "only_right"

SIDE, COPIES = "side", "n_copies"
# Copies of one row made by one task when a bag difference is written out.
COPIES_PER_TASK = 100_000


def shared_columns(left: DataFrame, right: DataFrame, cols: Sequence[str] | None) -> list[tuple[str, str]]:
    """Pairs of the two frames' spellings of the compared columns."""
    if cols is not None:
        pairs = list(zip(resolve(left, cols), resolve(right, cols)))
    else:
        key, rights = name_key(left.sparkSession), names_by_key(right)
        lefts = names_by_key(left)
        apart = [n for n in lefts if n not in rights] + [n for n in rights if n not in lefts]
        if apart:
            raise ValueError(f"columns on one side only: {', '.join(apart)}; name the ones to compare")
        pairs = [(name, rights[key(name)]) for name in left.columns]
    if not pairs:
        raise ValueError("no column to compare")
    return pairs


def _rounded(value: Column, dtype: T.DataType, scale: int) -> Column:
    if isinstance(dtype, FLOAT_TYPES):
        return F.round(value, scale)
    if not _holds_float(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _rounded(x, dtype.elementType, scale))
    if isinstance(dtype, T.MapType):
        # As :func:`comparable` leaves it: entries, sorted by key.
        return F.transform(
            value,
            lambda e: F.struct(
                e.getField("key").alias("key"),
                _rounded(e.getField("value"), dtype.valueType, scale).alias("value"),
            ),
        )
    fields = [_rounded(value.getField(f.name), f.dataType, scale).alias(f.name) for f in dtype]
    return F.when(value.isNotNull(), F.struct(*fields))


def _holds_float(dtype: T.DataType) -> bool:
    """Whether rounding reaches a float in it; keys of maps are left as they are."""
    if isinstance(dtype, T.ArrayType):
        return _holds_float(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _holds_float(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_holds_float(f.dataType) for f in dtype)
    return isinstance(dtype, FLOAT_TYPES)


def compared(
    sides: tuple[DataFrame, DataFrame], pairs: Sequence[tuple[str, str]], tolerance_scale: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both sides with just the compared columns, in their common types and the left spelling."""
    types = [tuple(df.schema[name].dataType for df, name in zip(sides, pair)) for pair in pairs]
    shared = [common_type(*pair, exact=tolerance_scale is None) for pair in types]
    out = []
    for spot, df in enumerate(sides):
        columns = []
        for pair, own, target in zip(pairs, types, shared):
            value = comparable(column(pair[spot]), own[spot], target)
            if tolerance_scale is not None:
                value = _rounded(value, target, tolerance_scale)
            columns.append(value.alias(pair[0]))
        out.append(df.select(*columns))
    return out[0], out[1]


def _grouped(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    tolerance_scale: int | None,
    multiset: bool,
) -> DataFrame:
    """Each distinct row with one number that tells on which side it is.

    Both sides are tagged and united, so one shuffle compares them, and copies
    of a row collapse in the map tasks before it. The number, ``__mark``, is
    the excess of left over right copies for bags, and for sets 1 (left), 2
    (right) or 3 (both).
    """
    tags = (F.lit(1), F.lit(-1)) if multiset else (F.lit(1), F.lit(2))
    sides = [
        df.select("*", tag.cast("bigint" if multiset else "tinyint").alias("__tag"))
        for df, tag in zip(compared((left, right), pairs, tolerance_scale), tags)
    ]
    mark = F.sum("__tag") if multiset else F.bit_or("__tag")
    names = [column(a) for a, _ in pairs]
    return sides[0].unionAll(sides[1]).groupBy(*names).agg(mark.alias("__mark"))


def _check_names(names: Iterable[str], *reserved: str) -> None:
    taken = {*reserved} & {name.lower() for name in names}
    if taken:
        raise ValueError(f"column name in use by the result: {', '.join(sorted(taken))}")


@dataclass(frozen=True)
class Reconciliation:
    """The rows two tables do not share.

    ``rows`` has the column ``side`` and the compared columns; for bags also
    ``n_copies``, how many more copies that side has.
    """

    rows: DataFrame
    columns: tuple[str, ...]
    multiset: bool

    def counts(self) -> DataFrame:
        """Two rows, one per side, with the number of rows found only there."""
        copies = F.col(COPIES) if self.multiset else F.lit(1).cast("bigint")
        totals = self.rows.agg(
            *[
                F.coalesce(F.sum(F.when(F.col(SIDE) == side, copies)), F.lit(0).cast("bigint")).alias(side)
                for side in (ONLY_LEFT, ONLY_RIGHT)
            ]
        )
        rows = [
            F.struct(F.lit(side).alias(SIDE), F.col(side).alias("n_rows"))
            for side in (ONLY_LEFT, ONLY_RIGHT)
        ]
        return totals.select(F.inline(F.array(*rows)))

    def sample(self, n: int = 5) -> DataFrame:
        """The first ``n`` rows of each side in column order, so runs agree."""
        order = [column(name) for name in self.columns]
        picks = [
            self.rows.filter(F.col(SIDE) == side).orderBy(*order).limit(n)
            for side in (ONLY_LEFT, ONLY_RIGHT)
        ]
        return picks[0].unionAll(picks[1])

    def report(self, n: int = 5) -> DataFrame:
        """Counts and samples as one frame; one job, which shuffles once."""
        _check_names(self.columns, "entry", "n_rows")
        counts = self.counts().select(F.lit("count").alias("entry"), SIDE, "n_rows")
        sample = self.sample(n).select(F.lit("sample").alias("entry"), "*")
        return counts.unionByName(sample, allowMissingColumns=True)

    def expanded(self) -> DataFrame:
        """The rows themselves, each as often as it is in excess.

        Large numbers of copies are cut into slices that are spread over the
        cluster before they are written out.
        """
        if not self.multiset:
            return self.rows
        names = [column(name) for name in self.columns]
        last = F.floor((F.col(COPIES) - 1) / COPIES_PER_TASK)
        slices = self.rows.withColumn("__slice", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        size = F.least(
            F.col(COPIES) - F.col("__slice") * COPIES_PER_TASK,
            F.lit(COPIES_PER_TASK).cast("bigint"),
        )
        return (
            slices.repartition(SIDE, *names, "__slice")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size)))
            .select(SIDE, *names)
        )

    def is_empty(self) -> bool:
        return self.rows.isEmpty()


def reconcile(
    left: DataFrame,
    right: DataFrame,
    cols: Sequence[str] | None = None,
    multiset: bool = False,
    tolerance_scale: int | None = None,
) -> Reconciliation:
    """Rows of either table that the other lacks.

    Columns pair up by name and are compared in their common type; nulls
    equal nulls and NaN equals NaN. As sets, a row is reported if the other
    side has no copy of it; as multisets, if the numbers of copies differ.
    ``tolerance_scale`` rounds floats to that many places first, nested ones
    too; only then does a float against a bigint or decimal count as a double.
    """
    pairs = shared_columns(left, right, cols)
    _check_names([a for a, _ in pairs], SIDE, COPIES)
    grouped = _grouped(left, right, pairs, tolerance_scale, multiset)
    mark = F.col("__mark")
    names = tuple(a for a, _ in pairs)
    if multiset:
        differing, on_left = grouped.filter(mark != 0), mark > 0
        extra = [F.abs(mark).alias(COPIES)]
    else:
        differing, on_left = grouped.filter(mark != 3), mark == 1
        extra = []
    side = F.when(on_left, ONLY_LEFT).otherwise(ONLY_RIGHT)
    rows = differing.select(side.alias(SIDE), *[column(n) for n in names], *extra)
    return Reconciliation(rows, names, multiset)


# What became of a key that is not equal on both sides.
CHANGED = "changed"
AMBIGUOUS = "ambiguous"
N_ROWS = ("n_left", "n_right")


@dataclass(frozen=True)
class KeyReconciliation:
    """Keys whose rows differ, with both versions of every compared column.

    ``rows`` has the keys, ``status``, the rows in excess on either side and, per compared column, ``left_<name>`` and ``right_<name>``.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...]

    def statuses(self) -> DataFrame:
        """Number of keys per status."""
        return self.rows.groupBy("status").agg(F.count(F.lit(1)).alias("n_keys"))

    def mismatches(self) -> DataFrame:
        """Per column, the changed keys in which it differs."""
        changed = self.rows.filter(F.col("status") == CHANGED)
        parts = []
        for group in in_groups(self.columns, 128):
            totals = changed.agg(
                F.count(F.lit(1)).alias("n_changed"),
                *[
                    F.count_if(
                        ~column(f"left_{name}").eqNullSafe(column(f"right_{name}"))
                    ).alias(f"c{i}")
                    for i, name in enumerate(group)
                ],
            )
            rows = [
                F.struct(
                    F.lit(name).alias("column_name"), "n_changed", F.col(f"c{i}").alias("n_mismatches")
                )
                for i, name in enumerate(group)
            ]
            parts.append(totals.select(F.inline(F.array(*rows))))
        return reduce(DataFrame.unionAll, parts)


def reconcile_by_key(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str] | None = None,
    tolerance_scale: int | None = None,
) -> KeyReconciliation:
    """Explain a difference: which keys are one-sided, which columns changed.

    Rows that are identical on both sides cancel first, copy by copy; what
    remains is matched by key, nulls included. A key left with one row per
    side is ``changed``; with rows on one side only it is ``only_left`` or
    ``only_right``; with more rows it is ``ambiguous``, because nothing tells
    which row became which. No join is made, so a key with many copies on both
    sides never multiplies.
    """
    if cols is not None:
        named = resolve(left, keys)
        cols = [*named, *[c for c in resolve(left, cols) if c not in named]]
    pairs = shared_columns(left, right, cols)
    key_names = resolve(left, keys)
    others = [a for a, _ in pairs if a not in key_names]
    made = [f"{side}_{name}".lower() for side in ("left", "right") for name in others]
    _check_names([a for a, _ in pairs], "status", *N_ROWS, *made)
    if not others:
        raise ValueError("no column to compare besides the keys")
    excess = F.col("__mark")
    # What remains after the first shuffle is as small as the difference is.
    residue = _grouped(left, right, pairs, tolerance_scale, multiset=True).filter(excess != 0)
    sides = (("left", excess > 0), ("right", excess < 0))
    by_key = residue.groupBy(*[column(k) for k in key_names]).agg(
        *[
            F.coalesce(F.sum(F.when(on_side, F.abs(excess))), F.lit(0).cast("bigint")).alias(name)
            for name, (_, on_side) in zip(N_ROWS, sides)
        ],
        *[
            F.max(F.when(on_side, column(name))).alias(f"{side}_{name}")
            for side, on_side in sides
            for name in others
        ],
    )
    l, r = map(F.col, N_ROWS)
    status = (
        F.when(r == 0, ONLY_LEFT).when(l == 0, ONLY_RIGHT)
        .when((l == 1) & (r == 1), CHANGED).otherwise(AMBIGUOUS)
    )
    shown = [
        F.when(F.col("status") != AMBIGUOUS, column(f"{side}_{name}")).alias(f"{side}_{name}")
        for name in others
        for side, _ in sides
    ]
    rows = by_key.withColumn("status", status).select(
        *[column(k) for k in key_names], "status", *N_ROWS, *shown
    )
    return KeyReconciliation(rows, tuple(key_names), tuple(others))
