"""Column profiles: sizes, digits, range and distinct values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.digits import (
    integer_digits,
    plain_digits,
    plain_text,
    signed_text_sizes,
    text_measures,
    text_parts,
    without_end_zeros,
)
from movecheck.functions.names import column, resolve
from movecheck.functions.types import FLOAT_TYPES, INTEGRAL_TYPES
from movecheck.operators.tidy import (
    COLUMNS_PER_PASS,
    MEASURED_COLUMNS_PER_PASS,
    in_groups,
    text,
)

PROFILE_COLUMNS = (
    "column_name", "data_type", "n_rows", "n_nulls", "min_value", "max_value",
    "n_distinct", "max_length", "max_precision", "max_integer_digits",
    "max_scale", "n_unmeasured",
)
NUMERIC_TYPES = (*INTEGRAL_TYPES, *FLOAT_TYPES, T.DecimalType)
RANGED_TYPES = (
    *NUMERIC_TYPES, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


# Columns per aggregate, by kind of column.
PASS_SIZES = {
    "plain": COLUMNS_PER_PASS, "text": COLUMNS_PER_PASS, "measured": MEASURED_COLUMNS_PER_PASS,
}


def _has_type(dtype: T.DataType, part: type) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_type(dtype.elementType, part)
    if isinstance(dtype, T.StructType):
        return any(_has_type(f.dataType, part) for f in dtype)
    return isinstance(dtype, part)


def _layer(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select("*", *[value.alias(name) for name, value in columns.items()])


class _ColumnProfile:
    """The aggregates one column needs and the result row they make.

    Only floats are measured value by value. The digits of whole numbers grow
    with their size and a decimal's scale is fixed by its type, so for those
    the smallest and largest value say it all.
    """

    def __init__(self, name: str, dtype: T.DataType, alias: str, strip_zeros: bool):
        self.name, self.dtype, self.alias, self.strip_zeros = name, dtype, alias, strip_zeros
        self.numeric = isinstance(dtype, NUMERIC_TYPES)
        self.textual = isinstance(dtype, T.StringType)
        self.by_value = isinstance(dtype, FLOAT_TYPES) or (
            strip_zeros and isinstance(dtype, T.DecimalType) and dtype.scale > 0
        )
        self.ranged = isinstance(dtype, RANGED_TYPES)

    def kind(self) -> str:
        """Columns of one kind share an aggregate that the JVM compiles well."""
        return "measured" if self.by_value else "text" if self.textual else "plain"

    def out(self, what: str) -> str:
        return f"{self.alias}_{what}"

    def texts(self) -> dict[str, Column]:
        if not self.by_value:
            return {}
        found = plain_text(F.col(self.alias), self.dtype)
        return {self.out("text"): without_end_zeros(found) if self.strip_zeros else found}

    def sizes(self) -> dict[str, Column]:
        if not self.by_value:
            return {}
        found = F.col(self.out("text"))
        return {self.out("size"): F.length(found), self.out("point"): F.instr(found, ".")}

    def aggregates(self) -> list[Column]:
        value = F.col(self.alias)
        wanted = {"n": F.count(value)}
        if self.ranged:
            wanted |= {"min": F.min(value), "max": F.max(value)}
        if self.textual:
            wanted["length"] = F.max(F.length(value))
        if self.by_value:
            size = F.col(self.out("size"))
            digits = plain_digits(size, F.col(self.out("point")))
            wanted |= {what: F.max(count) for what, count in digits.items()}
            wanted["measured"] = F.count(size)
        return [agg.alias(self.out(what)) for what, agg in wanted.items()]

    def digits(self) -> dict[str, Column]:
        n, out = F.col(self.out("n")), self.out
        if self.by_value:
            found = {what: F.col(out(what)) for what in ("precision", "integer_digits", "scale")}
            return found | {"unmeasured": n - F.col(out("measured"))}
        if not self.numeric:
            return {}
        fixed = self.dtype.scale if isinstance(self.dtype, T.DecimalType) else 0
        integer = F.greatest(integer_digits(F.col(out("min"))), integer_digits(F.col(out("max"))))
        scale = F.when(n > 0, F.lit(fixed))
        return {
            "precision": integer + scale,
            "integer_digits": integer,
            "scale": scale,
            "unmeasured": F.lit(0).cast("bigint"),
        }

    def row(self) -> Column:
        n, digits = F.col(self.out("n")), self.digits()

        def end(which: str) -> Column:
            return F.col(self.out(which)).cast("string") if self.ranged else text(None)

        no_count, no_size = F.lit(None).cast("bigint"), F.lit(None).cast("int")
        values = (
            text(self.name),
            text(self.dtype.simpleString()),
            F.col("n_rows"),
            F.col("n_rows") - n,
            end("min"),
            end("max"),
            no_count,
            F.col(self.out("length")) if self.textual else no_size,
            digits.get("precision", no_size),
            digits.get("integer_digits", no_size),
            digits.get("scale", no_size),
            digits.get("unmeasured", no_count),
        )
        return F.struct(*[v.alias(name) for v, name in zip(values, PROFILE_COLUMNS)])


def _profile_pass(df: DataFrame, group: Sequence[_ColumnProfile], by: Sequence[Column] = ()) -> DataFrame:
    """One row per column of the group, and per value of the named expressions in ``by``."""
    inputs = df.select(*by, *[column(p.name).alias(p.alias) for p in group])
    keys = inputs.columns[: len(by)]
    # Texts and sizes get layers of their own: each is used several times.
    inputs = _layer(inputs, {k: v for p in group for k, v in p.texts().items()})
    inputs = _layer(inputs, {k: v for p in group for k, v in p.sizes().items()})
    totals = inputs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), *[a for p in group for a in p.aggregates()]
    )
    return totals.select(*keys, F.inline(F.array(*[p.row() for p in group])))


def _passes(df: DataFrame, names: Sequence[str], strip_zeros: bool = False, by: Sequence[Column] = ()) -> DataFrame:
    """All columns' rows, one aggregate per kind of column."""
    profiles = [_ColumnProfile(name, df.schema[name].dataType, f"c{i}", strip_zeros) for i, name in enumerate(names)]
    passes = []
    for kind, size in PASS_SIZES.items():
        alike = [p for p in profiles if p.kind() == kind]
        passes += [_profile_pass(df, group, by) for group in in_groups(alike, size)]
    return reduce(DataFrame.unionAll, passes)


def countable(dtype: T.DataType) -> bool:
    """Whether values of the type can be told apart, and so counted or hashed."""
    return not (_has_type(dtype, T.MapType) or _has_type(dtype, T.VariantType))


def _estimated_distinct(df: DataFrame, names: Sequence[str], error: float) -> DataFrame:
    """Estimated distinct values per column, without a shuffle of values."""
    parts = []
    for group in in_groups(names):
        totals = df.agg(
            *[F.approx_count_distinct(column(n), error).alias(f"c{i}") for i, n in enumerate(group)]
        )
        rows = [
            F.struct(text(n).alias("column_name"), F.col(f"c{i}").alias("found"))
            for i, n in enumerate(group)
        ]
        parts.append(totals.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionAll, parts)


def _exact_distinct(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exact distinct values per column, one narrow branch each.

    Several exact counts in one aggregate would copy every input row once per
    column. A branch reads only its own column and sends each map task's
    distinct values to the shuffle.
    """
    branches = [
        df.select(column(name).alias("value"))
        .agg(F.count_distinct("value").alias("found"))
        .select(text(name).alias("column_name"), "found")
        for name in names
    ]
    return reduce(DataFrame.unionAll, branches)


def profile_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exact_distinct: bool = False,
    strip_zeros: bool = False,
    count_distinct: bool = True,
    distinct_error: float = 0.05,
) -> DataFrame:
    """One row per column: type, nulls, range, distinct values, length, digits.

    Digits follow the plain rule (:mod:`movecheck.functions.digits`); values
    without a plain text are counted in ``n_unmeasured``. ``max_length`` is
    for text columns. Distinct values are estimated with the relative standard
    deviation ``distinct_error``, counted exactly on request, or left out with ``count_distinct=False``. ``strip_zeros``
    ignores zeros at the end of a fraction.

    All columns of a kind (floats, text, others) are measured by one aggregate
    over just these columns. A frame whose source is not columnar, or costly
    to compute, should be written out before it is profiled.
    """
    names = resolve(df, columns) if columns is not None else df.columns
    if not names:
        raise ValueError("no column to profile")
    result = _passes(df, names, strip_zeros)
    counted = [name for name in names if countable(df.schema[name].dataType)]
    if not (count_distinct and counted):
        return result
    if exact_distinct:
        counts = _exact_distinct(df, counted)
    else:
        counts = _estimated_distinct(df, counted, distinct_error)
    return result.join(counts, "column_name", "left").select(
        *[F.col("found").alias(c) if c == "n_distinct" else F.col(c) for c in PROFILE_COLUMNS]
    )


def numeric_profile(df: DataFrame, name: str) -> DataFrame:
    """One row about one numeric column's values that are not null.

    Digits, range, row count and exact distinct count, all in one pass. Rows
    whose value has no plain text are in every measure but the digits, and
    counted in ``n_unmeasured``.
    """
    (name,) = resolve(df, [name])
    dtype = df.schema[name].dataType
    if not isinstance(dtype, NUMERIC_TYPES):
        raise TypeError(f"{name} is not numeric")
    value = F.col("value")
    if isinstance(dtype, FLOAT_TYPES):
        measured = plain_text(value, dtype)
    else:
        measured = F.ltrim(value.cast("string"), F.lit("-"))
    digits = plain_digits(F.col("size"), F.col("point"))
    # One row per value with its frequency, so that digits are counted once per
    # value and the distinct count is a plain count.
    values = (
        df.filter(column(name).isNotNull())
        .groupBy(column(name).alias("value"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("text", measured)
    )
    sized = _layer(values, {"size": F.length("text"), "point": F.instr("text", ".")})
    return sized.agg(
        F.max(digits["precision"]).alias("max_precision"),
        F.max(digits["scale"]).alias("max_scale"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.coalesce(F.sum("copies"), F.lit(0).cast("bigint")).alias("total_rows"),
        F.count("value").alias("distinct_values"),
        F.coalesce(
            F.sum(F.when(F.col("text").isNull(), F.col("copies"))), F.lit(0).cast("bigint")
        ).alias("n_unmeasured"),
    )


class _TextDigits:
    """The older analyser's sizes of one column."""

    def __init__(self, name: str, dtype: T.DataType, alias: str):
        self.name, self.dtype, self.alias = name, dtype, alias
        self.numeric, self.textual = isinstance(dtype, NUMERIC_TYPES), isinstance(dtype, T.StringType)
        fixed = dtype.scale if isinstance(dtype, T.DecimalType) else 0
        # Up to six places a decimal's text is as long as its ends are.
        self.by_value = isinstance(dtype, FLOAT_TYPES) or fixed > 6
        self.fixed = fixed

    def kind(self) -> str:
        return "measured" if self.by_value else "text" if self.textual else "plain"

    def out(self, what: str) -> str:
        return f"{self.alias}_{what}"

    def parts(self) -> dict[str, Column]:
        if not self.by_value:
            return {}
        return {self.out(k): v for k, v in text_parts(F.col(self.alias), self.dtype).items()}

    def measures(self) -> dict[str, Column]:
        if not self.by_value:
            return {}
        found = text_measures(F.col(self.out("text")), F.col(self.out("sign")), self.dtype)
        return {self.out(f"m_{k}"): v for k, v in found.items()}

    def aggregates(self) -> list[Column]:
        value, wanted = F.col(self.alias), {}
        if self.by_value:
            names = text_measures(value, value, self.dtype)
            found = {k: F.col(self.out(f"m_{k}")) for k in names}
            before, after = signed_text_sizes(found, self.dtype)
            wanted = {"before": F.max(before), "after": F.max(after)}
        elif self.numeric:
            wanted = {"min": F.min(value), "max": F.max(value)}
        elif self.textual:
            wanted = {"length": F.max(F.length(value))}
        return [agg.alias(self.out(what)) for what, agg in wanted.items()]

    def row(self) -> Column:
        before = after = length = F.lit(None).cast("int")
        if self.by_value:
            before, after = F.col(self.out("before")), F.col(self.out("after"))
        elif self.numeric:
            ends = [F.col(self.out(end)) for end in ("min", "max")]
            before = F.greatest(*[integer_digits(end) for end in ends])
            if self.fixed:
                after = F.when(ends[0].isNotNull(), F.lit(self.fixed))
            else:
                after = F.greatest(*[F.length(end.cast("string")) for end in ends])
        elif self.textual:
            length = F.col(self.out("length"))
        return F.struct(
            text(self.name).alias("column_name"),
            text(self.dtype.simpleString()).alias("data_type"),
            before.alias("max_precision"),
            after.alias("max_scale"),
            length.alias("max_length"),
        )


def text_digit_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column with the older analyser's sizes, by the signed text rule.

    Numbers get ``max_precision`` (characters before the point) and
    ``max_scale`` (characters after it), text gets ``max_length``, other types
    get nulls. Use it to reproduce earlier reports; :func:`profile_columns`
    measures what a decimal type needs.
    """
    names = resolve(df, columns) if columns is not None else df.columns
    if not names:
        raise ValueError("no column to profile")
    wanted = [_TextDigits(n, df.schema[n].dataType, f"c{i}") for i, n in enumerate(names)]
    passes = []
    for kind, size in PASS_SIZES.items():
        for group in in_groups([w for w in wanted if w.kind() == kind], size):
            inputs = df.select(*[column(w.name).alias(w.alias) for w in group])
            inputs = _layer(inputs, {k: v for w in group for k, v in w.parts().items()})
            inputs = _layer(inputs, {k: v for w in group for k, v in w.measures().items()})
            totals = inputs.agg(
                F.count(F.lit(1)).alias("n"), *[a for w in group for a in w.aggregates()]
            )
            passes.append(totals.select(F.inline(F.array(*[w.row() for w in group]))))
    return reduce(DataFrame.unionAll, passes)
