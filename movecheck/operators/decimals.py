"""Fitting numbers to the target's decimal types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from movecheck.functions.casts import safe_cast
from movecheck.functions.names import column, resolve
from movecheck.operators.conform import cast_loss


def _decimal_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    if columns is not None:
        return resolve(df, columns)
    return [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]


def fit_decimals(
    df: DataFrame,
    precision: int | None = None,
    scale: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Recast decimal columns, rounding half up, null on overflow.

    Without a precision every decimal keeps its own type, so nothing changes.
    By default all decimal columns are recast; ``columns`` picks others.
    """
    if precision is None:
        if scale is not None:
            raise ValueError("a scale needs a precision")
        return df
    wanted = T.DecimalType(precision, scale or 0)
    names = set(_decimal_columns(df, columns))
    return df.select(
        *[
            safe_cast(column(f.name), f.dataType, wanted).alias(f.name)
            if f.name in names
            else column(f.name)
            for f in df.schema
        ]
    )


def decimal_overflow(
    df: DataFrame, precision: int, scale: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """Per decimal column, the values that do not fit ``(precision, scale)``."""
    wanted = T.DecimalType(precision, scale)
    names = _decimal_columns(df, columns)
    return cast_loss(df, T.StructType([T.StructField(name, wanted) for name in names]))


def _element_type(own: T.DataType, wanted: T.DataType) -> T.DataType:
    if isinstance(own, T.ArrayType):
        return T.ArrayType(_element_type(own.elementType, wanted))
    return wanted


def cast_elements(
    df: DataFrame, name: str, wanted: T.DataType, into: str | None = None
) -> DataFrame:
    """Cast the elements of an array column, nested arrays included.

    Null arrays stay null, empty ones empty; an element that does not fit
    becomes null. The result replaces the column, or is added as ``into``.
    """
    (name,) = resolve(df, [name])
    own = df.schema[name].dataType
    if not isinstance(own, T.ArrayType):
        raise TypeError(f"{name} is no array")
    return df.withColumn(into or name, safe_cast(column(name), own, _element_type(own, wanted)))
