"""Contract type texts and the common type of two columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names a contract may use.
SIMPLE_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "smallint": T.ShortType(),
    "tinyint": T.ByteType(),
}
DEFAULT_DECIMAL = T.DecimalType(38, 9)

DECIMAL_TEXT = re.compile(r"(?:numeric|decimal)(?:\s*\((?P<params>[^)]*)\))?")
ARRAY_TEXT = re.compile(r"array\s*<(?P<element>.*)>")

INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def contract_type(text: str | None, strict: bool = False) -> T.DataType:
    """The Spark type a contract text names.

    Unknown texts mean string and a decimal without usable parameters means
    ``decimal(38,9)``, unless ``strict`` asks for an error instead.
    """
    text = (text or "").strip().lower()
    if text in SIMPLE_TYPES:
        return SIMPLE_TYPES[text]
    array = ARRAY_TEXT.fullmatch(text)
    if array:
        return T.ArrayType(contract_type(array["element"], strict))
    decimal = DECIMAL_TEXT.fullmatch(text)
    if decimal:
        return _decimal_type(text, decimal["params"], strict)
    if strict:
        raise ValueError(f"unknown type: {text!r}")
    if text.startswith(("numeric", "decimal")):
        return DEFAULT_DECIMAL
    return T.StringType()


def _decimal_type(text: str, params: str | None, strict: bool) -> T.DecimalType:
    parts = [part.strip() for part in (params or "").split(",")]
    if len(parts) > 2 or not all(re.fullmatch(r"-?\d+", part) for part in parts):
        if strict and params is not None:
            raise ValueError(f"malformed decimal: {text!r}")
        return DEFAULT_DECIMAL
    precision, scale = int(parts[0]), int(parts[1]) if len(parts) == 2 else 0
    if not (1 <= precision <= 38 and 0 <= scale <= precision):
        raise ValueError(f"decimal out of Spark's range: {text!r}")
    return T.DecimalType(precision, scale)


def as_decimal(dtype: T.DataType) -> T.DecimalType:
    """The decimal type that holds every value of a whole number or decimal type."""
    if isinstance(dtype, T.DecimalType):
        return dtype
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    return T.DecimalType(digits[type(dtype)], 0)


class NumberText(T.StringType):
    """Numbers as plain decimal text, for pairs that no number type holds exactly."""

    def __init__(self, scale: int):
        super().__init__()
        self.scale = scale


def _holds_variant(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_variant(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _holds_variant(dtype.keyType) or _holds_variant(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_holds_variant(f.dataType) for f in dtype)
    return isinstance(dtype, T.VariantType)


def common_type(left: T.DataType, right: T.DataType, exact: bool = True) -> T.DataType:
    """The type both sides are compared in.

    Numbers widen, dates widen to timestamps, and anything against text is
    compared as text. Two decimals whose digits do not fit 38 places together,
    and floats against bigints or decimals, are compared as plain decimal text
    (see :func:`comparable`); without ``exact`` the latter become doubles.
    """
    if _holds_variant(left) or _holds_variant(right):
        raise TypeError("variants cannot be compared; cast them to a type of their own")
    if left.simpleString() == right.simpleString():
        return left
    pair = (left, right)
    if isinstance(left, T.NullType):
        return right
    if isinstance(right, T.NullType):
        return left
    if all(isinstance(t, (*INTEGRAL_TYPES, *FLOAT_TYPES, T.DecimalType)) for t in pair):
        if any(isinstance(t, FLOAT_TYPES) for t in pair):
            other = right if isinstance(left, FLOAT_TYPES) else left
            if exact and isinstance(other, (T.LongType, T.DecimalType)):
                return NumberText(as_decimal(other).scale)
            return T.DoubleType()
        if not any(isinstance(t, T.DecimalType) for t in pair):
            return max(pair, key=lambda t: INTEGRAL_TYPES.index(type(t)))
        a, b = map(as_decimal, pair)
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if all(isinstance(t, times) for t in pair):
        return max(pair, key=lambda t: times.index(type(t)))
    if all(isinstance(t, T.ArrayType) for t in pair):
        return T.ArrayType(common_type(left.elementType, right.elementType, exact))
    if all(isinstance(t, T.MapType) for t in pair):
        return T.MapType(
            common_type(left.keyType, right.keyType, exact),
            common_type(left.valueType, right.valueType, exact),
        )
    if all(isinstance(t, T.StructType) for t in pair) and left.names == right.names:
        return T.StructType(
            [
                T.StructField(a.name, common_type(a.dataType, b.dataType, exact))
                for a, b in zip(left, right)
            ]
        )
    if any(isinstance(t, T.StringType) for t in pair) and all(
        isinstance(t, T.AtomicType) for t in pair
    ):
        return T.StringType()
    raise TypeError(
        f"cannot compare {left.simpleString()} with {right.simpleString()}"
    )


def _plain(own: T.DataType, shared: T.DataType) -> bool:
    """Whether values of ``own`` can be grouped as ``shared`` without any change."""

    def has_map(dtype: T.DataType) -> bool:
        if isinstance(dtype, T.ArrayType):
            return has_map(dtype.elementType)
        if isinstance(dtype, T.StructType):
            return any(has_map(f.dataType) for f in dtype)
        return isinstance(dtype, T.MapType)

    return own.simpleString() == shared.simpleString() and not has_map(shared)


def _float_text(value: Column, own: T.DataType, scale: int) -> Column:
    """A float as the text that an equal bigint or decimal of the scale has.

    Whole floats below 2^63 are taken exactly, others by the shortest digits
    that name them among floats of their own width. A float that no such decimal
    equals keeps a text of its own.
    """
    number = value.cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) < F.lit(2.0**63))
    shortest = value.cast("string") if isinstance(own, T.FloatType) else number
    digits = F.when(F.abs(number) < F.lit(10.0 ** (38 - scale)), shortest.try_cast(T.DecimalType(38, scale)))
    same = digits.cast(own) == value
    return (
        F.when(F.coalesce(whole, F.lit(False)), number.try_cast("bigint").cast("string"))
        .when(F.coalesce(same, F.lit(False)), _decimal_text(digits, scale))
        .otherwise(number.cast("string"))
    )


def _decimal_text(value: Column, scale: int) -> Column:
    text = value.cast("string")
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit(".")) if scale > 0 else text


def comparable(value: Column, own: T.DataType, shared: T.DataType) -> Column:
    """``value`` in the shared type, in a form that ``groupBy`` accepts.

    Maps become sorted entries, so the order of their keys does not matter.
    """
    if _plain(own, shared):
        return value
    if isinstance(own, T.ArrayType):
        return F.transform(value, lambda x: comparable(x, own.elementType, shared.elementType))
    if isinstance(own, T.StructType):
        fields = [
            comparable(value.getField(a.name), a.dataType, b.dataType).alias(a.name)
            for a, b in zip(own, shared)
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(own, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                comparable(e.getField("key"), own.keyType, shared.keyType).alias("key"),
                comparable(e.getField("value"), own.valueType, shared.valueType).alias("value"),
            ),
        )
        return F.array_sort(entries)
    if isinstance(own, T.DecimalType) and isinstance(shared, T.StringType):
        return _decimal_text(value, own.scale)
    if isinstance(shared, NumberText):
        return _float_text(value, own, shared.scale) if isinstance(own, FLOAT_TYPES) else value.cast("string")
    return value.cast(shared)
