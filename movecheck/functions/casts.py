"""Casts that give null instead of failing."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.types import FLOAT_TYPES, INTEGRAL_TYPES, as_decimal

# Texts outside these patterns cannot be cast to the type. A failed cast costs
# the JVM an exception, some hundred times a pattern match, and a column of the
# wrong kind fails in every row. The patterns only rule out; the cast decides.
_PAD = r"[\x00-\x20\x7f]*"
_WHOLE = rf"^{_PAD}[+-]?[0-9]+{_PAD}$"
_DECIMAL = rf"^{_PAD}[+-]?\.?\p{{Nd}}[\p{{Nd}}.eE+-]*{_PAD}$"
_FLOAT = rf"(?i)^{_PAD}[+-]?(\.?[0-9][0-9.e+-]*[df]?|0x.*|nan|inf|infinity){_PAD}$"
_BOOLEAN = rf"(?i)^{_PAD}(t|true|y|yes|1|f|false|n|no|0){_PAD}$"
_DATE = rf"^{_PAD}[+-]?[0-9]{{4}}"
_TIME = rf"^{_PAD}[+-]?T?[0-9]"
PLAUSIBLE_TEXTS = (
    (INTEGRAL_TYPES, _WHOLE),
    ((T.DecimalType,), _DECIMAL),
    (FLOAT_TYPES, _FLOAT),
    ((T.BooleanType,), _BOOLEAN),
    ((T.DateType,), _DATE),
    ((T.TimestampType, T.TimestampNTZType), _TIME),
)
WHOLE_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _plausible(value: Column, own: T.DataType, wanted: T.DataType) -> Column | None:
    """A cheap condition without which the cast would fail, if there is one."""
    if isinstance(own, T.StringType):
        for types, pattern in PLAUSIBLE_TEXTS:
            if isinstance(wanted, types):
                return value.rlike(pattern)
    bits = WHOLE_BITS.get(type(wanted))
    if bits and isinstance(own, (*INTEGRAL_TYPES, *FLOAT_TYPES)):
        if bits < WHOLE_BITS.get(type(own), 128):
            # One beyond the range on either side, as fractions are cut off.
            limit = 2 ** (bits - 1)
            kind = float if isinstance(own, FLOAT_TYPES) else int
            return value.between(F.lit(kind(-limit - 1)), F.lit(kind(limit)))
    if isinstance(wanted, T.DecimalType):
        room = wanted.precision - wanted.scale
        if isinstance(own, FLOAT_TYPES):
            # A little beyond the range, as powers of ten are not exact here.
            limit = F.lit(10.0**room * (1 + 1e-9))
            return value.between(-limit, limit)
        needed = as_decimal(own) if isinstance(own, (*INTEGRAL_TYPES, T.DecimalType)) else None
        if needed and needed.precision - needed.scale > room:
            return value.between(F.lit(Decimal(-(10**room))), F.lit(Decimal(10**room)))
    return None


def try_cast(value: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """``try_cast`` that is cheap for values that cannot be cast."""
    plausible = _plausible(value, own, wanted)
    cast = value.try_cast(wanted)
    return cast if plausible is None else F.when(plausible, cast)


def safe_cast(value: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """:func:`try_cast` that works element by element inside arrays.

    Equal types give the column itself, so that filters on it still reach the
    scan.
    """
    if own.simpleString() == wanted.simpleString():
        return value
    if isinstance(own, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: safe_cast(x, own.elementType, wanted.elementType))
    return try_cast(value, own, wanted)


def lost(value: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """True where a value, or an element of it, does not survive the cast."""
    if own.simpleString() == wanted.simpleString():
        return F.lit(False)
    if isinstance(own, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.coalesce(
            F.exists(value, lambda x: lost(x, own.elementType, wanted.elementType)),
            F.lit(False),
        )
    return value.isNotNull() & try_cast(value, own, wanted).isNull()


def _any_pair(value: Column, final: Column, test) -> Column:
    """True where the test holds for some element of an array and of its cast."""
    pairs = F.zip_with(value, final, test)
    return F.coalesce(F.exists(pairs, lambda x: x), F.lit(False))


def is_lost(value: Column, own: T.DataType, final: Column, wanted: T.DataType) -> Column:
    """True where ``final``, made from ``value`` by casts, is null for a value.

    :func:`lost` for more than one cast in a row.
    """
    if own.simpleString() == wanted.simpleString() and isinstance(own, T.ArrayType):
        return F.lit(False)
    if isinstance(own, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return _any_pair(
            value, final, lambda a, b: is_lost(a, own.elementType, b, wanted.elementType)
        )
    return value.isNotNull() & final.isNull()


def altered(value: Column, own: T.DataType, final: Column, wanted: T.DataType) -> Column:
    """True where ``final`` is another value than ``value``: it does not come back.

    Numbers and times are cast back to their own type and compared there, so
    for floats a decimal counts as the same if it gives the float again. A text
    is compared by what it says: as number with a number (``1.50`` is 1.5), as
    timestamp with a date or timestamp; other kinds made from text, and text
    made from others, count as the same. Null results are lost, not altered.
    """
    if own.simpleString() == wanted.simpleString() and not isinstance(own, T.DecimalType):
        return F.lit(False)
    if isinstance(own, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return _any_pair(
            value, final, lambda a, b: altered(a, own.elementType, b, wanted.elementType)
        )
    if isinstance(own, T.StringType):
        if isinstance(wanted, FLOAT_TYPES):
            back, origin = final.cast("double"), try_cast(value, own, T.DoubleType())
            if isinstance(wanted, T.FloatType):
                origin = origin.cast("float").cast("double")
        elif isinstance(wanted, (*INTEGRAL_TYPES, T.DecimalType)):
            # Digits beyond the target's scale are what a cast rounds away.
            scale = min(getattr(wanted, "scale", 0) + 9, 38 - as_decimal(wanted).precision + getattr(wanted, "scale", 0))
            wide = T.DecimalType(38, scale)
            back, origin = final.cast(wide), try_cast(value, own, wide)
            more = value.rlike(rf"\.[0-9]{{{scale},}}[1-9]")
            powers = value.rlike("[eE]") & (try_cast(value, own, T.DoubleType()) != final.cast("double"))
            # Digits alone, no more behind the point than the target has, are all kept.
            kept = value.rlike(rf"^[+-]?[0-9]+(\.[0-9]{{0,{getattr(wanted, 'scale', 0)}}})?$")
            return F.coalesce(final.isNotNull() & ~kept & ((back != origin) | more | powers), F.lit(False))
        elif isinstance(wanted, T.DateType):
            back, origin = final.cast("timestamp_ntz"), try_cast(value, own, T.TimestampNTZType())
        else:
            return F.lit(False)
        return F.coalesce(final.isNotNull() & ~back.eqNullSafe(origin), F.lit(False))
    if isinstance(wanted, T.StringType):
        return F.lit(False)
    return final.isNotNull() & ~try_cast(final, wanted, own).eqNullSafe(value)
