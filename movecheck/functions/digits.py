"""Digit counts of numbers, as column expressions.

Two rules exist because the two ways to profile a number disagree:

* the *plain* rule looks at ``abs(x)`` as text: all digits, digits before the
  point, digits after it (0 without a point);
* the *signed text* rule looks at the number's general decimal text, exponent
  and sign included: characters before the point without the sign, and
  characters after it, where a text without a point counts whole on both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain_text(value: Column, dtype: T.DataType) -> Column:
    """``abs(value)`` without an exponent; null for NaN and the infinities.

    Floats print an exponent outside 1e-3..1e7. Such a text is written out from
    its digits and its exponent, whatever their size.
    """
    size = F.abs(value)
    text = size.cast("string")
    if isinstance(dtype, T.DecimalType):
        return text
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    digits = F.rtrim(F.translate(F.substring_index(text, "E", 1), ".", ""), F.lit("0"))
    whole = exponent + 1
    padded = F.concat(digits, F.repeat(F.lit("0"), F.greatest(whole - F.length(digits), F.lit(0))))
    fraction = F.substr(padded, whole + 1)
    large = F.concat(
        F.substr(padded, F.lit(1), whole), F.lit("."), F.when(fraction == "", "0").otherwise(fraction)
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), F.greatest(-exponent - 1, F.lit(0))), digits)
    return (
        F.when(F.instr(text, "E") > 0, F.when(exponent >= 0, large).otherwise(small))
        .when(~F.isnan(size) & (size != F.lit(float("inf"))), text)
    )


def own_digits(value: Column, dtype: T.DataType) -> Column:
    """A float as the double of its shortest digits: 0.1 of 32 bits is 0.1 of 64."""
    return value.cast("string").cast("double") if isinstance(dtype, T.FloatType) else value.cast("double")


def without_end_zeros(text: Column) -> Column:
    """A plain text without zeros at the end of its fraction."""
    bare = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    return F.when(F.instr(text, ".") > 0, bare).otherwise(text)


def plain_digits(size: Column, point: Column) -> dict[str, Column]:
    """Digit counts from a plain text's length and the place of its point."""
    return {
        "precision": F.when(point > 0, size - 1).otherwise(size),
        "integer_digits": F.when(point > 0, point - 1).otherwise(size),
        "scale": F.when(point > 0, size - point).when(size.isNotNull(), F.lit(0)),
    }


def integer_digits(value: Column) -> Column:
    """Digits before the point of a whole number or decimal."""
    return F.length(F.substring_index(F.ltrim(value.cast("string"), F.lit("-")), ".", 1))


def _scientific(n_digits: Column, exponent_size: Column, sign: Column) -> tuple[Column, Column]:
    """Sizes of ``d.dddE±x``; one digit means no point, so both parts are whole."""
    tail = F.lit(2) + exponent_size
    whole = F.lit(1) + tail
    return (
        F.when(n_digits == 1, whole).otherwise(F.lit(1)),
        F.when(n_digits == 1, whole + sign).otherwise(n_digits - 1 + tail),
    )


def text_parts(value: Column, dtype: T.DataType) -> dict[str, Column]:
    """What the signed text rule needs to know of a float or decimal."""
    return {
        "sign": F.when(value < 0, 1).otherwise(0),
        "text": F.abs(value.cast("double") if isinstance(dtype, T.FloatType) else value).cast("string"),
    }


def text_measures(text: Column, sign: Column, dtype: T.DataType) -> dict[str, Column]:
    """Numbers that the sizes follow from; the costly ones only where needed."""
    measures = {"size": F.length(text), "point": F.instr(text, "."), "sign": sign}
    if isinstance(dtype, T.DecimalType):
        n_digits = F.length(F.ltrim(F.translate(text, ".", ""), F.lit("0")))
        return measures | {"n_digits": F.greatest(n_digits, F.lit(1))}
    marked = F.instr(text, "E") > 0
    mantissa = F.translate(F.substring_index(text, "E", 1), ".", "")
    return measures | {
        "exponent": F.when(marked, F.substring_index(text, "E", -1).cast("int")),
        "n_digits": F.when(marked, F.length(F.rtrim(mantissa, F.lit("0")))),
    }


def signed_text_sizes(m: dict[str, Column], dtype: T.DataType) -> tuple[Column, Column]:
    """(characters before the point, characters after it) by the signed text rule."""
    size, point, sign, n_digits = m["size"], m["point"], m["sign"], m["n_digits"]
    if isinstance(dtype, T.DecimalType):
        # The text takes an exponent once its first digit is more than six
        # places after the point.
        exponent = n_digits - 1 - F.lit(dtype.scale)
        before, after = _scientific(n_digits, F.length(F.abs(exponent).cast("string")), sign)
        return (
            F.when(exponent < -6, before).otherwise(point - 1),
            F.when(exponent < -6, after).otherwise(size - point),
        )
    # A float's text has a point within 1e-3..1e7, an exponent outside it, and
    # neither only if it is NaN or infinite. In the general decimal text an
    # integral float below 1e16 keeps its ".0"; from there on it is an integer
    # as long as all its digits are significant.
    exponent = m["exponent"]
    before, after = _scientific(n_digits, F.length(F.abs(exponent).cast("string")), sign)
    cases = (
        (exponent.isNull() & (point > 0), point - 1, size - point),
        (exponent.isNull(), size, size + sign),
        ((exponent >= 0) & (exponent < 16), exponent + 1, F.greatest(n_digits - 1 - exponent, F.lit(1))),
        ((exponent >= 16) & (exponent < n_digits), exponent + 1, exponent + 1 + sign),
        ((exponent < 0) & (exponent >= -6), F.lit(1), n_digits - 1 - exponent),
    )
    found = (before, after)
    for condition, *sizes in reversed(cases):
        found = tuple(F.when(condition, own).otherwise(rest) for own, rest in zip(sizes, found))
    return tuple(F.when(size.isNotNull(), one) for one in found)
