"""Contracts inferred from data: the join of a lattice of types over all values.

Every value is held without loss by some of the types, and by every type above
those: whole numbers by int, bigint, decimal and double, dates by date and
timestamp, anything by string. The state of a column is the set of types that
hold all values seen, as bits, with the most digits before and behind the point.
Two states merge by intersecting the sets and taking the larger sizes, which is
associative: so one aggregate infers a table, and states of several versions of
a table merge the same way. The contract names the least type left.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.names import column, name_key
from movecheck.operators.tidy import in_groups, text
from movecheck.sources.contract import NULLABLE, PRESENT, REQUIRED, SOURCE_NAME, TARGET_NAME, TYPE_TEXT

BOOLEAN, INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, TEXT = (1 << i for i in range(8))
NUMBERS = INT | LONG | DECIMAL | DOUBLE
# The tests of more columns outgrow what the JVM compiles; each pass scans its own columns only.
COLUMNS_PER_PASS = 2
# Decimal places that every double holds.
DOUBLE_DIGITS = 15
# What a typed column's values are held by, and their digits.
TYPED = {
    "boolean": (BOOLEAN, 0, 0), "tinyint": (NUMBERS, 3, 0), "smallint": (NUMBERS, 5, 0), "int": (NUMBERS, 10, 0),
    "bigint": (LONG | DECIMAL, 19, 0), "float": (DOUBLE, 0, 0), "double": (DOUBLE, 0, 0), "date": (DATE | TIMESTAMP, 0, 0),
    "timestamp_ntz": (TIMESTAMP, 0, 0),
}
# Not zeros with a sign, which a decimal forgets.
PLAIN_NUMBER = r"^(?!-0(\.0+)?$)-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
ANY_NUMBER = r"^(-?[0-9]+(\.[0-9]+)?(E-?[0-9]+)?|NaN|-?Infinity)$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"


def _bit(holds: Column, bits: int) -> Column:
    return F.when(F.coalesce(holds, F.lit(False)), bits).otherwise(0)


def _held_by(value: Column, plain: Column, digits: Column, scale: Column) -> Column:
    """Bits of the types that hold a text's value and would write it alike."""
    # Casts are tried only where a pattern says that they can succeed, and patterns only at lengths they match.
    tried = lambda pattern, kind: F.when(value.rlike(pattern), value.try_cast(kind))
    length = F.length(value)
    is_whole = plain & (scale == 0) & (digits <= 19)
    number = F.when(is_whole & (digits > 9), value.try_cast("bigint"))
    bits = [
        _bit(value.isin("true", "false"), BOOLEAN),
        _bit(is_whole & ((digits <= 18) | number.isNotNull()), LONG),
        _bit(is_whole & ((digits <= 9) | number.between(-(1 << 31), (1 << 31) - 1)), INT),
        _bit(plain & (digits + scale <= 38), DECIMAL),
        _bit((plain & (digits + scale <= DOUBLE_DIGITS)) | (tried(ANY_NUMBER, "double").cast("string") == value), DOUBLE),
        _bit(~plain & (length == 10) & (tried(DAY, "date").cast("string") == value), DATE | TIMESTAMP),
        _bit(~plain & (length >= 19) & (tried(MOMENT, "timestamp_ntz").cast("string") == value), TIMESTAMP),
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(TEXT))


def _state_row(name: str, position: int, n_values: Column, held: Column, digits: Column, scale: Column) -> Column:
    names = ("column_name", "position", "n_rows", "n_values", "held", "digits", "scale")
    values = (text(name), F.lit(position), F.col("n_rows"), n_values, held, digits, scale)
    return F.struct(*[v.alias(n) for v, n in zip(values, names)])


def _typed(dtype: T.DataType) -> tuple[int, int, int]:
    if isinstance(dtype, T.DecimalType):
        return DECIMAL | TEXT, dtype.precision - dtype.scale, dtype.scale
    if dtype.simpleString() not in TYPED:
        raise TypeError(f"no contract type is inferred for {dtype.simpleString()}")
    held, digits, scale = TYPED[dtype.simpleString()]
    return held | TEXT, digits, scale


def type_states(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, values that are not null, types that hold them all, digits.

    Texts are judged by value, other columns by their type.
    """
    names = list(columns) if columns is not None else df.columns
    if not names:
        raise ValueError("no column to infer")
    parts = []
    for group in in_groups(list(enumerate(names)), COLUMNS_PER_PASS):
        textual = [i for i, n in group if isinstance(df.schema[n].dataType, T.StringType)]
        rows = df.select(*[column(n).alias(f"c{i}") for i, n in group])
        rows = rows.select(
            "*",
            *[F.col(f"c{i}").rlike(PLAIN_NUMBER).alias(f"plain{i}") for i in textual],
            *[F.instr(f"c{i}", ".").alias(f"point{i}") for i in textual],
        )
        whole = lambda i: F.when(F.col(f"point{i}") > 0, F.col(f"point{i}") - 1).otherwise(F.length(f"c{i}"))
        behind = lambda i: F.when(F.col(f"point{i}") > 0, F.length(f"c{i}") - F.col(f"point{i}")).otherwise(0)
        sizes = {"digits": lambda i: whole(i) - F.when(F.col(f"c{i}").startswith("-"), 1).otherwise(0), "scale": behind}
        rows = rows.select("*", *[F.when(F.col(f"plain{i}"), size(i)).alias(f"{what}{i}") for i in textual for what, size in sizes.items()])
        held = [_held_by(F.col(f"c{i}"), *[F.col(f"{w}{i}") for w in ("plain", "digits", "scale")]).alias(f"held{i}") for i in textual]
        rows = rows.select("*", *held)
        wanted, out = [F.count(F.lit(1)).alias("n_rows")], []
        for i, name in group:
            wanted.append(F.count(f"c{i}").alias(f"n{i}"))
            if i in textual:
                # The bits of a null are no value's.
                bits = F.bit_and(F.when(F.col(f"c{i}").isNotNull(), F.col(f"held{i}")))
                wanted += [bits.alias(f"all{i}"), *[F.max(f"{w}{i}").alias(f"most_{w}{i}") for w in ("digits", "scale")]]
                state = [F.col(f"all{i}"), F.col(f"most_digits{i}"), F.col(f"most_scale{i}")]
            else:
                state = [F.lit(x) for x in _typed(df.schema[name].dataType)]
            out.append(_state_row(name, i, F.col(f"n{i}"), *state))
        parts.append(rows.agg(*wanted).select(F.inline(F.array(*out))))
    return reduce(DataFrame.unionAll, parts)


def infer_contract(*versions: DataFrame) -> DataFrame:
    """Contract rows for the versions of a table, one per column name, in order of appearance.

    The types hold every value of every version; numbers of up to 38 places are
    decimals, signs of zeros and exponents make doubles, leading zeros texts. A
    column without values is a text. It is nullable if any version holds a null
    or lacks it, and required if all have it. The rows are a contract as they are
    (see :func:`as_contract`), and can be written to a file and read again.
    """
    if not versions:
        raise ValueError("no table to infer from")
    key = name_key(versions[0].sparkSession)
    spellings: dict[str, str] = {}
    for df in versions:
        for name in df.columns:
            spellings.setdefault(key(name), name)
    order = {name: i for i, name in enumerate(spellings.values())}
    states = reduce(
        DataFrame.unionAll,
        [type_states(df.select(*[column(n).alias(spellings[key(n)]) for n in df.columns])) for df in versions],
    )
    merged = states.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.count(F.lit(1)).alias("n_versions"),
        F.bit_and(F.when(F.col("n_values") > 0, F.col("held"))).alias("held"),
        F.coalesce(F.max("digits"), F.lit(0)).alias("digits"), F.coalesce(F.max("scale"), F.lit(0)).alias("scale"),
    )
    has = lambda bits: F.col("held").bitwiseAND(bits) != 0
    places = F.col("digits") + F.col("scale")
    kind = (
        F.when(F.col("held").isNull(), "string").when(has(BOOLEAN), "boolean").when(has(INT), "int").when(has(LONG), "bigint")
        .when(has(DECIMAL) & (places <= 38), F.concat(F.lit("decimal("), places.cast("string"), F.lit(","), F.col("scale").cast("string"), F.lit(")")))
        .when(has(DOUBLE), "double").when(has(DATE), "date").when(has(TIMESTAMP), "timestamp_ntz").otherwise("string")
    )
    flag = lambda is_so: F.when(is_so, "true").otherwise("false")
    everywhere = F.col("n_versions") == len(versions)
    place = F.lit(0)
    for name, i in order.items():
        place = F.when(F.col("column_name") == name, i).otherwise(place)
    return merged.orderBy(place).select(
        F.col("column_name").alias(SOURCE_NAME), F.col("column_name").alias(TARGET_NAME), kind.alias(TYPE_TEXT),
        flag((F.col("n_values") < F.col("n_rows")) | ~everywhere).alias(NULLABLE), F.lit("true").alias(PRESENT),
        flag(everywhere).alias(REQUIRED),
    )
