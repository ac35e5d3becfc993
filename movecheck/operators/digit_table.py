"""How many values need which digits, and the least decimal that loses few of them.

Maxima of digits let one odd value decide a column's type. A table of counts by
digits before and after the point tells what every type would cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.digits import own_digits, plain_text, without_end_zeros
from movecheck.functions.names import column, resolve
from movecheck.functions.types import FLOAT_TYPES, INTEGRAL_TYPES
from movecheck.operators.tidy import computed

# Fixed value: the most digits of a decimal.
MAX_DIGITS = 38

NUMBERS = (*INTEGRAL_TYPES, *FLOAT_TYPES, T.DecimalType)


def digit_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Counts of values by (column_name, integer_digits, scale).

    Digits after the point end with the last that is not 0, a bare 0 before the
    point counts none. Values without digits (NaN, the infinities) are counted
    with null in both; nulls are not counted. By default all numeric columns.
    The counts of each task collapse to one row per pair of digits before the
    shuffle, so the table stays small.
    """
    names = resolve(df, columns) if columns is not None else [
        f.name for f in df.schema if isinstance(f.dataType, NUMBERS)
    ]
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column_name string, integer_digits int, scale int, n_values bigint"
        )
    entries = []
    for name in names:
        value, dtype = column(name), df.schema[name].dataType
        if not isinstance(dtype, NUMBERS):
            raise TypeError(f"not a number: {name}")
        number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
        if isinstance(dtype, FLOAT_TYPES):
            number = own_digits(value, dtype)
        else:
            text = F.ltrim(value.cast("string"), F.lit("-"))
        entries.append(F.struct(F.lit(name).alias("column_name"), number.alias("number"), text.alias("text")))
    # One expression for all columns, once they are rows: a wide table's code stays small.
    rows = df.select(F.inline(F.array(*entries))).filter(F.col("number").isNotNull() | F.col("text").isNotNull())
    plain = computed(rows, "plain", F.coalesce("text", plain_text(F.col("number"), T.DoubleType())))
    texts = computed(plain.select("column_name", "plain"), "digits", without_end_zeros(F.col("plain")))
    point = F.instr("digits", ".")
    whole = F.when(point > 0, point - 1).otherwise(F.length("digits"))
    bare = F.substring("digits", 1, 1) == "0"
    return (
        texts.select(
            "column_name",
            F.when(bare, F.lit(0)).otherwise(whole).cast("int").alias("integer_digits"),
            F.when(point > 0, F.length("digits") - point).when(point == 0, F.lit(0)).cast("int").alias("scale"),
        )
        .groupBy("column_name", "integer_digits", "scale").agg(F.count("*").alias("n_values"))
    )


def smallest_decimals(table: DataFrame, max_lost: int = 0, max_rounded: int = 0) -> DataFrame:
    """Per column the decimal of least precision that loses at most so many values.

    A value is lost if its digits before the point do not fit, or if it has no
    digits at all, and rounded if it is not lost and digits after the point do
    not fit. Among types of one precision that meet both bounds the one with
    fewer lost, then fewer rounded values, then the larger scale is taken. (What
    rounding up to one more digit would lose, as of 9.99 in one place, is for
    ``cast_loss`` to count.) Returns column_name, precision, scale, n_values,
    n_lost, n_rounded; precision, scale and the counts are null if no decimal
    meets the bounds. ``table`` is of :func:`digit_table`.

    Both counts are read off running sums over the two-way table, which has one
    row per pair of digits.
    """
    total = table.groupBy("column_name").agg(F.sum("n_values").alias("n_values"))
    # Only digits that occur, and none, can be the least that suffice.
    cells = (
        table.filter(F.col("scale").isNotNull()).select("column_name", F.col("integer_digits").alias("i"), F.col("scale").alias("s"), "n_values")
        .unionAll(total.select("column_name", F.lit(0), F.lit(0), F.lit(0).cast("bigint")))
        .groupBy("column_name", "i", "s").agg(F.sum("n_values").alias("c"))
    )
    up_to_i = Window.partitionBy("column_name").orderBy("i")
    within = (
        cells.groupBy("column_name", "i").agg(F.sum("c").alias("c"))
        .select("column_name", "i", F.sum("c").over(up_to_i).alias("within")).filter(F.col("i") <= MAX_DIGITS)
    )
    scales = cells.filter(F.col("s") <= MAX_DIGITS).select("column_name", "s").distinct()
    grid = within.join(scales, "column_name").join(cells, ["column_name", "i", "s"], "left").fillna(0, ["c"])
    row = F.sum("c").over(Window.partitionBy("column_name", "i").orderBy("s"))
    fit = F.sum("row").over(Window.partitionBy("column_name", "s").orderBy("i"))
    types = (
        grid.withColumn("row", row).withColumn("fit", fit).filter(F.col("i") + F.col("s") <= MAX_DIGITS)
        .join(total, "column_name")
        .select(
            "column_name", F.greatest(F.col("i") + F.col("s"), F.lit(1)).alias("precision"),
            (F.col("n_values") - F.col("within")).alias("n_lost"), (F.col("within") - F.col("fit")).alias("n_rounded"),
            F.col("s").alias("scale"),
        )
        .filter((F.col("n_lost") <= max_lost) & (F.col("n_rounded") <= max_rounded))
    )
    best = types.groupBy("column_name").agg(
        F.min(F.struct("precision", "n_lost", "n_rounded", (-F.col("scale")).alias("minus"))).alias("b")
    )
    return total.join(best, "column_name", "left").select(
        "column_name", "b.precision", (-F.col("b.minus")).alias("scale"), "n_values", "b.n_lost", "b.n_rounded"
    )
