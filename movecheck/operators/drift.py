"""Schema drift between two versions of a table, and its repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movecheck.functions.casts import safe_cast
from movecheck.functions.names import column, name_key, names_by_key
from movecheck.operators.conform import cast_loss

# The outcomes of comparing one column.
SAME = "same"
TYPE_DIFFERS = "type_differs"
ONLY_LEFT = "only_left"
ONLY_RIGHT = "only_right"


def _drift_rows(left: DataFrame, right: DataFrame) -> list[tuple]:
    key = name_key(left.sparkSession)
    lefts = {key(f.name): f for f in left.schema}
    rights = {key(f.name): f for f in right.schema}
    rows = []
    for name in sorted({*lefts, *rights}):
        a, b = lefts.get(name), rights.get(name)
        a_type = a.dataType.simpleString() if a else None
        b_type = b.dataType.simpleString() if b else None
        if a is None or b is None:
            status = ONLY_LEFT if b is None else ONLY_RIGHT
        else:
            status = SAME if a_type == b_type else TYPE_DIFFERS
        rows.append(((a or b).name, a_type, b_type, status))
    return rows


def schema_drift(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per column of either side: both types and how they compare.

    Only schemas are read.
    """
    return left.sparkSession.createDataFrame(
        _drift_rows(left, right),
        "column_name string, left_type string, right_type string, status string",
    ).orderBy("column_name")


def drift_report(left: DataFrame, right: DataFrame) -> DataFrame:
    """:func:`schema_drift`, with the values of ``left`` that would be lost.

    One pass over the columns of ``left`` whose type differs; other columns
    have no counts.
    """
    rows = _drift_rows(left, right)
    differing = [name for name, _, _, status in rows if status == TYPE_DIFFERS]
    drift = schema_drift(left, right)
    if not differing:
        return drift.select(
            "*",
            F.lit(None).cast("bigint").alias("n_values"),
            F.lit(None).cast("bigint").alias("n_lost"),
        )
    losses = cast_loss(left, right.schema, differing)
    return drift.join(
        losses.select("column_name", "n_values", "n_lost"), "column_name", "left"
    )


def align_to(old: DataFrame, new: DataFrame, fill_missing: bool = False) -> DataFrame:
    """``old`` with its shared columns cast to the types they have in ``new``.

    One projection. Values that do not fit become null (count them with
    ``cast_loss(old, new.schema)``). Columns of ``old`` alone stay as they
    are; columns of ``new`` alone are added as typed nulls on request.
    """
    key, news = name_key(old.sparkSession), names_by_key(new)
    columns = []
    for field in old.schema:
        name = news.get(key(field.name))
        value = column(field.name)
        if name is not None:
            value = safe_cast(value, field.dataType, new.schema[name].dataType)
        columns.append(value.alias(field.name))
    if fill_missing:
        olds = names_by_key(old)
        columns += [
            F.lit(None).cast(field.dataType).alias(field.name)
            for field in new.schema
            if key(field.name) not in olds
        ]
    return old.select(*columns)


def union_aligned(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both versions as one table in ``new``'s types, without a shuffle."""
    aligned = align_to(old, new, fill_missing=True)
    return aligned.unionByName(new, allowMissingColumns=True)
