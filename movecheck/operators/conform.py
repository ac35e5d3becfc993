"""Apply a contract to a frame, and count what the contract costs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.casts import altered, is_lost, lost, safe_cast
from movecheck.functions.names import column, name_key, names_by_key
from movecheck.operators.tidy import Measure, tidy_counts
from movecheck.sources.contract import Contract, as_contract


def contract_columns(df: DataFrame, contract: Contract, rename: bool = True) -> list[Column]:
    """The contract's columns as expressions over a frame; see :func:`conform`."""
    key, known = name_key(df.sparkSession), names_by_key(df)
    absent = [c.source for c in contract.columns if c.required and c.present and key(c.source) not in known]
    if absent:
        raise ValueError(f"required columns are absent: {', '.join(absent)}")
    columns = []
    for c in contract.columns:
        name = known.get(key(c.source)) if c.present else None
        if name is None:
            value = F.lit(None).cast(c.dtype)
        else:
            value = safe_cast(column(name), df.schema[name].dataType, c.dtype)
        columns.append(value.alias(c.target if rename else c.source))
    return columns


def conform(df: DataFrame, contract: Contract | DataFrame, rename: bool = True) -> DataFrame:
    """Project a frame onto a contract, by name.

    Columns the frame lacks, or the contract marks as absent, become typed
    nulls; others are cast with null for values that do not fit (count them
    with :func:`contract_losses`). ``rename`` uses the target names. A column
    that the contract requires and does not mark as absent has to be there.
    """
    return df.select(*contract_columns(df, as_contract(contract), rename))


def contract_losses(
    df: DataFrame, contract: Contract | DataFrame, decimal: tuple[int, int] | None = None
) -> DataFrame:
    """What conforming would cost, per contract column, in one pass.

    One row per column: types, rows, nulls in the source, values that become
    null, values that become another value (fractions cut off, digits rounded
    away, times cut to dates), and rows that end up null although the contract
    forbids it. ``decimal`` is the precision and scale that decimals are fitted
    to afterwards; the counts are then for the fitted values. These are exact
    counts from their own pass over the source: metrics observed during a write
    would count twice when lost tasks are run again.
    """
    contract = as_contract(contract)
    key, known = name_key(df.sparkSession), names_by_key(df)
    measures, read = [], []
    for i, c in enumerate(contract.columns):
        name = known.get(key(c.source)) if c.present else None
        steps = [c.dtype]
        if decimal and isinstance(c.dtype, T.DecimalType):
            steps.append(T.DecimalType(*decimal))
        if name is None:
            is_null, loses, changes, own = F.lit(True), F.lit(False), F.lit(False), None
        else:
            own = df.schema[name].dataType
            final, at = column(name), own
            for step in steps:
                final, at = safe_cast(final, at, step), step
            # Casts are projected first: counts that share them would each make their own.
            read += [column(name).alias(f"value{i}"), final.alias(f"final{i}")]
            value, final = F.col(f"value{i}"), F.col(f"final{i}")
            is_null = value.isNull()
            loses = is_lost(value, own, final, at)
            changes = altered(value, own, final, at)
        gone = is_null if isinstance(c.dtype, T.ArrayType) else is_null | loses
        measures.append(
            Measure(
                labels={
                    "column_name": c.target,
                    "from_type": own.simpleString() if own else None,
                    "to_type": steps[-1].simpleString(),
                },
                counts={
                    "n_nulls": is_null,
                    "n_lost": loses,
                    "n_altered": changes,
                    "n_violations": gone if not c.nullable else F.lit(False),
                },
            )
        )
    labels = ("column_name", "from_type", "to_type")
    return tidy_counts(df.select(*read), measures, labels, ("n_nulls", "n_lost", "n_altered", "n_violations"))


def null_violations(
    df: DataFrame, contract: Contract | DataFrame, names: str = "target"
) -> DataFrame:
    """Nulls per column that must not be null.

    File scans make every column nullable whatever schema they are given, so
    the flag has to be checked on the data. ``names`` tells under which of the
    contract's names the frame has its columns, ``target`` or ``source``; an
    absent column is null throughout.
    """
    if names not in ("target", "source"):
        raise ValueError("names must be target or source")
    contract = as_contract(contract)
    key, known = name_key(df.sparkSession), names_by_key(df)
    measures = []
    for c in contract.columns:
        if c.nullable:
            continue
        name = known.get(key(getattr(c, names)))
        is_null: Column = F.lit(True) if name is None else column(name).isNull()
        measures.append(Measure({"column_name": c.target}, {"n_nulls": is_null}))
    return tidy_counts(df, measures, ("column_name",), ("n_nulls",))


def cast_loss(
    df: DataFrame, target_schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """Values per shared column that a cast to ``target_schema`` turns to null.

    A cast that Spark accepts can still fail on the data, so the only honest
    check is a pass over it. An array counts once if it loses any element.
    """
    key, known = name_key(df.sparkSession), names_by_key(df)
    wanted = None if columns is None else {key(name) for name in columns}
    measures = []
    for field in target_schema:
        name = known.get(key(field.name))
        if name is None or (wanted is not None and key(name) not in wanted):
            continue
        own = df.schema[name].dataType
        measures.append(
            Measure(
                {
                    "column_name": name,
                    "from_type": own.simpleString(),
                    "to_type": field.dataType.simpleString(),
                },
                {
                    "n_values": column(name).isNotNull(),
                    "n_lost": lost(column(name), own, field.dataType),
                },
            )
        )
    labels = ("column_name", "from_type", "to_type")
    return tidy_counts(df, measures, labels, ("n_values", "n_lost"))
