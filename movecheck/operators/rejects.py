"""A load that takes the good rows and keeps the others with their reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.casts import altered, is_lost, safe_cast
from movecheck.functions.names import column, name_key, names_by_key
from movecheck.operators.conform import contract_columns
from movecheck.sources.contract import Contract, as_contract
from movecheck.sources.sinks import write_table

# Reason codes, each followed by ":" and the target column.
LOST = "lost"
ALTERED = "altered"
FORBIDDEN_NULL = "null"

# The written partition column and its two folders.
ROUTE, ACCEPTED, REJECTED = "route", "accepted", "rejected"
REASONS, SOURCE_ROW = "reasons", "source_row"


def reject_reasons(
    df: DataFrame, contract: Contract | DataFrame, decimal: tuple[int, int] | None = None, exact: bool = False
) -> Column:
    """Why a row of the source does not fit the contract, as an array of codes.

    ``lost:x`` for a value that becomes null, ``null:x`` for a null that x must
    not hold (also one that a lost value would leave), and with ``exact``
    ``altered:x`` for a value that becomes another. Codes come in the order of
    the contract. ``decimal`` is what decimals are fitted to afterwards.
    """
    contract = as_contract(contract)
    key, known = name_key(df.sparkSession), names_by_key(df)
    codes = []
    for c in contract.columns:
        name = known.get(key(c.source)) if c.present else None
        if name is None:
            if not c.nullable:
                codes.append(F.lit(f"{FORBIDDEN_NULL}:{c.target}"))
            continue
        own, final, at = df.schema[name].dataType, column(name), df.schema[name].dataType
        steps = [c.dtype]
        if decimal and isinstance(c.dtype, T.DecimalType):
            steps.append(T.DecimalType(*decimal))
        for step in steps:
            final, at = safe_cast(final, at, step), step
        loses = is_lost(column(name), own, final, at)
        codes.append(F.when(loses, f"{LOST}:{c.target}"))
        if exact:
            codes.append(F.when(altered(column(name), own, final, at), f"{ALTERED}:{c.target}"))
        if not c.nullable:
            # An array that lost an element is no null.
            gone = column(name).isNull() if isinstance(c.dtype, T.ArrayType) else column(name).isNull() | loses
            codes.append(F.when(gone, f"{FORBIDDEN_NULL}:{c.target}"))
    return F.array_compact(F.array(*codes)) if codes else F.array().cast("array<string>")


def route_rows(
    df: DataFrame, contract: Contract | DataFrame, decimal: tuple[int, int] | None = None, exact: bool = False
) -> DataFrame:
    """Every row conformed, with its route, its reasons, and its source if rejected.

    One projection without a shuffle. ``source_row`` is the row as JSON, nulls
    included, so that a rejected row can be mended and loaded again. All rows of
    a source are returned, copies too.
    """
    contract = as_contract(contract)
    taken = {ROUTE, REASONS, SOURCE_ROW} & {c.target.lower() for c in contract.columns}
    if taken:
        raise ValueError(f"column name in use by the result: {', '.join(sorted(taken))}")
    raw = F.to_json(F.struct(*[column(n) for n in df.columns]), {"ignoreNullFields": "false"})
    reasons = reject_reasons(df, contract, decimal, exact)
    wide = df.select(*contract_columns(df, contract), reasons.alias(REASONS), raw.alias(SOURCE_ROW))
    fitted = T.DecimalType(*decimal) if decimal else None
    values = []
    for c in contract.columns:
        value = column(c.target)
        if fitted and isinstance(c.dtype, T.DecimalType):
            value = safe_cast(value, c.dtype, fitted).alias(c.target)
        values.append(value)
    bad = F.size(REASONS) > 0
    return wide.select(
        *values,
        REASONS,
        F.when(bad, F.col(SOURCE_ROW)).alias(SOURCE_ROW),
        F.when(bad, REJECTED).otherwise(ACCEPTED).alias(ROUTE),
    )


@dataclass(frozen=True)
class RoutedLoad:
    """What a load with rejects wrote: read from the target, not computed again."""

    accepted: DataFrame
    rejected: DataFrame

    def reasons(self) -> DataFrame:
        """Rejected rows per reason; a row counts under each of its reasons."""
        return self.rejected.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))


def load_with_rejects(
    df: DataFrame,
    contract: Contract | DataFrame,
    target: str,
    mode: str = "append",
    fmt: str = "parquet",
    decimal: tuple[int, int] | None = None,
    exact: bool = False,
) -> RoutedLoad:
    """Write good rows to ``target/route=accepted`` and others to ``target/route=rejected``.

    The source is read once: routes are a written partition column, and reasons
    are told by the same projection that conforms. Accepted rows have the
    contract's columns, rejected ones also ``reasons`` and ``source_row``.
    Accepted and rejected rows together are the source's rows.
    """
    contract = as_contract(contract)
    routed = route_rows(df, contract, decimal, exact)
    # No rebalance: two folders per task are few, and a shuffle would cost more.
    write_table(routed, target, fmt, mode, partition_by=ROUTE, rebalance=False)
    back = df.sparkSession.read.schema(routed.schema).format(fmt).load(target)
    names = [column(c.target) for c in contract.columns]
    return RoutedLoad(
        back.filter(F.col(ROUTE) == ACCEPTED).select(*names),
        back.filter(F.col(ROUTE) == REJECTED).select(*names, REASONS, SOURCE_ROW),
    )
