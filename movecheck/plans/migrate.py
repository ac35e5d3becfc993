"""Loading a table under a contract, and proving the load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from movecheck.functions.casts import safe_cast
from movecheck.functions.names import column, resolve
from movecheck.operators.conform import contract_losses
from movecheck.operators.decimals import fit_decimals
from movecheck.operators.drift import align_to, drift_report
from movecheck.operators.reconcile import Reconciliation, reconcile
from movecheck.sources.contract import Contract, as_contract
from movecheck.sources.sinks import CONNECTOR_OPTIONS, write_table
from movecheck.sources.tables import MERGING_FORMATS, read_source, read_table


@dataclass(frozen=True)
class Migration:
    """What a load did: the rows it was to write, and target against source."""

    loaded: DataFrame
    written: DataFrame
    difference: Reconciliation


class ContractViolation(ValueError):
    """The source does not fit the contract."""


def compare_with_table(
    spark: SparkSession,
    path: str,
    contract: Contract | DataFrame,
    table: str | None,
    source_fmt: str = "orc",
    table_fmt: str = "parquet",
    table_options: Mapping[str, str] | None = None,
    multiset: bool = False,
    tolerance_scale: int | None = None,
) -> Reconciliation:
    """Compare files read under a contract with a loaded table."""
    contract = as_contract(contract)
    source = read_table(spark, path, source_fmt, contract)
    loaded = read_table(spark, table, table_fmt, options=table_options)
    cols = [c.target for c in contract.columns]
    return reconcile(source, loaded, cols, multiset, tolerance_scale)


def read_written(
    spark: SparkSession,
    target: str,
    fmt: str,
    options: Mapping[str, str] | None = None,
    as_table: bool = False,
    folders: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Read a table back from where :func:`write_table` put it.

    ``folders`` holds the types of columns that are stored as folder names.
    """
    names = CONNECTOR_OPTIONS.get(fmt.lower())
    if names:
        return read_table(spark, None, fmt, options={**(options or {}), names["target"]: target})
    if as_table:
        return spark.table(target)
    found = read_table(spark, target, fmt, infer_partitions=not folders)
    for name, dtype in (folders or {}).items():
        (own,) = resolve(found, [name])
        found = found.withColumn(own, safe_cast(column(own), found.schema[own].dataType, dtype))
    return found


def check_source(
    source: DataFrame,
    contract: Contract,
    decimal: tuple[int, int] | None = None,
    allow_altered: bool = True,
) -> None:
    """Raise if the load would lose values or break a not-null rule.

    ``decimal`` is what decimals are fitted to after the contract. Without
    ``allow_altered`` values that become another value are an error too.
    """
    wrong = "n_lost > 0 or n_violations > 0" + ("" if allow_altered else " or n_altered > 0")
    problems = [
        f"{row.column_name}: {row.n_lost} values lost, {row.n_violations} forbidden nulls, "
        f"{row.n_altered} values altered"
        for row in contract_losses(source, contract, decimal).filter(wrong).collect()
    ]
    if problems:
        raise ContractViolation("; ".join(problems))


def migrate(
    spark: SparkSession,
    source: str | Sequence[str],
    contract: Contract | DataFrame,
    target: str,
    source_fmt: str = "orc",
    target_fmt: str = "parquet",
    mode: str = "append",
    partition_by: str | None = None,
    cluster_by: Sequence[str] | None = None,
    decimal: tuple[int, int] | None = None,
    strict: bool | str = False,
    multiset: bool = True,
    read_options: Mapping[str, str] | None = None,
    write_options: Mapping[str, str] | None = None,
    partition_grain: str | None = None,
    dynamic: bool = False,
    as_table: bool = False,
    unfitted: bool = True,
) -> Migration:
    """Read, conform, fit decimals, write, and compare the written table.

    ``strict`` checks the source first, down to the fitted decimals, and writes
    nothing if values would be lost or forbidden nulls appear; ``"exact"`` also
    refuses values that would become others. ``target`` is a path, or with
    ``as_table`` a catalog table. The comparison is lazy: use its ``report()``.
    It holds the target against the rows before their decimals were fitted, so
    that what fitting costs is part of it, or without ``unfitted`` against the
    rows written. After an append to a table that
    had rows before, or a refresh of single partitions, the target's other rows
    show up on the right.
    """
    if strict not in (False, True, "exact"):
        raise ValueError("strict must be a boolean or 'exact'")
    contract = as_contract(contract)
    if strict:
        paths = [source] if isinstance(source, str) else source
        for path in paths:
            physical = read_source(spark, path, source_fmt, contract, read_options)
            check_source(physical, contract, decimal, allow_altered=strict != "exact")
    conformed = read_table(spark, source, source_fmt, contract, read_options)
    rows = fit_decimals(conformed, *(decimal or ()))
    write_table(
        rows, target, target_fmt, mode, partition_by, cluster_by, partition_grain, dynamic, as_table,
        options=write_options,
    )
    folders = {}
    if partition_by and not as_table:
        for name in resolve(rows, [partition_by]):
            if partition_grain:
                folders[f"{name}_{partition_grain}"] = T.StringType()
            else:
                folders[name] = rows.schema[name].dataType
    written = read_written(spark, target, target_fmt, write_options, as_table, folders)
    left = conformed if unfitted else rows
    return Migration(rows, written, reconcile(left, written, rows.columns, multiset))


def align_partitions(
    spark: SparkSession, old_path: str, new_path: str, fmt: str = "orc"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(drift report, old partition in the new types, new partition)."""
    merge = fmt.lower() in MERGING_FORMATS
    old, new = (read_table(spark, path, fmt, merge_schema=merge) for path in (old_path, new_path))
    return drift_report(old, new), align_to(old, new), new
