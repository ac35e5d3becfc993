"""Rows of one table whose key another table lacks, and copying them over."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movecheck.functions.names import column, resolve
from movecheck.functions.types import common_type, comparable
from movecheck.sources.sinks import write_table


def _key_names(count: int) -> list[str]:
    return [f"__key{i}" for i in range(count)]


def _once_each(renamed: DataFrame, names: Sequence[str], null_safe: bool) -> DataFrame:
    """Each key once, in no partitioning that the coming join could reuse.

    Copies of a hot key collapse inside each map task. Adaptive execution then
    splits a hot key of the other side, but only if both sides come straight
    from a shuffle made for the join. A null-safe join shuffles on expressions
    of its own; for a plain one the extra grouping column, a function of the
    keys, keeps the deduplication from standing in for that shuffle. What is
    shuffled twice are distinct keys only.
    """
    if null_safe:
        return renamed.distinct()
    return renamed.withColumn("__spread", F.xxhash64(*names)).distinct().select(*names)


def missing_rows(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    null_safe: bool = True,
    unique_target: bool = False,
) -> DataFrame:
    """Rows of ``src`` whose key does not occur in ``tgt``, copies included.

    Null keys match null keys unless ``null_safe=False``. ``unique_target``
    promises distinct keys in ``tgt`` and saves their deduplication. Keys of
    two types are compared in their common type, as :func:`reconcile` does.
    """
    own, other = resolve(src, keys), resolve(tgt, keys)
    names = _key_names(len(keys))
    own_types = [src.schema[k].dataType for k in own]
    other_types = [tgt.schema[k].dataType for k in other]
    shared = [common_type(a, b) for a, b in zip(own_types, other_types)]
    known = tgt.select(
        *[comparable(column(k), t, s).alias(n) for k, t, s, n in zip(other, other_types, shared, names)]
    )
    if not unique_target:
        known = _once_each(known, names, null_safe)
    values = [comparable(column(k), t, s) for k, t, s in zip(own, own_types, shared)]
    matches = [
        value.eqNullSafe(column(n)) if null_safe else value == column(n)
        for value, n in zip(values, names)
    ]
    return src.join(known, reduce(and_, matches), "left_anti")


def copy_missing(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], target: str, **write
) -> None:
    """Append to the table at ``target``, read as ``tgt``, the rows it lacks.

    Few rows may be left of every task, so they are gathered into files of a
    sensible size; only missing rows are moved for that.
    """
    missing = missing_rows(src, tgt, keys)
    if not write.get("partition_by"):
        missing = missing.hint("rebalance")
    write_table(missing, target, mode="append", **write)
