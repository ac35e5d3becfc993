"""Many per-column aggregates in one pass, as one row per column."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Item = TypeVar("Item")

# One aggregate over very many columns outgrows what the JVM will compile, so
# wide tables are measured in groups. Each group scans its own columns only.
COLUMNS_PER_PASS = 16
MEASURED_COLUMNS_PER_PASS = 8


@dataclass(frozen=True)
class Measure:
    """Texts that label a row of the result, and conditions counted for it."""

    labels: Mapping[str, str | None]
    counts: Mapping[str, Column]


def in_groups(items: Sequence[Item], size: int = COLUMNS_PER_PASS) -> Iterator[Sequence[Item]]:
    for start in range(0, len(items), size):
        yield items[start : start + size]


def text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The frame with a column that is evaluated once per row.

    A plain projection is merged with those after it, which copies a long
    expression to every place that reads it, until the JVM no longer compiles
    the whole. A generator of one element is not merged.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def tidy_counts(
    df: DataFrame, measures: Sequence[Measure], labels: Sequence[str], counts: Sequence[str]
) -> DataFrame:
    """Row count and conditional counts, one row per measure.

    ``labels`` and ``counts`` name what every measure holds, so that a frame
    without columns to measure gives an empty result of the same kind.
    """
    if not measures:
        kinds = [f"{n} string" for n in labels] + [f"{n} bigint" for n in ("n_rows", *counts)]
        return df.sparkSession.createDataFrame([], ", ".join(kinds))
    parts = []
    for group in in_groups(measures):
        counts = {
            (i, name): f"c{i}_{name}" for i, m in enumerate(group) for name in m.counts
        }
        totals = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[
                F.count_if(group[i].counts[name]).alias(alias)
                for (i, name), alias in counts.items()
            ],
        )
        rows = [
            F.struct(
                *[text(value).alias(name) for name, value in m.labels.items()],
                F.col("n_rows"),
                *[F.col(counts[i, name]).alias(name) for name in m.counts],
            )
            for i, m in enumerate(group)
        ]
        parts.append(totals.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionAll, parts)
