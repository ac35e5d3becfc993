"""Key discovery: the smallest column sets that tell all rows apart.

Sets are tried level by level, and supersets of a found key are left out. A
level is pruned by witnesses, first among some tens of thousands of rows, where
most sets repeat a value already. Of the sets left, the values of all rows whose
hash falls into one slice of the hash range are counted. A value seen twice rules
a set out: it is no estimate, so no key is ever lost, and a set without a witness
is always checked on all rows. These are keys and sets with very few repeats.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movecheck.functions.names import column, resolve
from movecheck.operators.tidy import in_groups

MAX_COLUMNS = 3
# One in so many values of each set is looked at before the exact check.
SLICES = 64
SETS_PER_PASS = 64
# About so many rows are looked at for witnesses before all rows are.
FIRST_ROWS = 50_000


def _ruled_out(df: DataFrame, sets: Sequence[tuple[str, ...]], slices: int) -> set[int]:
    """Numbers of the sets of which some value in the slice occurs twice.

    Values are told apart by two hashes of 64 bits. Hashes pass over nulls, so
    the places of nulls are hashed as well.
    """
    entries, names = [], sorted({n for names in sets for n in names})
    place = {n: i for i, n in enumerate(names)}
    # Each column is hashed once, however many sets hold it.
    hashed = df.select(*[
        F.xxhash64(F.lit(salt), column(n), column(n).isNull()).alias(f"{what}{i}")
        for n, i in place.items() for salt, what in enumerate("ho")
    ])
    for no, names_of_set in enumerate(sets):
        h, other = (F.xxhash64(*[F.col(f"{what}{place[n]}") for n in names_of_set]) for what in "ho")
        entries.append(F.struct(F.lit(no).alias("no"), h.alias("h"), other.alias("other")))
    values = hashed.select(F.inline(F.array(*entries))).filter(F.pmod("h", F.lit(slices)) == 0)
    twice = values.groupBy("no", "h", "other").count().filter("count > 1")
    return {row["no"] for row in twice.select("no").distinct().collect()}


def _is_key(df: DataFrame, names: Sequence[str]) -> bool:
    groups = df.groupBy(*[column(n) for n in names]).agg(F.count(F.lit(1)).alias("__n"))
    return groups.filter("__n > 1").isEmpty()


def _candidates(names: list[str], size: int, found: list[tuple[str, ...]]) -> Iterator[tuple[str, ...]]:
    for names_of_set in combinations(names, size):
        if not any(set(key) <= set(names_of_set) for key in found):
            yield names_of_set


def unique_keys(
    df: DataFrame, cols: Sequence[str] | None = None, max_columns: int = MAX_COLUMNS, slices: int = SLICES
) -> DataFrame:
    """All minimal sets of up to ``max_columns`` columns without a repeated value.

    A null counts as a value, as in grouping; ``n_null_rows`` tells how many rows
    of a key hold one, so keys for a join that drops nulls can be told apart.
    Columns of maps and variants cannot be grouped and are left out unless they
    are named. Returns key (array of names, in the order of the table),
    n_columns and n_null_rows. A table of at most one row has every column as
    its key. The driver gets one row per candidate set, none per value.
    """
    if cols is None:
        names = [f.name for f in df.schema if not _holds(f.dataType.simpleString())]
    else:
        wanted = set(resolve(df, cols))
        names = [n for n in df.columns if n in wanted]
    found: list[tuple[str, ...]] = []
    n_rows = df.count()
    few = df.sample(FIRST_ROWS / n_rows, seed=1) if n_rows > FIRST_ROWS else df
    for size in range(1, min(max_columns, len(names)) + 1):
        for sets in in_groups(list(_candidates(names, size, found)), SETS_PER_PASS):
            out = _ruled_out(few, sets, 1)
            left = [s for no, s in enumerate(sets) if no not in out]
            out = _ruled_out(df, left, slices) if left and n_rows > FIRST_ROWS else set()
            found += [s for no, s in enumerate(left) if no not in out and _is_key(df, s)]
    nulls = {}
    for group in in_groups(found, 32):
        counts = df.agg(*[
            F.count_if(F.greatest(*[column(n).isNull() for n in (*key, key[0])])).alias(f"c{i}")
            for i, key in enumerate(group)
        ]).first()
        nulls.update({key: counts[f"c{i}"] for i, key in enumerate(group)})
    return df.sparkSession.createDataFrame(
        [(list(key), len(key), nulls[key]) for key in found],
        "key array<string>, n_columns int, n_null_rows long",
    )


def _holds(kind: str) -> bool:
    return "map<" in kind or "variant" in kind
