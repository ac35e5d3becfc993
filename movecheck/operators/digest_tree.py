"""Comparing two tables without moving what is equal: a hash tree over key ranges.

The positions of the rows' keys are cut into ranges, ``2 ** FANOUT_BITS`` per
level. Both sides send one digest per range through the shuffle: the number of
rows and two sums over row hashes, one added and one combined bit by bit. Ranges
whose digests agree are done with; the others are cut again, and only their rows
are read again. What remains is compared row by row, at full width.

Whole numbers and dates are their own positions, so ranges are key intervals,
damage that lies together stays together, and the bounds reach the scan as
filters. Other keys are placed by their hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.names import column, resolve
from movecheck.functions.types import INTEGRAL_TYPES, common_type
from movecheck.operators.reconcile import Reconciliation, compared, reconcile, shared_columns

FANOUT_BITS = 6
# A range of fewer rows, both sides together, is not cut again.
LEAF_ROWS = 10_000
# So many differing ranges are held by the driver; beyond, cutting stops.
MAX_RANGES = 4096
# Separate intervals of a pushed filter.
MAX_INTERVALS = 16
HASH_BITS = 63
NESTED = (T.ArrayType, T.MapType, T.StructType)
POSITION = "__position"


@dataclass(frozen=True)
class Level:
    """One level of the tree: ranges that differ, and the rows of both sides in them."""

    n_differing: int
    rows_left: int


@dataclass(frozen=True)
class TreeReconciliation(Reconciliation):
    """A reconciliation with the levels that led to it and the rows it had to compare."""

    levels: tuple[Level, ...] = ()
    suspects: tuple[DataFrame, DataFrame] | None = None


def row_hash(df: DataFrame, seed: int) -> Column:
    """A hash of all columns that tells nulls apart from absent values.

    Spark's hash passes over nulls, so flags of them are hashed along, and nested
    values go as text.
    """
    values = []
    for field in df.schema:
        value = column(field.name)
        values.append(F.to_json(F.struct(value), {"ignoreNullFields": "false"}) if isinstance(field.dataType, NESTED) else value)
    nulls = F.concat(*[F.when(column(name).isNull(), "1").otherwise("0") for name in df.columns])
    return F.xxhash64(F.lit(seed), *values, nulls)


class _Places:
    """Positions of keys: from 0, in so many bits, as an expression of either side's columns."""

    def __init__(self, sides: tuple[DataFrame, DataFrame], keys: Sequence[tuple[str, str]]):
        self.keys, self.bounds, self.bits = keys, None, HASH_BITS
        kinds = [df.schema[name].dataType for df, name in zip(sides, keys[0])]
        self.dates = all(isinstance(k, T.DateType) for k in kinds)
        if not (self.dates or all(isinstance(k, INTEGRAL_TYPES) for k in kinds)):
            return
        ends = [
            df.agg(F.min(column(name)).alias("low"), F.max(column(name)).alias("high")).select(
                *[self._number(F.col(end)).alias(end) for end in ("low", "high")]
            ).first()
            for df, name in zip(sides, keys[0])
        ]
        known = [e for e in ends if e["low"] is not None]
        low, high = (min(e["low"] for e in known), max(e["high"] for e in known)) if known else (0, 0)
        if high - low < 1 << 62:
            self.bounds, self.bits = (low, high), max((high - low).bit_length(), 1)

    def _number(self, key: Column) -> Column:
        return F.unix_date(key).cast("bigint") if self.dates else key.cast("bigint")

    def position(self, side: int) -> Column:
        """Null where the first key is null, if positions are the key's own."""
        if self.bounds:
            return self._number(column(self.keys[0][side])) - F.lit(self.bounds[0])
        # A null has a place of its own, like any value.
        return F.shiftrightunsigned(F.xxhash64(*[column(pair[side]) for pair in self.keys]), 64 - HASH_BITS)

    def within(self, side: int, low: int, high: int) -> Column:
        """A filter on the column itself that keeps positions from low to high, for the scan."""
        name = column(self.keys[0][side])
        first, last = (F.lit(p + self.bounds[0]) for p in (low, high))
        if self.dates:
            first, last = F.date_from_unix_date(first.cast("int")), F.date_from_unix_date(last.cast("int"))
        return name.between(first, last)


def _intervals(ranges: Sequence[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """The ranges, joined over the smallest gaps until few are left."""
    joined: list[list[int]] = []
    for low, high in sorted(ranges):
        if joined and low <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    gaps = sorted((b[0] - a[1], a[1]) for a, b in zip(joined, joined[1:]))
    close = {end for _, end in gaps[: max(len(joined) - most, 0)]}
    out: list[list[int]] = []
    for low, high in joined:
        if out and out[-1][1] in close:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [(low, high) for low, high in out]


def reconcile_tree(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str] | None = None,
    multiset: bool = False,
    tolerance_scale: int | None = None,
    leaf_rows: int = LEAF_ROWS,
    max_ranges: int = MAX_RANGES,
) -> TreeReconciliation:
    """The rows of :func:`reconcile`, with only differing key ranges at full width.

    ``keys`` need not be unique: they decide only where a row belongs. A range
    counts as equal if it holds as many rows on both sides and both 64-bit sums
    over the rows' hashes agree. Rows without a first key are a range of their
    own. Each level reads the ranges left over; cutting ends at ``leaf_rows``, at
    single positions, or when more than ``max_ranges`` differ, as then the tables
    are too different for it to pay. Both sides are read several times, so costly
    frames should be written out first.
    """
    if cols is not None:
        named = resolve(left, keys)
        cols = [*named, *[c for c in resolve(left, cols) if c not in named]]
    pairs = shared_columns(left, right, cols)
    own = list(zip(resolve(left, keys), resolve(right, keys)))
    if not own:
        raise ValueError("no key to place rows by")
    for a, b in own:
        # Different types could hash equal keys to different places.
        if left.schema[a].dataType != right.schema[b].dataType and not isinstance(
            common_type(left.schema[a].dataType, right.schema[b].dataType), INTEGRAL_TYPES
        ):
            raise TypeError(f"{a} has another type on the right; align the tables first")
    sides = (left, right)
    places = _Places(sides, own)
    if not places.bounds and any(left.schema[a].dataType != right.schema[b].dataType for a, b in own):
        raise TypeError("keys placed by hash need the same type on both sides")

    def kept_rows(keep: list[Column]) -> list[DataFrame]:
        return [df.withColumn(POSITION, places.position(side)).filter(keep[side]) for side, df in enumerate(sides)]

    def digests(keep: list[Column], shift: int) -> DataFrame:
        """Ranges with rows, and whether they differ; one narrow row per range, task and side."""
        parts = []
        for sign, rows in zip((1, -1), compared(tuple(kept_rows(keep)), [*pairs, (POSITION, POSITION)], tolerance_scale)):
            plain = rows.drop(POSITION)
            parts.append(
                rows.select(
                    F.shiftright(POSITION, shift).alias("range"), F.lit(sign).cast("bigint").alias("sign"),
                    row_hash(plain, 1).alias("h1"), row_hash(plain, 2).alias("h2"),
                )
            )
        found = parts[0].unionAll(parts[1]).groupBy("range").agg(
            F.sum("sign").alias("n"), F.sum(F.col("h1").cast("decimal(20,0)") * F.col("sign")).alias("s"),
            F.bit_xor("h2").alias("x"), F.count(F.lit(1)).alias("n_rows"),
        )
        return found.select("range", "n_rows", ((F.col("n") != 0) | (F.col("s") != 0) | (F.col("x") != 0)).alias("differs"))

    keep = [F.lit(True), F.lit(True)]
    levels: list[Level] = []
    leaves: list[tuple[int, int]] = []
    null_differs = False
    bits = places.bits
    shift = max(bits - FANOUT_BITS, 0)
    while True:
        found = digests(keep, shift)
        # At most one row more than are held.
        rows = found.filter("differs").orderBy("range").limit(max_ranges + 2).collect()
        differing = {r["range"]: r["n_rows"] for r in rows}
        levels.append(Level(len(differing), sum(differing.values())))
        null_differs |= None in differing
        differing.pop(None, None)
        spans = {r: (r << shift, ((r + 1) << shift) - 1) for r in differing}
        if len(differing) > max_ranges or shift == 0:
            leaves += list(spans.values()) if len(differing) <= max_ranges else [(0, (1 << bits) - 1)]
            break
        open_ranges = {r for r, n in differing.items() if n > leaf_rows}
        leaves += [span for r, span in spans.items() if r not in open_ranges]
        if not open_ranges:
            break
        keep = [_kept(places, side, [spans[r] for r in open_ranges], {shift: open_ranges}, False) for side in (0, 1)]
        shift = max(shift - FANOUT_BITS, 0)

    by_width: dict[int, set[int]] = {}
    for low, high in leaves:
        width = (high - low + 1).bit_length() - 1
        by_width.setdefault(width, set()).add(low >> width)
    keep = [_kept(places, side, leaves, by_width, null_differs) for side in (0, 1)]
    suspects = tuple(df.drop(POSITION) for df in kept_rows(keep))
    found = reconcile(*suspects, cols=[a for a, _ in pairs], multiset=multiset, tolerance_scale=tolerance_scale)
    return TreeReconciliation(found.rows, found.columns, multiset, tuple(levels), suspects)


def _kept(places: _Places, side: int, spans: list[tuple[int, int]], by_width: dict[int, set[int]], nulls: bool) -> Column:
    """Rows whose position is in one of the ranges, given by width in bits and number."""
    null = F.col(POSITION).isNull()
    if not spans:
        return null if nulls else F.lit(False)
    inside = reduce(
        lambda a, b: a | b,
        [F.shiftright(POSITION, width).isin([F.lit(n).cast("bigint") for n in sorted(numbers)]) for width, numbers in by_width.items()],
    )
    if places.bounds:
        near = [places.within(side, low, high) for low, high in _intervals(spans, MAX_INTERVALS)]
        inside = reduce(lambda a, b: a | b, near) & inside
    return inside | null if nulls else inside
