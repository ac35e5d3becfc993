"""Partners of changed rows where the tables have no key.

Only the difference of the two tables is looked at. Its rows are blocked on
subsets of the columns: all but one, then all but two, and so on. Within a block
the rows of each side stand in a fixed order, and the i-th of one side is
proposed to the i-th of the other. So a block proposes as many pairs as its
smaller side has rows, never all pairs. A row prefers the proposal whose
left-out columns come first; proposals that both rows prefer become pairs, and
the others are proposed anew among the rows still free. The first column set
with a proposal is preferred by both of its rows, so there are no more rounds
than column sets; in practice there are two or three.

Disk stays in proportion to the tables: what is saved is removed when it is done
with, shuffle files go when their step ends, and large steps take their rows in
``PASSES`` passes, by hash, so that a part of them is shuffled at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.names import column
from movecheck.operators.reconcile import CHANGED, ONLY_LEFT, ONLY_RIGHT, SIDE, compared, reconcile, shared_columns
from movecheck.sources.sinks import discard, saved_in_turn, short_lived_shuffles

MAX_CHANGED = 2
# Passes over tables of more bytes and frames of more rows than these.
PASSES = 4
PASS_BYTES = 32 << 20
PASS_ROWS = 1 << 20
# Rows of a block from which on its places are counted per slot.
HOT_BLOCK = 100_000
# Columns whose differences fit into a number.
MASK_BITS = 62
# First bits of a row's order mark that cut a block into slots.
SLOT_BITS = 12
# Types of which hashes do not see all.
NESTED = (T.ArrayType, T.MapType, T.StructType)
# Steps of a plan that give the same rows each time they are run.
REPEATABLE = {"Project", "Filter", "Union", "LogicalRelation"}


def _parts(value: Column, dtype: T.DataType) -> list[Column]:
    """What tells a column's values apart, for hashes: these pass over nulls, also nested ones."""
    if isinstance(dtype, NESTED):
        value = F.to_json(F.struct(value.alias("v")))
    return [value, value.isNull()]


def _repeatable(df: DataFrame) -> bool:
    """Whether the frame is read from files, row by row, so that it can be read anew."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    if not todo[0].deterministic():
        return False
    while todo:
        plan = todo.pop()
        if plan.nodeName() not in REPEATABLE:
            return False
        todo += [plan.children().apply(i) for i in range(plan.children().size())]
    return True


def _size(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _shares(left: DataFrame, right: DataFrame, cols: Sequence[str] | None, tolerance_scale: int | None):
    """Parts of both tables that are compared by themselves: equal rows are in the same part."""
    if _size(left) + _size(right) <= PASS_BYTES or not (_repeatable(left) and _repeatable(right)):
        return [(left, right, cols)]
    sides = compared((left, right), shared_columns(left, right, cols), tolerance_scale)
    # Texts may be equal by their collation and have different hashes.
    plain = [f.name for f in sides[0].schema if not isinstance(f.dataType, (*NESTED, T.StringType))]
    if not plain:
        return [(left, right, cols)]
    turn = F.pmod(F.xxhash64(*map(column, plain)), F.lit(PASSES))
    return [(*(side.filter(turn == p) for side in sides), None) for p in range(PASSES)]


def _difference(
    left: DataFrame, right: DataFrame, cols: Sequence[str] | None, tolerance_scale: int | None, used: list[str] | None = None
):
    """The rows in excess on either side, with ids. ``used`` gets the folder they are read from."""
    shares = _shares(left, right, cols, tolerance_scale)
    found = [reconcile(*share, multiset=True, tolerance_scale=tolerance_scale) for share in shares]
    names = list(found[0].columns)
    rows = [
        part.expanded().select(
            (F.monotonically_increasing_id() * len(shares) + p).alias("id"),
            (F.col(SIDE) == ONLY_LEFT).alias("on_left"),
            F.struct(*[column(n) for n in names]).alias("row"),
        )
        for p, part in enumerate(found)
    ]
    difference, path = saved_in_turn(rows, "pairing")
    if used is not None:
        used.append(path)
    return difference, names


def _passes(rows: DataFrame) -> int:
    return PASSES if rows.count() > PASS_ROWS else 1


def _in_passes(n: int, label: str, frame: Callable[[Callable[[Column], Column]], DataFrame]) -> tuple[DataFrame, str]:
    """(the rows that ``frame`` gives for all passes, their folder); it gets a filter by a number."""
    return saved_in_turn((frame(lambda number, p=p: F.pmod(number, F.lit(n)) == p) for p in range(n)), label)


def _hashed(rows: DataFrame) -> DataFrame:
    """Two 64-bit hashes of each column in place of the row, and a mark by which rows are ordered."""
    parts = [_parts(F.col("row").getField(f.name), f.dataType) for f in rows.schema["row"].dataType]
    hashes = (F.array(*[F.xxhash64(F.lit(salt), *p) for p in parts]).alias(name) for salt, name in enumerate("ab"))
    return rows.select(*[c for c in rows.columns if c != "row"], *hashes).withColumn("mark", F.xxhash64("a", "b"))


def _hash(name: str, no: int, places: Sequence[int]) -> Column:
    return F.xxhash64(F.lit(no), *[F.element_at(name, i + 1) for i in places])


def _segment_hash(rows: DataFrame, j: int, places: Sequence[int]) -> Column:
    fields = rows.schema["row"].dataType.fields
    return F.xxhash64(F.lit(j), *[p for i in places for p in _parts(F.col("row").getField(fields[i].name), fields[i].dataType)])


def _two_sided(rows: DataFrame, key: str) -> DataFrame:
    """The rows of those blocks that have rows of both sides."""
    both = rows.groupBy(key).agg(F.min("on_left").alias("least"), F.max("on_left").alias("most"))
    return rows.join(both.filter("least != most").select(key), key, "left_semi")


def _segments(hashed: DataFrame, n_columns: int, n: int) -> list[list[int]]:
    """The columns dealt to segments by their numbers of values, the most telling segment first.

    The numbers are estimates; they decide about the work, not about the result.
    """
    found = hashed.agg(*[F.approx_count_distinct(F.element_at("a", i + 1), 0.1).alias(f"c{i}") for i in range(n_columns)]).first()
    order = sorted(range(n_columns), key=lambda i: -found[f"c{i}"])
    segments: list[list[int]] = [[] for _ in range(n)]
    for at, i in enumerate(order):
        turn, place = divmod(at, n)
        segments[n - 1 - place if turn % 2 else place].append(i)
    return sorted(segments, key=lambda s: -math.prod(max(found[f"c{i}"], 1) for i in s))


def _in_sets(alive: DataFrame, sets: dict[int, list[int]]) -> DataFrame:
    """The rows in each of the column sets, as far as their blocks there have both sides."""
    made = F.array(*[
        F.struct(F.lit(no).alias("no"), _hash("a", no, places).alias("block"), _hash("b", no, places).alias("other"))
        for no, places in sets.items()
    ])
    rows = _hashed(alive).select("id", "on_left", "mark", F.explode(made).alias("s"))
    return _two_sided(rows.select("id", "on_left", "mark", "s.*"), "block")


def _of_pairs(alive: DataFrame, sets: dict[int, list[int]], level: int) -> DataFrame:
    """The same by pairs of rows of both sides: a row is in the sets that hold no column in which a pair differs."""
    left, right = (
        alive.filter(F.col("on_left") == side).select("h", F.col("id").alias(name), F.col("row").alias(f"{name}_row"))
        for side, name in ((True, "left"), (False, "right"))
    )
    fields = alive.schema["row"].dataType
    mask = F.lit(0).cast("long")
    for i, f in enumerate(fields):
        own, other = (_parts(F.col(f"{side}_row").getField(f.name), f.dataType)[0] for side in ("left", "right"))
        mask = mask.bitwiseOR(F.when(own.eqNullSafe(other), 0).otherwise(1 << i).cast("long"))
    pairs = left.join(right, "h").withColumn("differs", mask).filter(F.bit_count("differs") <= level)
    rows = pairs.select("differs", F.inline(F.array(*[
        F.struct(F.col(side).alias("id"), F.lit(side == "left").alias("on_left"), F.col(f"{side}_row").alias("row")) for side in ("left", "right")
    ])))
    made = F.array(*[
        F.when(F.col("differs").bitwiseAND(F.lit(sum(1 << i for i in places)).cast("long")) == 0, F.struct(
            F.lit(no).alias("no"), _hash("a", no, places).alias("block"), _hash("b", no, places).alias("other"),
        ))
        for no, places in sets.items()
    ])
    found = _hashed(rows).select("id", "on_left", "mark", F.explode(F.array_compact(made)).alias("s"))
    return found.select("id", "on_left", "mark", "s.*").dropDuplicates(["id", "no"])


def _blocks(free: DataFrame, n_columns: int, level: int, used: list[str] | None = None) -> DataFrame:
    """Rows of two-sided blocks: one row per free row and column set, with the set's number.

    Of ``level + 1`` segments of the columns, ``level`` columns leave out one at
    least. So a column set holds a whole segment, and a row stands in a two-sided
    block of the set only if it does so in the segment's. Rows are looked up in
    one segment after the other. Where a segment's block has fewer pairs than its
    rows have column sets, the pairs tell the sets that hold both; only rows of
    other blocks are looked up in every set. ``used`` gets the folder read from.
    """
    kept = [[i for i in range(n_columns) if i not in out] for out in combinations(range(n_columns), level)]
    segments = _segments(_hashed(free), n_columns, level + 1)
    segment_of = [next(j for j, s in enumerate(segments) if set(s) <= set(places)) for places in kept]
    n = _passes(free)

    def found() -> Iterator[DataFrame]:
        for j, segment in enumerate(segments):
            sets = {no: places for no, places in enumerate(kept) if segment_of[no] == j}
            for p in range(n if sets else 0):
                rows = free.withColumn("h", _segment_hash(free, j, segment)).filter(F.pmod("h", F.lit(n)) == p)
                counts = rows.groupBy("h").agg(F.count_if("on_left").alias("n_left"), F.count_if(~F.col("on_left")).alias("n_right"))
                alive, path = saved_in_turn([rows.join(counts.filter("n_left > 0 and n_right > 0"), "h")], "alive")
                n_left, n_right = F.col("n_left"), F.col("n_right")
                few = (n_left * n_right <= (n_left + n_right) * len(sets)) if n_columns <= MASK_BITS else F.lit(False)
                yield _of_pairs(alive.filter(few), sets, level)
                many = alive.filter(~few)
                if not many.isEmpty():
                    yield _in_sets(many, sets)
                discard(free.sparkSession, [path])

    blocks, path = saved_in_turn(found(), "blocks")
    if used is not None:
        used.append(path)
    return blocks


def _hot_proposals(blocks: DataFrame) -> DataFrame:
    """The proposals of blocks that are no one task's work.

    Places in a block are counted per slot first and then within a slot.
    """
    rows = blocks.withColumn("slot", F.shiftright("mark", 64 - SLOT_BITS))
    own = ["no", "block", "other", "on_left"]
    slots = rows.groupBy(*own, "slot").agg(F.count("*").alias("n"))
    block = Window.partitionBy("no", "block", "other")
    before = Window.partitionBy(*own).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = (
        slots.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("both", F.min("on_left").over(block) != F.max("on_left").over(block))
        .filter("both").select(*own, "slot", "offset")
    )
    inner = Window.partitionBy(*own, "slot").orderBy("mark", "id")
    ranked = rows.join(slots, [*own, "slot"]).withColumn("place", F.col("offset") + F.row_number().over(inner))
    lefts, rights = (
        ranked.filter(F.col("on_left") == side).select("no", "block", "other", "place", F.col("id").alias(name))
        for side, name in ((True, "left"), (False, "right"))
    )
    return lefts.join(rights, ["no", "block", "other", "place"]).select("no", "left", "right")


def _proposals(blocks: DataFrame) -> DataFrame:
    """(no, left, right) for the i-th rows of both sides of every block.

    The rows of a block are shuffled once, to one task, unless they are many.
    """
    keys = ["no", "block", "other"]
    hot = blocks.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") >= HOT_BLOCK).select(*keys)
    rest, more = blocks, None
    if blocks.count() >= HOT_BLOCK and not hot.isEmpty():
        rest, more = blocks.join(hot, keys, "left_anti"), _hot_proposals(blocks.join(hot, keys, "left_semi"))
    place = F.row_number().over(Window.partitionBy(*keys, "on_left").orderBy("mark", "id"))
    ranked = rest.repartition(*keys).withColumn("place", place)
    sides = [F.max(F.when(F.col("on_left") == side, F.col("id"))).alias(name) for side, name in ((True, "left"), (False, "right"))]
    found = ranked.groupBy(*keys, "place").agg(*sides).filter("left is not null and right is not null").select("no", "left", "right")
    return found if more is None else found.unionAll(more)


def _agreed(proposals: DataFrame) -> DataFrame:
    """Proposals that both rows like best."""
    best = [F.min("no").over(Window.partitionBy(side)) for side in ("left", "right")]
    chosen = proposals.select("*", best[0].alias("of_left"), best[1].alias("of_right"))
    return chosen.filter("no = of_left and no = of_right").select("left", "right")


def pair_changed_rows(
    left: DataFrame,
    right: DataFrame,
    cols: Sequence[str] | None = None,
    max_changed: int = MAX_CHANGED,
    tolerance_scale: int | None = None,
) -> DataFrame:
    """Rows that differ between the tables, changed ones with their partner.

    Columns pair up by name and are compared as by :func:`reconcile`, copies
    counted; nulls equal nulls. Rows in excess become partners if they differ in
    at most ``max_changed`` columns, each row once. Pairs with fewer changed
    columns go first; afterwards no two rows left over differ in so few columns.
    Among several possible partners the earlier left-out columns decide, then the
    order of the rows' digests, so results do not depend on how rows are spread.

    Returns status (``changed``, ``only_left``, ``only_right``), changed (names
    of the changed columns, null for rows without a partner), left and right
    (structs of the compared columns, null for the side that lacks the row).

    Work grows with the difference, and for rows that agree in a whole segment of the
    columns with rows of the other side with the number of column sets as well,
    ``C(columns, max_changed)`` at the last level.
    """
    spark = left.sparkSession
    with short_lived_shuffles(spark):
        return _paired(spark, left, right, cols, max_changed, tolerance_scale)


def _paired(
    spark: SparkSession, left: DataFrame, right: DataFrame, cols: Sequence[str] | None, max_changed: int, tolerance_scale: int | None
) -> DataFrame:
    of_rows: list[str] = []
    rows, names = _difference(left, right, cols, tolerance_scale, of_rows)
    if not 0 < max_changed < max(len(names), 2):
        raise ValueError("max_changed must be at least 1 and less than the number of columns")
    n = _passes(rows)
    free, free_path = rows, None
    pairs: DataFrame | None = None
    for level in range(1, max_changed + 1 if len(names) > 1 else 1):
        used: list[str] = []
        blocks, taken = _blocks(free, len(names), level, used), None
        while True:
            proposals, path = saved_in_turn([_proposals(blocks)], "proposals")
            used.append(path)
            if proposals.isEmpty():
                break
            agreed, _ = saved_in_turn([_agreed(proposals)], "pairs")
            pairs = agreed if pairs is None else pairs.unionAll(agreed)
            ids = agreed.select(F.explode(F.array("left", "right")).alias("id"))
            taken = ids if taken is None else taken.unionAll(ids)
            # Free rows only become fewer, so no other block ever gets both sides.
            blocks, path = saved_in_turn([_two_sided(blocks.join(ids, "id", "left_anti"), "block")], "blocks")
            discard(spark, used)
            used = [path]
        discard(spark, used)
        if taken is not None:
            before, before_path = free, free_path
            free, free_path = _in_passes(n, "free", lambda chosen: before.filter(chosen(F.col("id"))).join(
                taken.filter(chosen(F.col("id"))), "id", "left_anti"))
            discard(spark, [before_path] if before_path else [])
    alone = free.select(
        F.when(F.col("on_left"), ONLY_LEFT).otherwise(ONLY_RIGHT).alias("status"),
        F.lit(None).cast("array<string>").alias("changed"),
        F.when(F.col("on_left"), F.col("row")).alias("left"),
        F.when(~F.col("on_left"), F.col("row")).alias("right"),
    )
    if pairs is None:
        return alone
    matched, used = pairs, []
    for side, on_left in (("left", True), ("right", False)):
        own = rows.filter(F.col("on_left") == on_left).select(F.col("id").alias(side), F.col("row").alias(f"{side}_row"))
        chosen_pairs = matched
        matched, path = _in_passes(n, "matched", lambda chosen: chosen_pairs.filter(chosen(F.col(side))).join(own.filter(chosen(F.col(side))), side))
        discard(spark, used)
        used = [path]
    discard(spark, of_rows)
    changes = []
    for f in rows.schema["row"].dataType:
        # A value by itself, or as the hashes see it.
        own, other = (_parts(F.col(f"{side}_row").getField(f.name), f.dataType)[0] for side in ("left", "right"))
        changes.append(F.when(~own.eqNullSafe(other), F.lit(f.name)))
    differs = F.array_compact(F.array(*changes))
    changed = matched.select(
        F.lit(CHANGED).alias("status"), differs.alias("changed"),
        F.col("left_row").alias("left"), F.col("right_row").alias("right"),
    )
    return changed.unionAll(alone)
