"""Mixing sources to target weights in a domain-language-source tree.

Weights go down the tree: a node's budget is shared among its children in
proportion to their weights, but no child gets more than its supply (the tokens
below it times the allowed epochs). What a short child cannot take goes to its
siblings first, and a parent only passes up what all its children together lack,
since its own supply is theirs. A leaf's budget is then spent on whole epochs
and, for the rest, on a prefix of one more epoch in that epoch's seeded order;
the document at the end of the prefix is taken in part.

All shares are whole tokens and add up exactly. The order within a leaf is never
sorted as a whole: tokens are summed per slot of the order (the first digits of
a hash), and the slot that holds the prefix's end is found from these sums. It is
cut into finer slots in the same way, twice, and only the rows of the last one,
a 16-millionth of the leaf, are ordered. No task gets more than 256 sums of a
leaf at a time. A source with a third of all rows is no special case.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from movecheck.sources.sinks import saved

LEVELS = ("domain", "lang", "source")
# Hash digits by which slots are cut, and how often.
SLOT_DIGITS, CUTS = 2, 3
# Fixed value: the six white-space characters.
SPACES = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none if it is null."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).otherwise(0).cast("long")


def weight_of(name: Column, weights: Mapping[str, int]) -> Column:
    """The weight given to a name, 1 for all others."""
    found = F.lit(1)
    for key, weight in weights.items():
        found = F.when(name == key, F.lit(int(weight))).otherwise(found)
    return found.cast("long")


def _big(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _share(children: DataFrame, parents: list[str]) -> DataFrame:
    """Share ``budget`` among the rows with equal parents; adds ``given``.

    Children fill up in the order of supply over weight. Those before the first
    that does not fill get their supply, the others their share of what is left,
    rounded along the running sum so that the shares add up.
    """
    name = LEVELS[len(parents)]
    whole = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = whole.orderBy(F.col("supply") / F.col("weight"), "weight", name)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    children = children.filter("weight > 0").withColumns(
        {
            "filled_before": F.sum("supply").over(so_far) - F.col("supply"),
            "weight_left": F.sum("weight").over(whole) - F.sum("weight").over(so_far) + F.col("weight"),
            "place": F.row_number().over(order),
        }
    )
    left = F.col("budget") - F.col("filled_before")
    fills = _big(F.col("supply")) * _big(F.col("weight_left")) <= _big(F.col("weight")) * _big(left)
    children = children.withColumn("stop", F.min(F.when(~fills, F.col("place"))).over(whole))
    open_here = F.col("place") >= F.col("stop")
    at_stop = F.col("place") == F.col("stop")
    children = children.withColumns(
        {
            "rest": F.max(F.when(at_stop, left)).over(whole),
            "open_weight": F.max(F.when(at_stop, F.col("weight_left"))).over(whole),
            "upto": F.sum(F.when(open_here, F.col("weight"))).over(so_far),
        }
    )

    def part(weight: Column) -> Column:
        return F.floor(_big(F.col("rest")) * _big(weight) / _big(F.col("open_weight"))).cast("long")

    share = part(F.col("upto")) - part(F.col("upto") - F.col("weight"))
    given = F.when(open_here, share).otherwise(F.col("supply"))
    return children.withColumn("given", given).drop(
        "filled_before", "weight_left", "place", "stop", "rest", "open_weight", "upto"
    )


def leaf_budgets(
    supplies: DataFrame,
    weights: Mapping[str, Mapping[str, int]],
    budget: Column,
    max_epochs: int,
) -> DataFrame:
    """domain, lang, source, tokens, given: the budget of every leaf.

    ``supplies`` has tokens per leaf, ``budget`` is an expression over ``total``,
    the tokens of all leaves, left out or not.
    """
    # What a weight of 0 leaves out on any level is no supply of what is above it.
    open_ones = supplies
    for level in LEVELS:
        open_ones = open_ones.filter(weight_of(F.col(level), weights.get(level, {})) > 0)
    leaves = open_ones.withColumn("supply", F.col("tokens") * max_epochs)
    most = leaves.agg(F.sum("supply").alias("most"))
    total = supplies.agg(F.sum("tokens").alias("total")).join(most, F.lit(True))
    given = total.select(F.least(F.floor(budget).cast("long"), F.col("most")).alias("given"))
    parents: list[str] = []
    for level in LEVELS:
        keys = [*parents, level]
        own = leaves.groupBy(*keys).agg(F.sum("supply").alias("supply"), F.sum("tokens").alias("tokens"))
        own = own.withColumn("weight", weight_of(F.col(level), weights.get(level, {})))
        if parents:
            above = given.select(*[F.col(p).alias(f"above_{p}") for p in parents], F.col("given").alias("budget"))
            match = reduce(lambda a, b: a & b, [own[p].eqNullSafe(above[f"above_{p}"]) for p in parents])
            own = own.join(above, match).drop(*[f"above_{p}" for p in parents])
        else:
            # One row, the total.
            own = own.join(given.withColumnRenamed("given", "budget"), F.lit(True))
        given = _share(own, parents)
        parents = keys
    return given.select(*LEVELS, "tokens", "given")


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]],
    budget: Column,
    max_epochs: int = 1,
    seed: int = 1,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Choose documents so that tokens meet the weights.

    ``docs`` has doc_id, text, domain, lang and source; ``weights`` maps
    "domain", "lang" and "source" to whole weights by name (1 for other names,
    0 to leave out); ``budget`` is an expression over ``total``, the corpus's
    tokens (words). Returns, for every chosen document: doc_id, domain, lang,
    source, n_tokens, copies (whole epochs) and n_partial (tokens taken from its
    beginning in one more epoch).

    Null and empty texts have no tokens and are not chosen. A null domain,
    language or source is a name of its own, with weight 1. Rows with equal
    doc_id are chosen one by one. If the supply is short, all of it is taken.
    The ``carried`` columns of docs come along, after source; with doc_id they
    decide a document's place in the seeded order, so a row key among them
    spreads rows without an id.
    """
    taken = ["doc_id", *LEVELS, *carried]
    counted = docs.select(*taken, word_count(F.col("text")).alias("n_tokens"))
    counted = saved(counted.filter("n_tokens > 0"), "mixing")
    supplies = counted.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    plan = leaf_budgets(supplies, weights, budget, max_epochs)
    epochs = F.floor(F.col("given") / F.col("tokens")).cast("long")
    plan = saved(plan.select(*LEVELS, epochs.alias("copies"), (F.col("given") % F.col("tokens")).alias("rest")), "mixing")
    rows = _with_leaf(counted, plan)
    own = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", *carried)]
    named = F.concat_ws(":", F.lit(str(seed)), F.col("copies"), *own)
    rows = rows.withColumn("mark", F.md5(named.cast("binary")))
    ends = _ends(rows)
    rows = rows.withColumn("slot", F.substring("mark", 1, SLOT_DIGITS * CUTS))
    placed = _with_leaf(rows, ends, "left")
    inside = placed.filter("slot < end_slot").select(*taken, "n_tokens", "copies", F.col("n_tokens").alias("n_partial"))
    outside = placed.filter("copies > 0 and (end_slot is null or slot > end_slot)").select(
        *taken, "n_tokens", "copies", F.lit(0).cast("long").alias("n_partial")
    )
    order = Window.partitionBy(*LEVELS).orderBy("mark", "n_tokens", *carried).rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("before") + F.sum("n_tokens").over(order) - F.col("n_tokens")
    edge = (
        placed.filter("slot = end_slot")
        .withColumn("n_partial", F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("rest") - start)))
        .filter("n_partial > 0 or copies > 0")
        .select(*taken, "n_tokens", "copies", F.col("n_partial").cast("long").alias("n_partial"))
    )
    return inside.unionByName(outside).unionByName(edge)


def _ends(rows: DataFrame) -> DataFrame:
    """Per leaf whose prefix is not empty: the slot that holds its end, and the tokens before it."""
    ends = None
    for cut in range(1, CUTS + 1):
        inside = rows.withColumn("slot", F.substring("mark", 1, SLOT_DIGITS * cut))
        if ends is None:
            inside = inside.withColumn("before", F.lit(0).cast("long"))
        else:
            own = F.substring("mark", 1, SLOT_DIGITS * (cut - 1)) == F.col("end_slot")
            inside = _with_leaf(inside, ends).filter(own)
        slots = inside.groupBy(*LEVELS, "slot").agg(
            F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"), F.max("before").alias("before")
        )
        upto = F.col("before") + F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("slot"))
        ends = (
            slots.withColumn("upto", upto)
            .filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest")))
            .select(*LEVELS, F.col("slot").alias("end_slot"), (F.col("upto") - F.col("n")).alias("before"))
        )
        ends = saved(ends, "mixing")
    return ends


def _with_leaf(rows: DataFrame, leaves: DataFrame, how: str = "inner") -> DataFrame:
    """Columns of each row's leaf; null names match null names."""
    renamed = leaves.select(*[F.col(c).alias(f"leaf_{c}") if c in LEVELS else F.col(c) for c in leaves.columns])
    match = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(renamed[f"leaf_{c}"]) for c in LEVELS])
    return rows.join(renamed, match, how).drop(*[f"leaf_{c}" for c in LEVELS])
