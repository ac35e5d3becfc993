"""The digest tree against the plain comparison, and how little it moves."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

import movecheck as mc
from movecheck.operators.digest_tree import _intervals, row_hash
from tests.conftest import plan_of, rows

KINDS = "k long, v double, t string, a array<int>"


def pair(seed, n=400, damage=20):
    rng = random.Random(seed)
    left = [(rng.choice([None, rng.randint(-500, 10**6)]) if i % 50 == 0 else i, rng.random(), rng.choice(["x", None, ""]), rng.choice([[1, None], [None, 1], None])) for i in range(n)]
    left += left[:7]
    right = list(left)
    for _ in range(damage):
        i = rng.randrange(len(right))
        change = rng.randrange(4)
        k, v, t, a = right[i]
        if change == 0:
            right[i] = (k, v + 1, t, a)
        elif change == 1:
            right[i] = (k, v, None if t is not None else "x", a)
        elif change == 2:
            right.append(right[i])
        else:
            right.pop(i)
    return left, right


@pytest.mark.parametrize("key", ["k", "t", "d"])
@pytest.mark.parametrize("multiset", [False, True])
def test_rows_of_reconcile(spark, key, multiset):
    frames = []
    for part in pair(3):
        frame = spark.createDataFrame(part, KINDS)
        frames.append(frame.withColumn("d", F.date_from_unix_date((F.col("k") % 3000).cast("int"))))
    found = mc.reconcile_tree(*frames, [key], multiset=multiset, leaf_rows=8, max_ranges=300)
    assert rows(found.rows) == rows(mc.reconcile(*frames, multiset=multiset).rows)
    # Fewer ranges than differ: the plain comparison of everything.
    wide = mc.reconcile_tree(*frames, [key], multiset=multiset, leaf_rows=0, max_ranges=1)
    assert rows(wide.rows) == rows(found.rows)


def test_equal_and_empty_tables(spark):
    frame = spark.createDataFrame(pair(1)[0], KINDS)
    same = mc.reconcile_tree(frame, frame.repartition(3), ["k"])
    assert same.is_empty() and same.levels[-1].n_differing == 0
    assert all(s.isEmpty() for s in same.suspects)
    assert mc.reconcile_tree(frame, frame.limit(0), ["k"]).rows.count() == frame.distinct().count()
    assert mc.reconcile_tree(frame.limit(0), frame.limit(0), ["k"]).is_empty()


def test_only_differing_ranges_are_compared(spark, tmp_path):
    """One damaged run of keys: that run alone is read at full width, by a filter that reaches the scan."""
    spark.range(200_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("t")).write.parquet(str(tmp_path / "l"))
    left = spark.read.parquet(str(tmp_path / "l"))
    left.withColumn("t", F.when(F.col("k").between(70_000, 70_050), "x").otherwise(F.col("t"))).write.parquet(str(tmp_path / "r"))
    right = spark.read.parquet(str(tmp_path / "r"))
    found = mc.reconcile_tree(left, right, ["k"], leaf_rows=200)
    assert found.rows.count() == 102
    assert [level.rows_left for level in found.levels][0] < 30_000
    assert all(s.count() < 400 for s in found.suspects)
    plan = plan_of(found.rows)
    assert plan.count("GreaterThanOrEqual(k,6") + plan.count("GreaterThanOrEqual(k,7") >= 2


def test_types_and_spelling(spark):
    left = spark.createDataFrame([(1, 2.0), (5, None)], "K int, v double")
    right = spark.createDataFrame([(2.0, 1), (None, 6)], "V double, k long")
    assert rows(mc.reconcile_tree(left, right, ["k"]).rows) == rows(mc.reconcile(left, right).rows)
    with pytest.raises(TypeError):
        mc.reconcile_tree(left, right.withColumn("k", F.col("k").cast("string")), ["k"])
    with pytest.raises(ValueError):
        mc.reconcile_tree(left, right, [])


def test_hash_tells_nulls_apart(spark):
    frame = spark.createDataFrame([(None, 1, [None, 1]), (1, None, [None, 1]), (1, None, [1, None])], "a int, b int, c array<int>")
    assert frame.select(row_hash(frame, 1)).distinct().count() == 3


def test_intervals():
    assert _intervals([(5, 6), (0, 1), (2, 3), (100, 101), (9, 9)], 2) == [(0, 9), (100, 101)]
    assert _intervals([(0, 1), (4, 5)], 5) == [(0, 1), (4, 5)]
