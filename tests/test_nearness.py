from __future__ import annotations

import math
import random
from collections import Counter

import pytest

import movecheck as mc
from tests.conftest import plan_of


def near(a, b, distance):
    if a is None or b is None:
        return a is b
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return a == b or abs(a - b) <= distance


def plain(left, right, distance):
    """Every row against every row."""
    out = Counter()
    for side, own, other in (("only_left", left, right), ("only_right", right, left)):
        for k, v in own:
            if not any(k == j and near(v, w, distance) for j, w in other):
                out[side, k, repr(v)] += 1
    return out


def spark_rows(spark, left, right, distance):
    frames = [spark.createDataFrame(rows, "k string, v double") for rows in (left, right)]
    found = mc.reconcile_within(*frames, "v", distance)
    return Counter({(r["side"], r["k"], repr(r["v"])): r["n_copies"] for r in found.collect()})


@pytest.mark.parametrize("seed,distance", [(1, 0.01), (2, 0.1), (3, 1.0), (4, 0.25)])
def test_equals_comparing_all_pairs(spark, seed, distance):
    rng = random.Random(seed)

    def rows():
        values = [rng.choice([rng.uniform(-4, 4), rng.randint(-40, 40) / 10, rng.randint(-9, 9) * distance]) for _ in range(250)]
        odd = [None, math.nan, math.inf, -math.inf, 0.0, -0.0]
        return [(rng.choice(["a", "b", None]), v) for v in values + rng.sample(odd, 4)] + [("a", 1.5)] * 3

    left, right = rows(), rows()
    assert spark_rows(spark, left, right, distance) == plain(left, right, distance)


def test_rounding_edges_are_near(spark):
    assert not spark_rows(spark, [("k", 1.0049)], [("k", 1.0051)], 0.001)
    assert spark_rows(spark, [("k", 1.0)], [("k", 1.25)], 0.125) == Counter(
        {("only_left", "k", "1.0"): 1, ("only_right", "k", "1.25"): 1}
    )
    assert not spark_rows(spark, [("k", 1.0)], [("k", 1.25)], 0.25)


def test_large_numbers_are_compared_for_equality(spark):
    assert not spark_rows(spark, [("k", 1e300)], [("k", 1e300)], 0.5)
    assert len(spark_rows(spark, [("k", 1e300)], [("k", 2e300)], 0.5)) == 2


def test_copies_empty_sides_and_other_types(spark):
    left = [("a", 1.0)] * 4
    assert spark_rows(spark, left, [], 0.5) == Counter({("only_left", "a", "1.0"): 4})
    assert not spark_rows(spark, [], [], 0.5)
    ints = spark.createDataFrame([(1, 5)], "k int, v int")
    decimals = spark.sql("SELECT 1 AS k, 5.4BD AS v")
    assert mc.reconcile_within(ints, decimals, "v", 0.5).isEmpty()
    assert mc.reconcile_within(ints, decimals, "v", 0.3).count() == 2
    # A column beside those compared, and no other column than the measured one.
    assert mc.reconcile_within(ints.toDF("other", "v"), decimals, "v", 0.5, cols=["v"]).isEmpty()


def test_wrong_arguments(spark):
    rows = spark.createDataFrame([("a", 1.0)], "k string, v double")
    with pytest.raises(ValueError):
        mc.reconcile_within(rows, rows, "v", 0.0)
    with pytest.raises(TypeError):
        mc.reconcile_within(rows, rows, "k", 1.0)


def test_a_crowded_cell_makes_no_pairs(spark):
    left = spark.sql("SELECT id / 1e7 AS v FROM range(30000)")
    right = spark.sql("SELECT id / 1e7 + 1e-8 AS v FROM range(30000)")
    found = mc.reconcile_within(left, right, "v", 1.0)
    assert found.isEmpty()
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
