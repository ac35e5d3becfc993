from __future__ import annotations

import random
from collections import Counter

import pytest

import movecheck as mc
from tests.conftest import rows

SCHEMA = "a string, b int, c double, d string"


def differences(x, y):
    return sum(1 for a, b in zip(x, y) if a != b)


def checked(left, right, found, max_changed, width=4):
    """What must hold of any result: nothing lost, each row once, levels right, no pair missed."""
    pairs = [(tuple(r["left"]), tuple(r["right"]), r["changed"]) for r in found if r["status"] == "changed"]
    lefts = [tuple(r["left"]) for r in found if r["status"] == "only_left"]
    rights = [tuple(r["right"]) for r in found if r["status"] == "only_right"]
    assert Counter(lefts + [p[0] for p in pairs]) == Counter(left) - Counter(right)
    assert Counter(rights + [p[1] for p in pairs]) == Counter(right) - Counter(left)
    for x, y, changed in pairs:
        assert [n for n, a, b in zip("abcd", x, y) if a != b] == changed and 0 < len(changed) <= max_changed
    assert all(differences(x, y) > max_changed for x in lefts for y in rights)
    # Fewer changes first: a row in a pair with n changes has no free partner nearer than n,
    # and no two such pairs hide a nearer one.
    for x, y, changed in pairs:
        assert all(differences(x, other) >= len(changed) for other in rights)
        assert all(differences(other, y) >= len(changed) for other in lefts)
    for x, _, c1 in pairs:
        for _, y, c2 in pairs:
            assert differences(x, y) == 0 or differences(x, y) >= min(len(c1), len(c2))
    return pairs, lefts, rights


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)

    def row():
        return (rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice([0.5, 1.5]), str(rng.randint(0, 8)))

    left = [row() for _ in range(60)]
    right = [row() for _ in range(50)] + left[:10]
    for max_changed in (1, 2):
        got = mc.pair_changed_rows(
            spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), max_changed=max_changed
        ).collect()
        pairs, _, _ = checked(left, right, got, max_changed)
        assert pairs


def test_result_does_not_depend_on_partitions(spark):
    rng = random.Random(7)
    left = [(rng.choice("xy"), rng.randint(0, 3), 1.0, str(rng.randint(0, 20))) for _ in range(80)]
    right = [(a, b + rng.randint(0, 1), c, d) for a, b, c, d in left]
    one, two = (
        rows(mc.pair_changed_rows(
            spark.createDataFrame(left, SCHEMA).repartition(n), spark.createDataFrame(right, SCHEMA).repartition(n + 1)
        ))
        for n in (1, 5)
    )
    assert one == two


def test_hot_block_gives_as_many_pairs_as_rows(spark):
    left = spark.range(3000).selectExpr("'k' as a", "1 as b", "1.0D as c", "cast(id as string) as d")
    right = spark.range(3000).selectExpr("'k' as a", "1 as b", "1.0D as c", "concat('n', id) as d")
    found = mc.pair_changed_rows(left, right)
    assert found.filter("status = 'changed' and changed = array('d')").count() == 3000 == found.count()
    assert found.select("left").distinct().count() == found.select("right").distinct().count() == 3000


def test_copies_nulls_equal_and_empty_tables(spark):
    left = spark.createDataFrame([("x", None, None, "1")] * 5, SCHEMA)
    right = spark.createDataFrame([("x", None, None, "1")] * 2 + [("x", 4, None, "1")] * 2, SCHEMA)
    got = Counter((r["status"], tuple(r["changed"] or ())) for r in mc.pair_changed_rows(left, right).collect())
    assert got == {("changed", ("b",)): 2, ("only_left", ()): 1}
    assert mc.pair_changed_rows(left, left).count() == 0
    none = left.limit(0)
    assert mc.pair_changed_rows(none, none).count() == 0
    assert Counter(r["status"] for r in mc.pair_changed_rows(none, right).collect()) == {"only_right": 4}


def test_clashing_names_and_one_column(spark):
    left = spark.createDataFrame([(1, 2, "p"), (3, 4, "q")], "id int, mark int, left string")
    right = spark.createDataFrame([(1, 2, "r"), (3, 4, "q")], "id int, mark int, left string")
    (row,) = mc.pair_changed_rows(left, right).collect()
    assert row["changed"] == ["left"] and row["left"]["left"] == "p" and row["right"]["left"] == "r"
    single = mc.pair_changed_rows(left.select("id"), spark.createDataFrame([(9,)], "id int"), max_changed=1)
    assert Counter(r["status"] for r in single.collect()) == {"only_left": 2, "only_right": 1}
    with pytest.raises(ValueError, match="max_changed"):
        mc.pair_changed_rows(left, right, max_changed=3)
