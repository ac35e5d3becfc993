from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import movecheck as mc
from movecheck.operators import reconcile as module
from tests.conftest import plan_of, rows


def counts(found):
    return {r.side: r.n_rows for r in found.counts().collect()}


LEFT = [(1, None), (1, None), (2, "b"), (3, "c"), (3, "c")]
RIGHT = [(1, None), (3, "c"), (4, "d")]


@pytest.fixture(scope="module")
def pair(spark):
    return spark.createDataFrame(LEFT, "k int, v string"), spark.createDataFrame(RIGHT, "k int, v string")


def test_sets_and_bags(pair):
    left, right = pair
    assert rows(mc.reconcile(left, right).rows) == [("only_left", 2, "b"), ("only_right", 4, "d")]
    bag = mc.reconcile(left, right, multiset=True)
    assert rows(bag.rows) == sorted(
        [("only_left", 1, None, 1), ("only_left", 2, "b", 1), ("only_left", 3, "c", 1), ("only_right", 4, "d", 1)],
        key=repr,
    )
    assert counts(mc.reconcile(left, right)) == {"only_left": 1, "only_right": 1}
    assert counts(bag) == {"only_left": 3, "only_right": 1}


def test_bag_rows_agree_with_except_all(spark, pair, monkeypatch):
    monkeypatch.setattr(module, "COPIES_PER_TASK", 4)
    left = pair[0].unionAll(spark.range(13).select(F.lit(9).alias("k"), F.lit("hot").alias("v")))
    found = mc.reconcile(left, pair[1], multiset=True).expanded()
    a, b = Counter(map(tuple, left.collect())), Counter(map(tuple, pair[1].collect()))
    wanted = [("only_left", *r) for r in (a - b).elements()] + [("only_right", *r) for r in (b - a).elements()]
    assert rows(found) == sorted(wanted, key=repr)


def test_random_bags_against_brute_force(spark):
    chance = random.Random(11)

    def some_rows(n):
        words = [None, "", "a", "b", "\xe9"]
        return [(chance.choice([None, 0, 1, 2]), chance.choice(words), chance.choice([None, 0.5, 1.0])) for _ in range(n)]

    ddl = "a int, b string, c double"
    left, right = some_rows(300), some_rows(280)
    frames = [spark.createDataFrame(r, ddl) for r in (left, right)]
    a, b = Counter(left), Counter(right)
    bag = [("only_left", *r, n) for r, n in (a - b).items()] + [("only_right", *r, n) for r, n in (b - a).items()]
    one_sided = [("only_left", *r) for r in a.keys() - b.keys()] + [("only_right", *r) for r in b.keys() - a.keys()]
    assert rows(mc.reconcile(*frames, multiset=True).rows) == sorted(bag, key=repr)
    assert rows(mc.reconcile(*frames).rows) == sorted(one_sided, key=repr)
    assert counts(mc.reconcile(*frames, multiset=True)) == {"only_left": (a - b).total(), "only_right": (b - a).total()}


def test_metamorphic(pair):
    left, right = pair
    for multiset in (False, True):
        assert mc.reconcile(left, left, multiset=multiset).is_empty()
        there = counts(mc.reconcile(left, right, multiset=multiset))
        back = counts(mc.reconcile(right, left, multiset=multiset))
        assert there == {"only_left": back["only_right"], "only_right": back["only_left"]}


def test_columns_pair_by_name_and_widen(spark):
    left = spark.createDataFrame([(1, "x", 0.5)], "a int, B string, c float")
    right = spark.createDataFrame([(0.5, "x", 1)], "C double, b string, A bigint")
    assert mc.reconcile(left, right).is_empty()


def test_different_columns_are_refused(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    right = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="b"):
        mc.reconcile(left, right)
    assert mc.reconcile(left, right, ["A"]).is_empty()
    with pytest.raises(ValueError, match="side"):
        mc.reconcile(left.toDF("a", "Side"), left.toDF("a", "Side"))
    with pytest.raises(ValueError, match="n_rows"):
        mc.reconcile(left.toDF("a", "n_rows"), left.toDF("a", "n_rows")).report()


def test_float_edges(spark):
    left = spark.createDataFrame([(math.nan,), (-0.0,)], "x double")
    right = spark.createDataFrame([(math.nan,), (0.0,)], "x double")
    assert mc.reconcile(left, right).is_empty()
    narrow, wide = spark.createDataFrame([(0.1,)], "x float"), spark.createDataFrame([(0.1,)], "x double")
    assert counts(mc.reconcile(narrow, wide)) == {"only_left": 1, "only_right": 1}
    assert mc.reconcile(narrow, wide, tolerance_scale=6).is_empty()
    arrays = [spark.createDataFrame([([0.1],)], f"x array<{t}>") for t in ("float", "double")]
    assert not mc.reconcile(*arrays).is_empty()
    assert mc.reconcile(*arrays, tolerance_scale=6).is_empty()


def test_decimals_beyond_38_digits_compare_exactly(spark):
    left = spark.sql("SELECT cast(x AS decimal(38,18)) AS x FROM VALUES ('12.5'), ('100'), ('0') AS t(x)")
    right = spark.sql("SELECT cast(x AS decimal(38,0)) AS x FROM VALUES ('13'), ('100'), ('0') AS t(x)")
    assert rows(mc.reconcile(left, right).rows) == [("only_left", "12.5"), ("only_right", "13")]
    nested = [f.selectExpr("array(x) AS a", "map(1, x) AS m", "named_struct('x', x) AS s") for f in (left, right)]
    found = mc.reconcile(*nested)
    assert counts(found) == {"only_left": 1, "only_right": 1}
    assert {r.a[0] for r in found.rows.collect()} == {"12.5", "13"}


def test_maps_compare_whatever_their_order(spark):
    left = spark.sql("SELECT map('a', 1, 'b', 2) AS m, named_struct('n', map('x', 1)) AS s, array(map(1, 2)) AS l")
    right = spark.sql("SELECT map('b', 2, 'a', 1) AS m, named_struct('n', map('x', 1)) AS s, array(map(1, 2)) AS l")
    other = spark.sql("SELECT map('b', 2, 'a', 3) AS m, named_struct('n', map('x', 1)) AS s, array(map(1, 2)) AS l")
    assert mc.reconcile(left, right).is_empty()
    assert counts(mc.reconcile(left, other)) == {"only_left": 1, "only_right": 1}


def test_text_against_numbers(spark):
    left = spark.createDataFrame([("1",), ("x",)], "a string")
    right = spark.createDataFrame([(1,), (2,)], "a int")
    assert rows(mc.reconcile(left, right).rows) == [("only_left", "x"), ("only_right", "2")]


def test_report_shuffles_the_rows_once(spark, pair):
    left, right = pair
    for multiset in (False, True):
        found = mc.reconcile(left, right, multiset=multiset)
        report = found.report(1)
        assert [(r.entry, r.side, r.n_rows, r.k) for r in report.orderBy("entry", "side").collect()] == [
            ("count", "only_left", 3 if multiset else 1, None),
            ("count", "only_right", 1, None),
            ("sample", "only_left", None, 1 if multiset else 2),
            ("sample", "only_right", None, 4),
        ]
        plan = plan_of(report)
        assert plan.count("ReusedExchange") == 2
        assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 1


def test_rows_need_one_shuffle(pair):
    assert plan_of(mc.reconcile(*pair).rows).count("Exchange") == 1


def test_by_key(spark):
    left = spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (None, "n", 0.0), (5, "e", 5.0), (5, "e", 5.0), (6, "f", 6.0)],
        "k int, s string, x double",
    )
    right = spark.createDataFrame(
        [(1, "a", 1.0), (2, "B", 2.0), (4, "d", 4.0), (None, "n", 9.0), (5, "e", 5.0), (6, "f", 6.5), (6, "g", 6.0)],
        "k int, s string, x double",
    )
    found = mc.reconcile_by_key(left, right, ["K"])
    got = {r.k: r for r in found.rows.collect()}
    assert {k: (r.status, r.n_left, r.n_right) for k, r in got.items()} == {
        2: ("changed", 1, 1), 3: ("only_left", 1, 0), 4: ("only_right", 0, 1),
        None: ("changed", 1, 1), 5: ("only_left", 1, 0), 6: ("ambiguous", 1, 2),
    }
    assert (got[2].left_s, got[2].right_s, got[None].left_x, got[None].right_x) == ("b", "B", 0.0, 9.0)
    assert got[6].left_s is None and got[6].right_s is None
    assert rows(found.mismatches()) == [("s", 2, 1), ("x", 2, 1)]
    assert rows(found.statuses()) == [("ambiguous", 1), ("changed", 2), ("only_left", 2), ("only_right", 1)]
    assert rows(mc.reconcile_by_key(left, right, ["k"], ["x"]).mismatches()) == [("x", 1, 1)]
    with pytest.raises(ValueError):
        mc.reconcile_by_key(left, right, ["k", "s", "x"])


def test_by_key_against_brute_force(spark):
    left = spark.range(400).selectExpr("id % 90 AS k", "id % 7 AS a", "cast(id % 11 AS string) AS b")
    right = spark.range(380).selectExpr("id % 95 AS k", "id % 7 AS a", "cast(id % 13 AS string) AS b")
    a, b = Counter(map(tuple, left.collect())), Counter(map(tuple, right.collect()))
    extra = {}
    for side, rest in ((0, a - b), (1, b - a)):
        for (k, *_), n in rest.items():
            extra.setdefault(k, [0, 0])[side] += n
    def status(l, r):
        if not (l and r):
            return "only_left" if l else "only_right"
        return "changed" if l == r == 1 else "ambiguous"
    found = mc.reconcile_by_key(left, right, ["k"])
    assert {r.k: (r.n_left, r.n_right, r.status) for r in found.rows.collect()} == {
        k: (l, r, status(l, r)) for k, (l, r) in extra.items()
    }


def test_by_key_makes_no_join(spark):
    left = spark.range(10).selectExpr("id AS k", "id AS v")
    plan = plan_of(mc.reconcile_by_key(left, left.withColumn("v", F.lit(1)), ["k"]).rows)
    assert "Join" not in plan and plan.count("Exchange") == 2


def test_bigint_against_double_is_exact(spark):
    left = spark.sql("SELECT * FROM VALUES (9007199254740993L), (9007199254740992L), (3L), (4611686018427387904L) t(v)")
    right = spark.sql(
        "SELECT * FROM VALUES (9007199254740992D), (3D), (0.5D), (4611686018427387904D), (1e30D), (double('nan')) t(v)"
    )
    found = rows(mc.reconcile(left, right).rows)
    assert found == [
        ("only_left", "9007199254740993"), ("only_right", "0.5"), ("only_right", "1" + "0" * 30), ("only_right", "NaN"),
    ]


def test_decimal_against_double(spark):
    left = spark.sql("SELECT CAST(v AS decimal(20,4)) AS v FROM VALUES ('0.1'), ('2'), ('1.2345'), ('-7.5') t(v)")
    right = spark.sql("SELECT * FROM VALUES (0.1D), (2D), (1.23451D), (-7.5D) t(v)")
    assert rows(mc.reconcile(left, right).rows) == [("only_left", "1.2345"), ("only_right", "1.23451")]
    assert mc.reconcile(left, right, tolerance_scale=4).is_empty()


def test_tolerance_reaches_nested_floats(spark):
    kind = "id int, s struct<a:double,b:array<array<float>>>, m map<string,double>"
    left = spark.createDataFrame([(1, (1.001, [[2.001]]), {"k": 3.001}), (2, None, None)], kind)
    right = spark.createDataFrame([(1, (1.002, [[2.002]]), {"k": 3.002}), (2, None, None)], kind)
    assert mc.reconcile(left, right, tolerance_scale=2).is_empty()
    assert len(rows(mc.reconcile(left, right).rows)) == 2


def test_variants_are_refused(spark):
    frame = spark.sql("SELECT parse_json('1') AS v")
    with pytest.raises(TypeError, match="variant"):
        mc.reconcile(frame, frame)


def test_names_of_the_keyed_result(spark):
    frame = spark.sql("SELECT 1 AS left_x, 2 AS x")
    with pytest.raises(ValueError, match="left_x"):
        mc.reconcile_by_key(frame, frame, ["left_x"])
