from __future__ import annotations

import random
from itertools import combinations

import pytest

import movecheck as mc


def brute(data, names, most):
    found = []
    for size in range(1, most + 1):
        for places in combinations(range(len(names)), size):
            if any(set(k) <= set(places) for k in found):
                continue
            values = [tuple(row[i] for i in places) for row in data]
            if len(set(values)) == len(values):
                found.append(places)
    return [[names[i] for i in places] for places in found]


@pytest.mark.parametrize("slices", [1, 4, 64])
def test_against_brute_force(spark, slices):
    for seed in range(3):
        rng = random.Random(seed)
        data = [(rng.randint(0, 40), rng.choice("abcd"), rng.choice([None, 1, 2, 3]), rng.randint(0, 9)) for _ in range(60)]
        data = list(dict.fromkeys(data))
        df = spark.createDataFrame(data, "p int, q string, r int, s int")
        got = mc.unique_keys(df, max_columns=4, slices=slices).collect()
        assert [r["key"] for r in got] == brute(data, ["p", "q", "r", "s"], 4)
        for r in got:
            places = ["pqrs".index(n) for n in r["key"]]
            assert r["n_null_rows"] == sum(any(row[i] is None for i in places) for row in data)


def test_a_null_is_a_value(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, 1)], "a int, b int")
    assert [(r["key"], r["n_null_rows"]) for r in mc.unique_keys(df).collect()] == [(["a", "b"], 2)]


def test_repeated_rows_have_no_key_and_few_rows_many(spark):
    df = spark.createDataFrame([(1, "x.y")] * 2, "`a.b` int, n string")
    assert mc.unique_keys(df).count() == 0
    assert [r["key"] for r in mc.unique_keys(df.limit(1)).collect()] == [["a.b"], ["n"]]
    assert mc.unique_keys(df.limit(0)).count() == 2


def test_maps_are_left_out(spark):
    df = spark.sql("select id, map('a', id) as m, array(id) as l from range(3)")
    assert [r["key"] for r in mc.unique_keys(df).collect()] == [["id"], ["l"]]


def test_repeats_among_many_values_never_reach_the_exact_check(spark, monkeypatch):
    from movecheck.operators import keys

    seen = []
    exact = keys._is_key
    monkeypatch.setattr(keys, "_is_key", lambda df, names: seen.append(names) or exact(df, names))
    df = spark.range(20000).selectExpr("id", "id % 10 as t", "id div 10 as d", "id div 2 as e")
    assert [tuple(r["key"]) for r in mc.unique_keys(df).collect()] == [("id",), ("t", "d"), ("t", "e")]
    assert not {("d",), ("e",), ("d", "e")} & set(seen)
