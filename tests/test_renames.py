from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import movecheck as mc
from movecheck.operators.renames import BUCKETS, column_sketches, _estimates


def found(left, right, **options):
    return {
        (r["left_column"], r["right_column"]): r["similarity"]
        for r in mc.renamed_columns(left, right, **options).collect()
    }


def test_values_pair_columns_across_types_and_order(spark):
    left = spark.sql("SELECT id AS key, id * 0.5D AS price, CAST(id % 3 AS STRING) AS kind, id % 7 AS same FROM range(500)")
    right = left.select(
        F.col("kind").cast("int").alias("code"), "same", F.col("price").cast("decimal(20,4)").alias("amount"),
        F.col("key").cast("string").alias("id"),
    )
    assert found(left, right) == {("key", "id"): 1.0, ("price", "amount"): 1.0, ("kind", "code"): 1.0}
    renamed = mc.apply_renames(left, mc.renamed_columns(left, right))
    assert renamed.columns == ["id", "amount", "code", "same"]


def test_narrow_floats_agree_with_decimals(spark):
    left = spark.sql("SELECT CAST(id / 10 AS FLOAT) AS a FROM range(100)")
    right = spark.sql("SELECT CAST(id / 10 AS DECIMAL(9,3)) AS b FROM range(100)")
    assert found(left, right) == {("a", "b"): 1.0}


def test_look_alikes_stay_unpaired(spark):
    left = spark.sql("SELECT id AS key, IF(id % 10 = 0, 'x', 'y') AS flag FROM range(1000)")
    # The same two values in other shares, and a shifted key.
    right = spark.sql("SELECT id + 600 AS number, IF(id % 2 = 0, 'x', 'y') AS mark FROM range(1000)")
    assert found(left, right) == {
        ("key", None): None, ("flag", None): None, (None, "number"): None, (None, "mark"): None
    }
    # One pair is exact in shares of rows and of values: 400 of 1600 keys, 400 of 1000 rows.
    assert found(left, right, min_similarity=0.25)[("key", "number")] == 0.25
    assert found(left, right, min_similarity=0.25)[("flag", "mark")] == pytest.approx(0.6)


def test_nulls_count_as_rows_and_empty_columns_stay_alone(spark):
    left = spark.sql("SELECT IF(id < 50, NULL, id % 2) AS a, CAST(NULL AS INT) AS gone FROM range(100)")
    right = spark.sql("SELECT id % 2 AS b, CAST(NULL AS STRING) AS nothing FROM range(100)")
    result = found(left, right)
    assert ("a", None) in result and ("gone", None) in result and (None, "nothing") in result
    assert found(left, right, min_similarity=0.5)[("a", "b")] == 0.5


def test_ties_go_to_the_nearer_place(spark):
    left = spark.sql("SELECT id AS a, id AS b FROM range(50)")
    right = left.toDF("x", "y")
    assert found(left, right) == {("a", "x"): 1.0, ("b", "y"): 1.0}


def test_empty_tables_and_equal_names(spark):
    left, right = spark.range(5).toDF("a"), spark.range(5).toDF("b")
    alone = {("a", None): None, (None, "b"): None}
    assert found(left.limit(0), right) == alone
    assert found(left.limit(0), right.limit(0)) == alone
    assert found(left, left) == {}


def test_similarity_is_that_of_a_plain_count(spark):
    rng = random.Random(3)
    rows = [[rng.choice([None, *range(n)]) for n in (3, 40, 400)] for _ in range(600)]
    kept = [row for row in rows if rng.random() < 0.9]
    left = spark.createDataFrame(rows, "a long, b long, c long")
    right = spark.createDataFrame([row[::-1] for row in kept], "x long, y long, z long")

    def plain(i: int) -> float:
        a, b = Counter(r[i] for r in rows), Counter(r[i] for r in kept)
        keys = ({*a} | {*b}) - {None}
        alike = sum(k in a and k in b for k in keys) / len(keys)
        return min(alike, sum(min(a[k] / len(rows), b[k] / len(kept)) for k in {*a, *b}))

    result = found(left, right, min_similarity=0.5)
    for i, pair in enumerate([("a", "z"), ("b", "y"), ("c", "x")]):
        assert result[pair] == pytest.approx(plain(i))


def test_sketches_are_small_and_close(spark):
    left = spark.range(40_000).toDF("a")
    right = spark.sql("SELECT id + 4000 AS b FROM range(40000)")
    assert column_sketches(left, ["a"]).count() <= BUCKETS + 1
    (row,) = _estimates(left, right, ["a"], ["b"], BUCKETS).collect()
    assert row["alike"] == pytest.approx(36 / 44, abs=4 * (0.25 / BUCKETS) ** 0.5)
    assert row["overlap"] >= 0.9
