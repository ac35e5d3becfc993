from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import types as T

import movecheck as mc
from tests.conftest import by_name, rows


def test_schema_drift(spark):
    left = spark.createDataFrame([], "same int, Differs int, gone string, Case string")
    right = spark.createDataFrame([], "SAME int, differs bigint, added date, case string")
    assert rows(mc.schema_drift(left, right)) == sorted(
        [
            ("Case", "string", "string", "same"),
            ("Differs", "int", "bigint", "type_differs"),
            ("added", None, "date", "only_right"),
            ("gone", "string", None, "only_left"),
            ("same", "int", "int", "same"),
        ],
        key=repr,
    )


def test_drift_follows_the_case_rule(spark):
    left, right = spark.createDataFrame([], "id int"), spark.createDataFrame([], "ID int")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert {r.status for r in mc.schema_drift(left, right).collect()} == {"only_left", "only_right"}
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_drift_report_counts_losses(spark):
    left = spark.createDataFrame([("1", 1), ("x", 2), (None, 3)], "a string, b int")
    right = spark.createDataFrame([], "a int, b int")
    got = by_name(mc.drift_report(left, right))
    assert (got["a"]["n_values"], got["a"]["n_lost"], got["b"]["n_lost"]) == (2, 1, None)
    assert by_name(mc.drift_report(right, right))["a"]["n_lost"] is None


def test_align_and_union(spark):
    old = spark.createDataFrame([("1", "k", 1), ("x", "k", 2)], "id string, only_old string, n int")
    new = spark.createDataFrame([(3, 2.5, 7)], "ID bigint, only_new double, n bigint")
    aligned = mc.align_to(old, new)
    assert aligned.schema.simpleString() == "struct<id:bigint,only_old:string,n:bigint>"
    assert rows(mc.align_to(aligned, new)) == rows(aligned) == [(1, "k", 1), (None, "k", 2)]
    united = mc.union_aligned(old, new)
    assert united.columns == ["id", "only_old", "n", "only_new"]
    assert rows(united) == sorted([(1, "k", 1, None), (None, "k", 2, None), (3, None, 7, 2.5)], key=repr)


def test_cast_loss(spark):
    frame = spark.createDataFrame([("1", 1000, [1.0]), ("x", 5, [1e30, 2.0]), (None, None, None)],
                                  "a string, b int, c array<double>")
    wanted = T.StructType(
        [
            T.StructField("A", T.IntegerType()),
            T.StructField("b", T.ByteType()),
            T.StructField("c", T.ArrayType(T.DecimalType(38, 9))),
            T.StructField("absent", T.IntegerType()),
        ]
    )
    got = by_name(mc.cast_loss(frame, wanted))
    assert {n: (r["n_values"], r["n_lost"]) for n, r in got.items()} == {"a": (2, 1), "b": (2, 1), "c": (2, 1)}


def test_fit_decimals(spark):
    frame = spark.createDataFrame(
        [(Decimal("1.0000000005"), Decimal("1"), 0.5), (Decimal("12345678901234567890"), Decimal("2"), 1.5)],
        "a decimal(38,18), b decimal(5,1), x double",
    )
    assert mc.fit_decimals(frame) is frame
    fitted = mc.fit_decimals(frame, 20, 9)
    assert fitted.schema.simpleString() == "struct<a:decimal(20,9),b:decimal(20,9),x:double>"
    assert [r.a for r in fitted.collect()] == [Decimal("1.000000001"), None]
    only = mc.fit_decimals(frame, 20, 9, ["A"])
    assert only.schema["b"].dataType == T.DecimalType(5, 1)
    assert {r.column_name: r.n_lost for r in mc.decimal_overflow(frame, 20, 9).collect()} == {"a": 1, "b": 0}
    with pytest.raises(ValueError):
        mc.fit_decimals(frame, scale=2)


def test_cast_elements(spark):
    frame = spark.createDataFrame(
        [(1, [1.123456789, 2.98765432155]), (2, []), (3, None), (4, [None, 1e30])], "id int, xs array<double>"
    )
    got = mc.cast_elements(frame, "xs", T.DecimalType(38, 9), into="ds")
    assert got.columns == ["id", "xs", "ds"]
    assert {r.id: r.ds for r in got.collect()} == {
        1: [Decimal("1.123456789"), Decimal("2.987654322")], 2: [], 3: None, 4: [None, None],
    }
    nested = spark.createDataFrame([([["1", "x"], None],)], "xs array<array<string>>")
    assert mc.cast_elements(nested, "xs", T.IntegerType()).collect()[0].xs == [[1, None], None]
    with pytest.raises(TypeError):
        mc.cast_elements(frame, "id", T.IntegerType())
