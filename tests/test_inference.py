"""Contracts inferred from texts, and floats of 32 bits in comparisons and loads."""

from __future__ import annotations

import pytest

import movecheck as mc
from movecheck.sources.contract import as_contract
from tests.conftest import rows


def kind_of(spark, *values):
    frame = spark.createDataFrame([(v,) for v in values], "c string")
    return mc.infer_contract(frame).first()["source_datatype"]


@pytest.mark.parametrize(
    "values, kind",
    [
        (("1", "-5", None), "int"), (("1", "2147483648"), "bigint"), (("0", "9223372036854775808"), "decimal(19,0)"),
        (("1", "2.50"), "decimal(3,2)"), (("123", "0.001"), "decimal(6,3)"), (("-0.5",), "decimal(2,1)"), (("-0.0", "1.5"), "double"),
        (("1.0E-5", "2"), "double"), (("NaN",), "double"), (("007",), "string"), (("1", "x"), "string"), (("",), "string"),
        (("9" * 39,), "string"), (("1.0E-5", "12345678901234567.25"), "string"), (("true", "false"), "boolean"), (("true", "1"), "string"),
        (("2024-02-29",), "date"), (("2023-02-29",), "string"), (("2024-01-01", "2024-01-01 00:00:01"), "timestamp_ntz"),
        (("2024-01-01 00:00:00.5",), "timestamp_ntz"), (("2024-01-01", "3"), "string"), ((None, None), "string"), (("1 ",), "string"), (("+1",), "string"),
    ],
)
def test_least_type(spark, values, kind):
    assert kind_of(spark, *values) == kind


def test_versions_merge(spark):
    old = spark.createDataFrame([("1", "a", 1), ("2", None, 2)], "k string, t string, n int")
    new = spark.createDataFrame([("2.5", 2**40)], "K string, n long")
    got = [tuple(r) for r in mc.infer_contract(old, new).collect()]
    assert got == [
        ("k", "k", "decimal(2,1)", "false", "true", "true"), ("t", "t", "string", "true", "true", "false"),
        ("n", "n", "bigint", "false", "true", "true"),
    ]
    assert as_contract(mc.infer_contract(old)).schema.simpleString() == "struct<k:int,t:string,n:int>"
    # Merging states is what inferring the union is.
    both = spark.createDataFrame([("1",), ("2",), ("2.5",)], "k string")
    assert mc.infer_contract(both).first()["source_datatype"] == "decimal(2,1)"
    assert mc.infer_contract(old.limit(0)).first()["source_datatype"] == "string"
    with pytest.raises(TypeError):
        mc.infer_contract(spark.createDataFrame([([1],)], "a array<int>"))
    with pytest.raises(ValueError):
        mc.infer_contract()


def test_conforming_to_the_inferred_contract_loses_nothing(spark):
    data = [(str(i), f"{i / 8}", ["-0.0", "1.5E300", "NaN"][i % 3], f"2024-01-{i % 28 + 1:02d}", ["true", None][i % 2], f"{i:03d}") for i in range(60)]
    frame = spark.createDataFrame(data, "a string, b string, c string, d string, e string, f string")
    inferred = mc.infer_contract(frame)
    assert [r["source_datatype"] for r in inferred.collect()] == ["int", "decimal(4,3)", "double", "date", "boolean", "string"]
    for r in mc.contract_losses(frame, inferred).collect():
        assert (r["n_lost"], r["n_altered"], r["n_violations"]) == (0, 0, 0), r


def test_short_floats_equal_their_decimals(spark):
    left = spark.sql("SELECT * FROM VALUES (CAST(0.1 AS FLOAT)), (CAST(16777216 AS FLOAT)), (CAST(-0.0 AS FLOAT)), (CAST(2.5e-3 AS FLOAT)) t(v)")
    right = spark.sql("SELECT * FROM VALUES (CAST(0.1 AS DECIMAL(20,4))), (16777216), (0), (0.0025) t(v)")
    assert mc.reconcile(left, right).is_empty()
    off = spark.sql("SELECT * FROM VALUES (CAST(0.1001 AS DECIMAL(20,4))) t(v)")
    assert len(rows(mc.reconcile(left.limit(1), off).rows)) == 2


def test_nulls_made_by_fitting_are_in_the_default_difference(spark, tmp_path):
    frame = spark.sql("SELECT 1 AS id, CAST(123456.78 AS DECIMAL(20,4)) AS p")
    frame.write.orc(str(tmp_path / "s"))
    wanted = mc.Contract.from_rows([
        {"src_column_name": n, "source_datatype": t, "isnullable": "true"} for n, t in (("id", "int"), ("p", "decimal(20,4)"))
    ])
    done = mc.migrate(spark, str(tmp_path / "s"), wanted, str(tmp_path / "t"), decimal=(5, 2))
    assert [r["n_rows"] for r in done.difference.counts().collect()] == [1, 1]
    again = mc.migrate(spark, str(tmp_path / "s"), wanted, str(tmp_path / "u"), decimal=(5, 2), unfitted=False)
    assert again.difference.is_empty()
