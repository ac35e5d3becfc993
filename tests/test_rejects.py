from __future__ import annotations

import json

import pytest

import movecheck as mc


def contract(*rows):
    names = ("src_column_name", "target_column_name", "source_datatype", "isnullable")
    return mc.Contract.from_rows([dict(zip(names, row)) for row in rows])


CONTRACT = contract(("k", "key", "int", "false"), ("p", "price", "decimal(5,1)", "true"), ("a", "marks", "array<int>", "true"))
SOURCE = [
    ("1", 1.5, ["1"]), ("1", 1.5, ["1"]), ("x", 2.0, None), (None, 12.25, ["2"]), ("4", 1e9, ["3", "y"]), ("5", None, []),
]


def source(spark):
    return spark.createDataFrame(SOURCE, "k string, p double, a array<string>")


def test_rows_go_one_way_with_all_their_reasons(spark, tmp_path):
    done = mc.load_with_rejects(source(spark), CONTRACT, str(tmp_path / "t"), exact=True)
    assert sorted(r["key"] for r in done.accepted.collect()) == [1, 1, 5]
    assert done.accepted.columns == ["key", "price", "marks"]
    rejected = {json.loads(r["source_row"])["p"]: r["reasons"] for r in done.rejected.collect()}
    assert rejected == {
        2.0: ["lost:key", "null:key"], 12.25: ["null:key", "altered:price"], 1e9: ["lost:price", "lost:marks"],
    }
    assert done.accepted.count() + done.rejected.count() == len(SOURCE)
    assert {r["reason"]: r["n_rows"] for r in done.reasons().collect()} == {
        "lost:key": 1, "null:key": 2, "altered:price": 1, "lost:price": 1, "lost:marks": 1,
    }


def test_reasons_add_up_to_the_losses_of_the_contract(spark):
    df = source(spark)
    routed = mc.route_rows(df, CONTRACT, exact=True)
    counts = {}
    for row in routed.collect():
        for reason in row["reasons"]:
            counts[reason] = counts.get(reason, 0) + 1
    for row in mc.contract_losses(df, CONTRACT).collect():
        assert counts.get(f"lost:{row.column_name}", 0) == row.n_lost
        assert counts.get(f"altered:{row.column_name}", 0) == row.n_altered
        assert counts.get(f"null:{row.column_name}", 0) == row.n_violations


def test_rejected_rows_can_be_mended_and_loaded_again(spark, tmp_path):
    target = str(tmp_path / "t")
    first = mc.load_with_rejects(source(spark), CONTRACT, target)
    back = spark.read.json(first.rejected.select("source_row").rdd.map(lambda r: r[0]), schema="k string, p double, a array<string>")
    mended = back.selectExpr("'9' AS k", "1D AS p", "CAST(NULL AS ARRAY<STRING>) AS a")
    again = mc.load_with_rejects(mended, CONTRACT, target)
    assert sorted(r["key"] for r in again.accepted.collect()) == [1, 1, 5, 9, 9, 9]


def test_absent_columns_fitted_decimals_and_empty_sources(spark, tmp_path):
    wanted = contract(("k", "key", "string", "false"), ("none", "none", "int", "false"))
    routed = mc.route_rows(source(spark), wanted).collect()
    assert {tuple(r["reasons"]) for r in routed} == {("null:none",), ("null:key", "null:none")}
    prices = contract(("p", "price", "decimal(20,4)", "true"))
    done = mc.load_with_rejects(source(spark), prices, str(tmp_path / "p"), decimal=(5, 2))
    assert [r["reasons"] for r in done.rejected.collect()] == [["lost:price"]]
    assert dict(done.accepted.dtypes)["price"] == "decimal(5,2)"
    empty = mc.load_with_rejects(source(spark).limit(0), CONTRACT, str(tmp_path / "e"))
    assert empty.accepted.isEmpty() and empty.rejected.isEmpty()


def test_names_of_the_result_are_refused(spark):
    with pytest.raises(ValueError):
        mc.route_rows(source(spark), contract(("k", "Route", "string", "true")))


def test_one_scan_writes_both(spark):
    routed = mc.route_rows(source(spark), CONTRACT)
    assert "Exchange" not in routed._jdf.queryExecution().executedPlan().toString()
