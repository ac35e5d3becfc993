from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import types as T

import movecheck as mc
from tests.conftest import by_name, rows

HEADER = "src_column_name|target_column_name|source_datatype|isnullable"


def make(*rows_, names=("src_column_name", "source_datatype", "Isnullable")):
    return mc.Contract.from_rows([dict(zip(names, r)) for r in rows_])


PARTS = make(
    ("code", "string", "true"),
    ("pieces", "int", "false"),
    ("price", "decimal(38,9)", "true"),
    ("made_on", "date", "true"),
    ("rate", "numeric(28,9)", "true"),
)


def test_nullable_flag_is_text():
    flags = ["true", "TRUE", "false", "", None, True, False]
    got = make(*[(f"c{i}", "int", flag) for i, flag in enumerate(flags)])
    assert [c.nullable for c in got.columns] == [True, True, False, False, False, True, False]


def test_contract_schema():
    assert PARTS.schema.simpleString() == (
        "struct<code:string,pieces:int,price:decimal(38,9),made_on:date,rate:decimal(28,9)>"
    )
    assert [f.nullable for f in PARTS.schema] == [True, False, True, True, True]


@pytest.mark.parametrize(
    "bad",
    [
        [{"src_column_name": "a", "source_datatype": "int"}],
        [{"src_column_name": "", "source_datatype": "int", "isnullable": "true"}],
        [{"src_column_name": n, "source_datatype": "int", "isnullable": "true"} for n in ("a", "A")],
        [],
    ],
)
def test_unusable_contracts(bad):
    with pytest.raises(ValueError):
        mc.Contract.from_rows(bad)


def test_contract_file(spark, tmp_path):
    path = tmp_path / "contract.csv"
    lines = [
        HEADER,
        "caf\xe9|cafe|string|true",
        "a|a|int|false",
        "b|b|int|true|too|many",
        "c|c|int|true|toomany",
        "d|d|ARRAY<FLOAT>",
    ]
    path.write_bytes("\n".join(lines).encode("ISO-8859-1"))
    frame = mc.read_contract(spark, str(path))
    assert [tuple(r) for r in frame.collect()] == [
        ("caf\xe9", "cafe", "string", "true"),
        ("a", "a", "int", "false"),
        ("d", "d", "ARRAY<FLOAT>", None),
    ]
    contract = mc.load_contract(spark, str(path))
    assert [(c.source, c.target, c.nullable) for c in contract.columns] == [
        ("caf\xe9", "cafe", True), ("a", "a", False), ("d", "d", False),
    ]


def test_conform_by_name_with_missing_columns(spark):
    data = [
        {"code": "k-17", "pieces": 7, "made_on": "2019-02-03"},
        {"code": "k-40", "price": 12.5, "made_on": "2018-11-30", "rate": 0.25},
    ]
    frame = spark.createDataFrame(
        data, "made_on string, rate double, pieces bigint, code string, price double"
    )
    got = mc.conform(frame, PARTS)
    assert got.schema.simpleString() == PARTS.schema.simpleString()
    assert rows(got) == [
        ("k-17", 7, None, date(2019, 2, 3), None),
        ("k-40", None, Decimal("12.500000000"), date(2018, 11, 30), Decimal("0.250000000")),
    ]
    assert {r.column_name: r.n_nulls for r in mc.null_violations(got, PARTS).collect()} == {"pieces": 1}


def test_conform_renames_and_marks_absent(spark):
    contract = mc.Contract.from_rows(
        [
            {"src_column_name": "A", "target_column_name": "id", "source_datatype": "int", "isnullable": "true"},
            {"src_column_name": "gone", "source_datatype": "decimal(5,2)", "isnullable": "true"},
            {"src_column_name": "b", "source_datatype": "string", "isnullable": "true",
             "iscolpresentindata": False},
        ]
    )
    frame = spark.createDataFrame([("12", "x"), ("no", "y"), ("99999999999", None)], "a string, b string")
    got = mc.conform(frame, contract)
    assert got.columns == ["id", "gone", "b"]
    assert rows(got) == sorted([(12, None, None), (None, None, None), (None, None, None)], key=repr)
    assert mc.conform(frame, contract, rename=False).columns == ["A", "gone", "b"]
    lost = by_name(mc.contract_losses(frame, contract))
    assert (lost["id"]["n_rows"], lost["id"]["n_nulls"], lost["id"]["n_lost"]) == (3, 0, 2)
    assert lost["gone"]["n_nulls"] == 3 and lost["gone"]["from_type"] is None


def test_conform_keeps_filters_pushable(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    contract = make(("id", "bigint", "true"))
    plan = mc.conform(spark.read.parquet(path), contract).filter("id > 5")
    assert "GreaterThan(id,5)" in plan._jdf.queryExecution().executedPlan().toString()


def test_conform_odd_names(spark):
    contract = make(("a.b", "int", "true"), ("c d", "string", "true"), ("e`f", "int", "true"))
    frame = spark.createDataFrame([("1", 2, "3")], ["a.b", "c d", "e`f"])
    assert rows(mc.conform(frame, contract)) == [(1, "2", 3)]


def test_null_violations_of_absent_column(spark):
    contract = make(("a", "int", "false"), ("b", "int", "false"), ("c", "int", "true"))
    frame = spark.createDataFrame([(1, None), (None, 1), (None, 2)], "a int, c int")
    assert {r.column_name: (r.n_rows, r.n_nulls) for r in mc.null_violations(frame, contract).collect()} == {
        "a": (3, 2), "b": (3, 3),
    }


def test_violations_count_lost_casts(spark):
    contract = make(("a", "int", "false"), ("xs", "array<int>", "false"))
    frame = spark.createDataFrame([("1", ["1", "x"]), ("x", None), (None, ["2"])], "a string, xs array<string>")
    got = by_name(mc.contract_losses(frame, contract))
    assert (got["a"]["n_nulls"], got["a"]["n_lost"], got["a"]["n_violations"]) == (1, 1, 2)
    assert (got["xs"]["n_nulls"], got["xs"]["n_lost"], got["xs"]["n_violations"]) == (1, 1, 1)


def test_cast_loss_and_alignment_of_wide_tables(spark):
    names = [f"c{i}" for i in range(70)]
    frame = spark.createDataFrame([tuple(["7"] * 70), tuple(["x"] * 70)], names)
    wanted = T.StructType([T.StructField(n, T.IntegerType()) for n in names])
    got = by_name(mc.cast_loss(frame, wanted))
    assert len(got) == 70 and all(r["n_lost"] == 1 and r["n_values"] == 2 for r in got.values())


def test_swapped_names(spark):
    swapped = mc.Contract.from_rows([
        {"src_column_name": "a", "target_column_name": "b", "source_datatype": "int", "isnullable": "false"},
        {"src_column_name": "b", "target_column_name": "c", "source_datatype": "int", "isnullable": "true"},
    ])
    frame = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    assert [r.n_nulls for r in mc.null_violations(frame, swapped, names="source").collect()] == [0]
    assert [r.n_nulls for r in mc.null_violations(mc.conform(frame, swapped), swapped).collect()] == [0]
    with pytest.raises(ValueError):
        mc.null_violations(frame, swapped, names="both")


def test_nothing_to_measure(spark):
    frame = spark.range(2)
    loose = mc.Contract.from_rows([{"src_column_name": "id", "source_datatype": "int", "isnullable": "true"}])
    assert mc.null_violations(frame, loose).columns == ["column_name", "n_rows", "n_nulls"]
    assert mc.decimal_overflow(frame, 5, 2).count() == 0
    assert mc.cast_loss(frame, spark.createDataFrame([], "x int").schema).count() == 0


def test_required_columns(spark):
    row = {"src_column_name": "x", "source_datatype": "int", "isnullable": "true", "isrequired": "true"}
    with pytest.raises(ValueError, match="required columns are absent: x"):
        mc.conform(spark.range(1), mc.Contract.from_rows([row]))
    gone = mc.Contract.from_rows([{**row, "iscolpresentindata": "false"}])
    assert mc.conform(spark.range(1), gone).collect()[0].x is None


def test_altered_values(spark):
    frame = spark.sql(
        "SELECT 12.7D AS f, 1.255BD AS d, '1.50' AS t, '2020-01-01 05:00:00' AS at, timestamp_ntz'2020-01-01 05:00:00' AS n,"
        " array(1.5D, 2D) AS xs, '1.239' AS cut, 0.1D AS tenth, '1e-12' AS tiny"
    )
    types = {"f": "int", "d": "decimal(5,2)", "t": "decimal(38,9)", "at": "date", "n": "date", "xs": "array<int>",
             "cut": "decimal(5,2)", "tenth": "decimal(5,2)", "tiny": "decimal(38,9)"}
    wanted = mc.Contract.from_rows(
        [{"src_column_name": n, "source_datatype": t, "isnullable": "true"} for n, t in types.items()]
    )
    found = {r.column_name: (r.n_lost, r.n_altered) for r in mc.contract_losses(frame, wanted).collect()}
    assert found == {n: (0, 0 if n in ("t", "tenth") else 1) for n in types}


def test_frame_without_contract_columns(spark):
    with pytest.raises(ValueError, match="contract lacks"):
        mc.read_table(spark, "unread", contract=spark.range(1))
