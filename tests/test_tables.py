from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException

import movecheck as mc
from movecheck.sources import sinks
from tests.conftest import plan_of, rows


def contract(**columns):
    return mc.Contract.from_rows(
        [{"src_column_name": n, "source_datatype": t, "isnullable": "true"} for n, t in columns.items()]
    )


def folder(spark, tmp_path, *frames, fmt="orc"):
    path = str(tmp_path / "t")
    for frame in frames:
        frame.coalesce(1).write.format(fmt).mode("append").save(path)
    return path


def test_absent_path(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        mc.read_table(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("fmt", ["orc", "parquet"])
def test_files_that_lack_columns(spark, tmp_path, fmt):
    path = folder(
        spark, tmp_path,
        spark.createDataFrame([(1, "x")], "id int, Name string"),
        spark.createDataFrame([(2, 2.5)], "id int, price double"),
        fmt=fmt,
    )
    got = mc.read_table(spark, path, fmt, contract(ID="bigint", name="string", price="decimal(10,2)", other="date"))
    assert rows(got) == [(1, "x", None, None), (2, None, Decimal("2.50"), None)]


def test_mismatched_type_is_counted_not_silently_null(spark, tmp_path):
    path = folder(spark, tmp_path, spark.createDataFrame([("a",), ("7",)], "v string"))
    assert rows(spark.read.schema("v int").orc(path)) == [(7,), (None,)]
    wanted = contract(v="int")
    assert rows(mc.read_table(spark, path, contract=wanted)) == [(7,), (None,)]
    assert mc.contract_losses(mc.read_table(spark, path), wanted).collect()[0].n_lost == 1


@pytest.mark.parametrize("text, value", [("bigint", 5), ("decimal(5,1)", Decimal("5.0")), ("string", "5")])
def test_int_read_as_wider_type(spark, tmp_path, text, value):
    path = folder(spark, tmp_path, spark.createDataFrame([(5,)], "v int"))
    assert rows(mc.read_table(spark, path, contract=contract(v=text))) == [(value,)]


def test_positional_columns(spark, tmp_path):
    path = folder(spark, tmp_path, spark.createDataFrame([(1, "x", 2.0)], "_col0 int, _col1 string, _col2 double"))
    assert rows(mc.read_table(spark, path, contract=contract(a="int", b="string", c="double"))) == [(1, "x", 2.0)]
    more = contract(a="int", b="string", c="double", d="date")
    assert rows(mc.read_table(spark, path, contract=more)) == [(1, "x", 2.0, None)]
    fewer = contract(a="int", b="string")
    with pytest.raises(ValueError, match="_col2"):
        mc.read_table(spark, path, contract=fewer)
    assert rows(mc.read_table(spark, path, contract=fewer, allow_extra=True)) == [(1, "x")]


def test_positional_columns_in_partitions(spark, tmp_path):
    frame = spark.createDataFrame([(1, "x", "202207")], "_col0 int, _col1 string, ym string")
    path = str(tmp_path / "t")
    mc.write_table(frame, path, "orc", partition_by="ym")
    assert rows(mc.read_table(spark, path, contract=contract(a="int", b="string"))) == [(1, "x")]


def test_positional_and_named_files_together(spark, tmp_path):
    old = spark.createDataFrame([(1, "x")], "_col0 int, _col1 string")
    new = spark.createDataFrame([("y", 2, 0.5)], "b string, a int, c double")
    path = folder(spark, tmp_path, old, new)
    wanted = contract(a="int", b="string", c="double")
    assert rows(mc.read_table(spark, path, contract=wanted)) == [(1, "x", None), (2, "y", 0.5)]


def test_paths_with_different_types(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("old", "new")]
    spark.createDataFrame([("1", "x")], "id string, s string").write.orc(paths[0])
    spark.createDataFrame([(2, 2.5)], "id bigint, v double").write.orc(paths[1])
    got = mc.read_table(spark, paths, contract=contract(id="bigint", s="string", v="double"))
    assert rows(got) == [(1, "x", None), (2, None, 2.5)]


def test_read_by_connector_options(spark, tmp_path):
    path = folder(spark, tmp_path, spark.range(3).toDF("id"), fmt="parquet")
    assert mc.read_table(spark, fmt="parquet", options={"path": path}).count() == 3


def test_write_modes(spark, tmp_path):
    path, one = str(tmp_path / "t"), spark.createDataFrame([(1,)], "id int")
    mc.write_table(one, path, mode="errorifexists")
    with pytest.raises(AnalysisException):
        mc.write_table(one, path, mode="errorifexists")
    mc.write_table(one, path)
    assert spark.read.parquet(path).count() == 2
    mc.write_table(one, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        mc.write_table(one, path, mode="replace")
    with pytest.raises(ValueError):
        mc.write_table(one, path, dynamic=True)


def test_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    mc.write_table(spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int"), path, partition_by="p")
    fresh = spark.createDataFrame([("a", 9)], "p string, v int")
    mc.write_table(fresh, path, mode="overwrite", partition_by="p", dynamic=True)
    assert rows(spark.read.parquet(path).select("p", "v")) == [("a", 9), ("b", 2)]
    mc.write_table(fresh, path, mode="overwrite", partition_by="p")
    assert rows(spark.read.parquet(path).select("p", "v")) == [("a", 9)]


def test_partitions_get_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(0, 4000, numPartitions=8).selectExpr("id", "cast(id % 5 AS string) AS p")
    mc.write_table(frame, path, partition_by="p", cluster_by=["id"])
    files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert len(files) == 5
    ids = [r.id for r in spark.read.parquet(files[0]).collect()]
    assert ids == sorted(ids) and len(ids) == 800


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """Half of the rows are in one partition; the write splits it by size."""
    path = str(tmp_path / "t")
    frame = spark.range(0, 60_000, numPartitions=8).selectExpr(
        "sha2(cast(id AS string), 256) AS v", "if(id % 2 = 0, 'hot', cast(id % 100 AS string)) AS p"
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        mc.write_table(frame, path, partition_by="p")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len([f for f in os.listdir(f"{path}/p=hot") if f.endswith(".parquet")]) > 3
    assert spark.read.parquet(path).filter("p = 'hot'").count() == 30_000


def test_partition_grain(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(datetime(2022, 7, 1, 5),), (datetime(2022, 8, 2),)], "At timestamp_ntz")
    mc.write_table(frame, path, partition_by="at", partition_grain="month")
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["At_month=202207", "At_month=202208"]
    with pytest.raises(ValueError):
        mc.write_table(frame, path, partition_grain="day")


def test_write_catalog_table(spark):
    frame = spark.createDataFrame([(1, "a")], "id int, s string")
    for _ in range(2):
        mc.write_table(frame, "written_table", as_table=True, cluster_by=["S"])
    assert rows(mc.read_table(spark, "written_table", "table")) == [(1, "a"), (1, "a")]
    renamed = mc.read_table(spark, "written_table", "table", contract(s="string", id="string"))
    assert rows(renamed) == [("a", "1"), ("a", "1")]
    assert "clusteringColumns" in str(spark.sql("SHOW TBLPROPERTIES written_table").collect())
    spark.sql("DROP TABLE written_table")


def test_connector_options():
    got = sinks.connector_options("bigquery", "p:d.t", ["day"], ["a", "b"])
    assert got == {
        "table": "p:d.t", "createDisposition": "CREATE_IF_NEEDED", "partitionField": "day", "clusterFields": "a,b",
    }
    with pytest.raises(ValueError):
        sinks.connector_options("bigquery", "p:d.t", ["a", "b"], [])


def test_scratch_space_is_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = sinks.scratch_path(spark, "x"), sinks.scratch_path(spark, "x")
    assert first.startswith(base) and first != second


def test_migrate(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.createDataFrame(
        [(1, "a", 1.25, "2022-07-01"), (2, "b", None, "2022-08-01"), (2, "b", None, "2022-08-01")],
        "id int, name string, price double, day string",
    ).write.orc(source)
    wanted = contract(id="bigint", name="string", price="decimal(38,18)", day="date", extra="int")
    done = mc.migrate(spark, source, wanted, target, decimal=(38, 9), partition_by="name", cluster_by=["id"], strict=True)
    assert done.difference.is_empty()
    assert done.written.schema["price"].dataType.simpleString() == "decimal(38,9)"
    assert rows(done.written.select("id", "name", "price", "day", "extra"))[0] == (
        1, "a", Decimal("1.250000000"), date(2022, 7, 1), None,
    )
    assert mc.compare_with_table(spark, source, wanted, target, multiset=True).is_empty()
    mc.write_table(done.written.limit(1), target, partition_by="name")
    found = mc.compare_with_table(spark, source, wanted, target, multiset=True)
    assert {r.side: r.n_rows for r in found.counts().collect()} == {"only_left": 0, "only_right": 1}


def test_migrate_strict_writes_nothing(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.createDataFrame([("1",), ("x",)], "id string").write.orc(source)
    with pytest.raises(mc.ContractViolation, match="id: 1 values lost"):
        mc.migrate(spark, source, contract(id="int"), target, strict=True)
    assert not os.path.exists(target)


def test_align_partitions(spark, tmp_path):
    old, new = str(tmp_path / "2022"), str(tmp_path / "2023")
    spark.createDataFrame([("1", 1)], "a string, b int").write.orc(old)
    spark.createDataFrame([(2, 2)], "a int, c int").write.orc(new)
    drift, aligned, fresh = mc.align_partitions(spark, old, new)
    assert {r.column_name: (r.status, r.n_lost) for r in drift.collect()} == {
        "a": ("type_differs", 0), "b": ("only_left", None), "c": ("only_right", None),
    }
    assert aligned.schema.simpleString() == "struct<a:int,b:int>" and rows(aligned) == [(1, 1)]
    assert fresh.columns == ["a", "c"]


def test_stateless_operators_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("1", [1.5])], "id string, xs array<double>").write.parquet(path)
    stream = spark.readStream.schema("id string, xs array<double>").parquet(path)
    shaped = mc.conform(stream, contract(id="int", xs="array<decimal(10,1)>"))
    run = shaped.writeStream.format("memory").queryName("conformed").start()
    try:
        run.processAllAvailable()
        assert rows(spark.table("conformed")) == [(1, [Decimal("1.5")])]
    finally:
        run.stop()


def test_month_scan_of_written_table(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, date(2022, 7, 1)), (2, date(2022, 9, 1))], "id int, d date")
    mc.write_table(frame, path, "orc", partition_by="d", partition_grain="month")
    found = mc.scan_months(mc.read_table(spark, path), "d_month", "202207", "202208")
    assert rows(found.select("id")) == [(1,)]
    assert "PartitionFilters: [d_month" in plan_of(found) or "isnotnull(d_month" in plan_of(found)


def test_dynamic_refresh_of_a_catalog_table_keeps_other_partitions(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    mc.write_table(first, "refreshed", partition_by="p", as_table=True)
    again = spark.createDataFrame([("a", 9)], "p string, id int")
    mc.write_table(again, "refreshed", mode="overwrite", dynamic=True, as_table=True, partition_by="p")
    assert rows(spark.table("refreshed").select("id", "p")) == [(2, "b"), (9, "a")]
    spark.sql("DROP TABLE refreshed")


def test_connector_options_without_counterpart_are_refused(spark):
    frame = spark.range(1)
    with pytest.raises(ValueError):
        mc.write_table(frame, "t", "bigquery", mode="overwrite", dynamic=True)


def test_folder_values_keep_their_text(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "01"), (2, "02"), (3, None)], "id int, p string")
    mc.write_table(frame, path, "orc", partition_by="p")
    assert rows(mc.read_table(spark, path, contract=contract(id="int", p="string"))) == [
        (1, "01"), (2, "02"), (3, None),
    ]
    assert rows(mc.read_table(spark, path, contract=contract(id="int", p="int"))) == [(1, 1), (2, 2), (3, None)]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"


def test_migrate_on_a_padded_text_key(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.createDataFrame([(1, "01"), (2, "02")], "id int, p string").write.orc(source)
    done = mc.migrate(spark, source, contract(id="int", p="string"), target, partition_by="p", strict="exact")
    assert done.difference.is_empty() and rows(done.written) == [(1, "01"), (2, "02")]


def test_migrate_by_month_into_a_catalog_table(spark, tmp_path):
    source = str(tmp_path / "s")
    spark.createDataFrame([(1, date(2022, 7, 1)), (2, date(2022, 8, 2))], "id int, d date").write.orc(source)
    wanted = contract(id="int", d="date")
    load = lambda path, **more: mc.migrate(
        spark, path, wanted, "migrated", partition_by="d", partition_grain="month", as_table=True, **more
    )
    assert load(source).difference.is_empty()
    again = str(tmp_path / "again")
    spark.createDataFrame([(7, date(2022, 8, 9))], "id int, d date").write.orc(again)
    done = load(again, mode="overwrite", dynamic=True)
    assert rows(spark.table("migrated").select("id")) == [(1,), (7,)]
    assert {r.side: r.n_rows for r in done.difference.counts().collect()} == {"only_left": 0, "only_right": 1}
    spark.sql("DROP TABLE migrated")


def test_migrate_by_month_into_a_folder(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.createDataFrame([(1, date(2022, 7, 1))], "id int, d date").write.orc(source)
    done = mc.migrate(spark, source, contract(id="int", d="date"), target, partition_by="d", partition_grain="month")
    assert done.difference.is_empty() and done.written.columns == ["id", "d", "d_month"]
    assert rows(done.written)[0][2] == "202207"


def test_migrate_strict_reaches_fitted_decimals(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.sql("SELECT CAST(123456.78 AS decimal(20,4)) AS v UNION ALL SELECT 1.2345").write.orc(source)
    wanted = contract(v="decimal(20,4)")
    with pytest.raises(mc.ContractViolation, match="v: 1 values lost"):
        mc.migrate(spark, source, wanted, target, decimal=(5, 2), strict=True)
    with pytest.raises(mc.ContractViolation, match="v: 0 values lost, 0 forbidden nulls, 1 values altered"):
        mc.migrate(spark, source, wanted, target, decimal=(10, 2), strict="exact")
    assert not os.path.exists(target)
    done = mc.migrate(spark, source, wanted, target, decimal=(5, 2), unfitted=True)
    assert {r.side: r.n_rows for r in done.difference.counts().collect()} == {"only_left": 2, "only_right": 2}


def test_connector_grain():
    got = sinks.connector_options("bigquery", "p:d.t", ["day"], [], "month")
    assert got["partitionType"] == "MONTH"
    with pytest.raises(ValueError):
        sinks.connector_options("bigquery", "p:d.t", [], [], "month")
