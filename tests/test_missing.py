from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import movecheck as mc
from tests.conftest import plan_of, rows


def test_missing_rows(spark):
    src = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n"), (3, "d"), (3, "d")], "K int, v string")
    tgt = spark.createDataFrame([(2,), (2,), (None,)], "k bigint")
    wanted = [(1, "a"), (1, "b"), (3, "d"), (3, "d")]
    assert rows(mc.missing_rows(src, tgt, ["k"])) == wanted
    assert rows(mc.missing_rows(src, tgt, ["k"], unique_target=True)) == wanted
    plain = mc.missing_rows(src, tgt, ["k"], null_safe=False)
    assert rows(plain) == sorted([*wanted, (None, "n")], key=repr)
    assert plain.columns == ["K", "v"]
    assert rows(mc.missing_rows(src, src, ["k", "v"])) == []


def test_hot_keys_are_split(spark):
    """A third of the rows share a key, on both sides, and no side is small."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        src = spark.range(0, 120_000, numPartitions=8).select(
            hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
        )
        tgt = spark.range(60_000, 200_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, F.lit(60_001)).otherwise(F.col("id")).alias("k")
        )
        for null_safe in (True, False):
            found = mc.missing_rows(src, tgt, ["k"], null_safe).agg(F.count("*"), F.max("v"))
            plan = plan_of(found)
            assert "skew=true" in plan
            assert found.collect()[0][0] == 120_000 - 40_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_copy_missing_twice_adds_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    src = spark.range(10).selectExpr("id AS k", "id * 2 AS v")
    mc.write_table(src.filter("k < 4"), target)
    for _ in range(2):
        mc.copy_missing(src, mc.read_table(spark, target, "parquet"), ["k"], target)
        assert rows(mc.read_table(spark, target, "parquet")) == rows(src)
    split = str(tmp_path / "split")
    mc.write_table(src.filter("k < 4"), split, partition_by="v")
    tgt = mc.read_table(spark, split, "parquet")
    mc.copy_missing(src, tgt, ["k"], split, partition_by="v")
    assert mc.reconcile(src, spark.read.parquet(split), ["k", "v"], multiset=True).is_empty()


def test_month_keys(spark):
    keys = mc.month_keys("202207", "202407")
    assert len(keys) == 25 and keys[0] == "202207" and keys[-1] == "202407" and "202212" in keys
    assert [r.yyyymm for r in mc.months_between(spark, "202207", "202407").collect()] == keys
    assert mc.month_keys("202212", "202212") == ["202212"]
    assert mc.month_keys("202301", "202212") == [] == mc.months_between(spark, "202301", "202212").collect()
    for bad in ("2022", "202213", "2022-01"):
        with pytest.raises(ValueError):
            mc.month_keys(bad, "202301")


def test_missing_months(spark):
    days = [date(2021, 12, 31), date(2022, 2, 1), date(2022, 2, 28), date(2022, 5, 1), date(2022, 6, 1)]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r.yyyymm for r in mc.missing_months(frame, "D", "202201", "202205").orderBy("yyyymm").collect()] == [
        "202201", "202203", "202204",
    ]
    assert rows(mc.month_coverage(frame, "d", "202202", "202203")) == [("202202", 2), ("202203", 0)]


@pytest.mark.parametrize("ddl", ["timestamp", "timestamp_ntz"])
def test_scan_months_by_time(spark, ddl, tmp_path):
    times = [datetime(2022, 6, 30, 23, 59, 59), datetime(2022, 7, 1), datetime(2022, 12, 31, 23, 59, 59), datetime(2023, 1, 1)]
    path = str(tmp_path / "t")
    spark.createDataFrame([(t,) for t in times], f"t {ddl}").write.parquet(path)
    found = mc.scan_months(spark.read.parquet(path), "t", "202207", "202212")
    assert sorted(r.t for r in found.collect()) == times[1:3]
    assert "GreaterThanOrEqual(t," in plan_of(found)


@pytest.mark.parametrize("as_text", [False, True])
def test_scan_months_prunes_folders(spark, tmp_path, as_text):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(i, m) for i, m in enumerate(["202206", "202207", "202301", "202408"])], "v int, ym string")
    mc.write_table(frame, path, "orc", partition_by="ym")
    reader = spark.read.schema("v int, ym string") if as_text else spark.read
    found = mc.scan_months(reader.orc(path), "ym", "202207", "202407")
    assert rows(found) == [(1, "202207"), (2, "202301")]
    pushed = plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    assert "ym" in pushed


def test_failure_reports(spark):
    runs = spark.createDataFrame(
        [
            ("big_table", "refresh", "failed"), ("big_table", "load", "failed"), ("big_table", "ok", "success"),
            ("a", "refresh", "success"), ("c", "load", "failed"), (None, "load", "failed"),
        ],
        "table string, task string, status string",
    )
    assert rows(mc.failure_summary(runs)) == [("big_table", 2), ("c", 1)]
    assert rows(mc.failure_message(runs)) == [
        ("2 tables failed to load.",),
        ("The following tables failed to load: big_table",), ("The following tables failed to load: c",),
    ]
    fine = runs.filter("status = 'success'")
    assert rows(mc.failure_summary(fine)) == []
    assert rows(mc.failure_message(fine)) == [("All tables loaded successfully.",)]


def test_keys_of_two_types(spark):
    texts = spark.createDataFrame([("a",), ("7",), ("07",), (None,)], "k string")
    numbers = spark.createDataFrame([(7,), (8,)], "k int")
    assert rows(mc.missing_rows(texts, numbers, ["k"])) == [("07",), ("a",), (None,)]
    assert rows(mc.missing_rows(numbers, texts, ["k"], null_safe=False)) == [(8,)]
