"""Profiles merged from stored states, and profiles from footers, against one pass over the rows."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import movecheck as mc
from movecheck.operators import profile_store
from movecheck.sources.footers import footer_profile, pushed_aggregates
from tests.conftest import by_name, plan_of, rows

KINDS = "m string, i int, d double, t string, e date, x decimal(12,3), b boolean, a array<int>, p map<string,int>, z timestamp"


def table(spark, n=3000):
    rng = random.Random(2)
    data = []
    for k in range(n):
        data.append((
            rng.choice(["202401", "202402", "202403", None]), rng.choice([None, rng.randint(-5000, 99)]),
            rng.choice([None, float("nan"), -2.5, 1.5e-7, 1e20, rng.random()]), rng.choice([None, "", f"v{k % 70}"]),
            datetime.date(2024, 1, 1) + datetime.timedelta(rng.randint(-400, 400)), Decimal(rng.randint(-10**6, 10**6)) / 1000,
            rng.choice([True, False, None]), [k % 9, None], {"a": k}, datetime.datetime(2024, 1, 1, 0, 0, 0, k),
        ))
    return spark.createDataFrame(data, KINDS)


def test_merged_states_equal_one_pass(spark, tmp_path):
    frame, path = table(spark), str(tmp_path / "store")
    mc.refresh_profile_store(frame.filter("m is null or m < '202403'"), path, "m")
    mc.refresh_profile_store(frame, path, "m", parts=["202403"])
    states = mc.read_profile_store(spark, path)
    merged = mc.merged_profile(states)
    plain = mc.profile_columns(frame.drop("m"), exact_distinct=True)
    assert rows(merged.drop("n_distinct")) == rows(plain.drop("n_distinct"))
    exact, found = by_name(plain), by_name(merged)
    for name in exact:
        want = exact[name]["n_distinct"]
        if want is None:
            assert found[name]["n_distinct"] is None
        else:
            assert abs(found[name]["n_distinct"] - want) <= 1 + 4 * profile_store.DISTINCT_ERROR * want
    # A part alone, by its states alone.
    one = mc.merged_profile(states.filter("part = '202402'")).drop("n_distinct")
    assert rows(one) == rows(mc.profile_columns(frame.filter("m = '202402'").drop("m")).drop("n_distinct"))


def test_refresh_replaces_one_partition_and_reads_no_other(spark, tmp_path):
    frame, path, data = table(spark), str(tmp_path / "store"), str(tmp_path / "data")
    frame.select("m", "i", "t").write.partitionBy("m").parquet(data)
    stored = spark.read.schema("i int, t string, m string").parquet(data)
    mc.refresh_profile_store(stored, path, "m")
    before = rows(mc.read_profile_store(spark, path).filter("part <> '202402'"))
    changed = stored.withColumn("i", F.lit(7))
    mc.refresh_profile_store(changed, path, "m", parts=["202402", "202501"])
    states = mc.read_profile_store(spark, path)
    assert rows(states.filter("part not in ('202402', '202501')")) == before
    assert by_name(mc.merged_profile(states.filter("part = '202402'")))["i"]["min_value"] == "7"
    assert by_name(mc.merged_profile(states.filter("part = '202501'")))["i"]["n_rows"] == 0
    plan = plan_of(mc.profile_states(stored.filter(F.col("m").isin(["202402"])), "m"))
    assert "PartitionFilters: [isnotnull(m" in plan or "PartitionFilters: [(m" in plan
    # Rows that went leave no state behind.
    mc.refresh_profile_store(stored.filter("m <> '202401'"), path, "m", parts=["202401"])
    assert mc.read_profile_store(spark, path).filter("part = '202401'").agg(F.sum("n_rows")).first()[0] == 0


def test_quantile_ranks(spark, tmp_path):
    frame = spark.range(20_000).select((F.col("id") % 7).alias("m"), (F.col("id") * 1.0).alias("d"), F.lit(None).cast("int").alias("n"))
    states = mc.profile_states(frame, "m")
    found = mc.merged_quantiles(states, [0.0, 0.1, 0.5, 0.99, 1.0]).collect()
    assert {r["column_name"] for r in found} == {"d"}
    for r in found:
        assert abs(r["value"] / 20_000 - r["probability"]) <= profile_store.RANK_ERROR


def test_store_of_nothing(spark, tmp_path):
    frame = table(spark, 5).limit(0)
    mc.refresh_profile_store(frame, str(tmp_path / "s"), "m", parts=["202401"])
    merged = by_name(mc.merged_profile(mc.read_profile_store(spark, str(tmp_path / "s"))))
    assert merged["i"]["n_rows"] == 0 and merged["i"]["min_value"] is None
    with pytest.raises(ValueError):
        mc.profile_states(frame.select("m"), "m")


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_footers(spark, tmp_path, fmt):
    frame, path = table(spark).drop("p"), str(tmp_path / "f")
    frame.repartition(3).write.format(fmt).save(path)
    found = by_name(footer_profile(spark, path, fmt))
    want = by_name(mc.profile_columns(frame, count_distinct=False))
    for name, row in found.items():
        assert {k: v for k, v in row.items() if k != "source"} == {k: want[name][k] for k in row if k != "source"}, name
    assert {n for n, r in found.items() if r["source"] == "footer"} == {"i", "e", "b"}
    assert found["a"]["source"] is None and found["d"]["max_value"] == "NaN"
    plan = pushed_aggregates(spark, path, fmt, ["i", "e", "t"])._jdf.queryExecution().toString()
    assert "PushedAggregation: [" in plan and "MIN(i)" in plan and "COUNT(t)" in plan and "MIN(t)" not in plan
    assert spark.conf.get(f"spark.sql.{fmt}.aggregatePushdown") == "false"


def test_files_without_statistics_are_scanned(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"i": [1, None, 3]}), tmp_path / "f.parquet", write_statistics=False)
    found = by_name(footer_profile(spark, str(tmp_path / "f.parquet")))["i"]
    assert (found["n_rows"], found["n_nulls"], found["min_value"], found["source"]) == (3, 1, "1", "scan")
    with pytest.raises(ValueError):
        pushed_aggregates(spark, "x", "csv")
