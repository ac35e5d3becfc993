from __future__ import annotations

import os
import time
import uuid
from collections import Counter

import movecheck as mc
from movecheck.operators import pairing
from movecheck.sources import sinks
from tests.conftest import rows


def wide(spark, n, salt):
    """Rows of nine columns, most of few values; with other salts they differ in more columns than two."""
    return spark.range(n).selectExpr(
        "id % 7 as few", f"id * 10 + {salt} as a", f"id * 100 + {salt} as b", f"concat('n', {salt}, id) as c",
        "cast(id % 2 as string) as flag", "id % 5 as g", f"id + {salt} * 0.5D as h", "id % 3 as i", "'x' as j",
    )


def test_rows_without_a_partner_never_reach_the_column_sets(spark):
    rows, names = pairing._difference(wide(spark, 1000, 1), wide(spark, 900, 2), None, None)
    for level in (1, 2):
        assert pairing._blocks(rows, len(names), level).count() == 0
    found = mc.pair_changed_rows(wide(spark, 1000, 1), wide(spark, 900, 2))
    assert Counter(r["status"] for r in found.collect()) == {"only_left": 1000, "only_right": 900}


def test_rows_with_a_partner_reach_the_sets_that_may_hold_it(spark):
    left, right = wide(spark, 1000, 1), wide(spark, 1000, 1).selectExpr("few", "a + 1 as a", "b", "c", "flag", "g + 5 as g", "h", "i", "j")
    rows, names = pairing._difference(left, right, None, None)
    assert pairing._blocks(rows, len(names), 2).filter("no >= 0").select("no").distinct().count() == 1
    found = mc.pair_changed_rows(left, right).collect()
    assert len(found) == 1000 and {tuple(r["changed"]) for r in found} == {("a", "g")}


def test_values_that_hashes_or_json_pass_over(spark):
    schema = "k int, l array<int>, m string, n int"
    left = spark.createDataFrame([(1, [None, 1], "p", 1), (2, [], None, None), (3, [1], "q", None)], schema)
    right = spark.createDataFrame([(1, [1, None], "p", 1), (2, None, None, None), (3, [1], None, 5)], schema)
    got = {r["left"]["k"]: r["changed"] for r in mc.pair_changed_rows(left, right).collect()}
    assert got == {1: ["l"], 2: ["l"], 3: ["m", "n"]}
    times = [
        spark.sql(f"select 1 as k, 2 as n, timestamp_ntz'2020-01-01 00:00:00.{digits}' as t") for digits in ("123456", "123457")
    ]
    (row,) = mc.pair_changed_rows(*times).collect()
    assert row["status"] == "changed" and row["changed"] == ["t"]


def test_steps_leave_no_shuffle_files_and_no_scratch(spark, monkeypatch, tmp_path):
    """What a step is done with goes; before, all shuffles and every saved frame stayed."""
    monkeypatch.setattr(sinks, "scratch_path", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles
    before, cleanup = files().size(), spark.conf.get(sinks.CLEANUP)
    found = mc.pair_changed_rows(*changed_lines(spark))
    for _ in range(20):
        if files().size() <= before:
            break
        time.sleep(0.5)
    assert files().size() <= before and spark.conf.get(sinks.CLEANUP) == cleanup
    assert {name.split("-")[0] for name in os.listdir(tmp_path)} == {"matched", "free", "pairs"}
    assert Counter(r["status"] for r in found.collect()) == {"changed": 600, "only_left": 300, "only_right": 300}


def changed_lines(spark):
    """1,200 rows of which a quarter each differ in no, one, two and three columns."""
    left = wide(spark, 1200, 1)
    turn = "cast(substring(c, 3) as int) % 4"
    return left, left.selectExpr(
        "few", f"a + if({turn} > 0, 1, 0) as a", "b", "c", "flag", f"g + if({turn} > 1, 5, 0) as g", f"h + if({turn} > 2, 0.25D, 0) as h", "i", "j"
    )


def test_passes_give_the_same_pairs(spark, monkeypatch, tmp_path):
    """Tables and frames taken in passes, and blocks with places by slots, give the rows of one pass."""
    want = rows(mc.pair_changed_rows(*changed_lines(spark)))
    for name, value in {"PASS_BYTES": 0, "PASS_ROWS": 0, "HOT_BLOCK": 1}.items():
        monkeypatch.setattr(pairing, name, value)
    for name, frame in zip(("left", "right"), changed_lines(spark)):
        frame.repartition(3).write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / name)) for name in ("left", "right"))
    assert len(pairing._shares(left, right, None, None)) == pairing.PASSES
    assert len(pairing._shares(left.limit(5), right, None, None)) == 1
    found, names = pairing._difference(left, right, None, None)
    assert found.select("id").distinct().count() == found.count() == 1800
    assert rows(mc.pair_changed_rows(left, right)) == want


def test_blocks_with_many_pairs_are_looked_up_by_sets(spark):
    """A segment's block of many rows on both sides makes no pair of each."""
    left = spark.range(200).selectExpr("'k' as a", "'k' as b", "id % 2 as c", "id as d")
    right = spark.range(200).selectExpr("'k' as a", "'k' as b", "id % 2 as c", "id + 1000 as d")
    difference, names = pairing._difference(left, right, None, None)
    blocks = pairing._blocks(difference, len(names), 1)
    assert blocks.count() == 400 and blocks.select("no").distinct().count() == 1
    found = mc.pair_changed_rows(left, right, max_changed=1).collect()
    assert len(found) == 200 and all(r["changed"] == ["d"] and r["left"]["c"] == r["right"]["c"] for r in found)
