from __future__ import annotations

import datetime

import pytest

import movecheck as mc
from movecheck.sources import publish as module
from tests.conftest import rows

SCHEMA = "part string, x int"


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "table")


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def seen(spark, target, df, **options):
    return rows(mc.read_published(spark, target, df.schema, **options))


def test_partitions_are_replaced_and_old_versions_stay(spark, target):
    one = frame(spark, ("a", 1), ("a", 1), ("b", 2), (None, 3), ("", 4), ("x/y=z", 5))
    assert mc.publish(one, target, "part", "r1", per_batch=2) == 1
    assert seen(spark, target, one) == rows(one)
    two = frame(spark, ("b", 20), ("c", 30), (None, 40))
    assert mc.publish(two, target, "PART", "r2") == 2
    assert seen(spark, target, one) == rows(frame(spark, ("a", 1), ("a", 1), ("", 4), ("x/y=z", 5), ("b", 20), ("c", 30), (None, 40)))
    assert seen(spark, target, one, version=1) == rows(one)
    assert seen(spark, target, one, values=["a", None]) == rows(frame(spark, ("a", 1), ("a", 1), (None, 40)))
    assert mc.publish(frame(spark, ("d", 9)), target, "part", "r3", replace_all=True) == 3
    assert seen(spark, target, one) == [("d", 9)]


def test_a_failed_run_goes_on_where_it_was(spark, target, monkeypatch):
    old = frame(spark, ("a", 0), ("e", 0))
    mc.publish(old, target, "part", "r1")
    new = frame(spark, *[(p, i) for i, p in enumerate("abcdefgh" * 3)])
    written = []
    real = module.write_table

    def failing(df, folder, **options):
        written.append(folder)
        if len(written) == 3:
            real(df.limit(1), folder, **options)  # some of its files are there
            raise RuntimeError("executor lost")
        real(df, folder, **options)

    monkeypatch.setattr(module, "write_table", failing)
    with pytest.raises(RuntimeError):
        mc.publish(new, target, "part", "r2", per_batch=2)
    assert seen(spark, target, old) == rows(old)
    assert mc.publish(new, target, "part", "r2", per_batch=2) == 2
    assert [f.rsplit("=", 1)[1] for f in written] == ["0", "1", "2", "2", "3"]
    assert seen(spark, target, new) == rows(new)
    assert mc.publish(new, target, "part", "r2") == 2 and len(written) == 5


def test_failure_between_data_and_record(spark, target, monkeypatch):
    df = frame(spark, ("a", 1), ("b", 2))
    real = module._write_record

    def failing(rows_, path):
        if "/done/" in path:
            raise RuntimeError("driver lost")
        real(rows_, path)

    monkeypatch.setattr(module, "_write_record", failing)
    with pytest.raises(RuntimeError):
        mc.publish(df, target, "part", "r1")
    assert seen(spark, target, df) == []
    monkeypatch.setattr(module, "_write_record", real)
    mc.publish(df, target, "part", "r1")
    assert seen(spark, target, df) == rows(df)


def test_stops_after_batches_and_sees_a_changed_source(spark, target):
    df = frame(spark, ("a", 1), ("b", 2), ("c", 3))
    assert mc.publish(df, target, "part", "r1", per_batch=1, max_batches=2) is None
    assert mc.published_versions(spark, target).count() == 0
    with pytest.raises(mc.SourceChanged, match="c"):
        mc.publish(frame(spark, ("a", 1), ("b", 2), ("c", 3), ("c", 4)), target, "part", "r1", per_batch=1)
    assert seen(spark, target, df) == []
    assert mc.publish(df, target, "part", "r1", per_batch=1) == 1
    assert seen(spark, target, df) == rows(df)


def test_dates_empty_frames_and_refusals(spark, target):
    df = spark.createDataFrame([(datetime.date(2024, 1, d), d) for d in (1, 2, 2)], "day date, n int")
    assert mc.publish(df.limit(0), target, "day", "r0") == 1
    assert seen(spark, target, df) == []
    assert mc.publish(df, target, "day", "r1", per_batch=1) == 2
    assert seen(spark, target, df) == rows(df)
    assert mc.publish(df.limit(0), target, "day", "r2", replace_all=True) == 3
    assert seen(spark, target, df) == [] and seen(spark, target, df, version=2) == rows(df)
    for bad, name in ((df.withColumn("__slot", df.n), "day"), (df.withColumn("f", df.n.cast("double")), "f")):
        with pytest.raises(ValueError):
            mc.publish(bad, target, name, "r4")
    with pytest.raises(ValueError):
        mc.publish(df, target, "day", "a/b")
