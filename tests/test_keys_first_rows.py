from __future__ import annotations

import movecheck as mc
from movecheck.operators import keys


def watched(monkeypatch):
    seen = []
    plain = keys._ruled_out

    def ruled_out(df, sets, slices):
        seen.append((slices, [tuple(s) for s in sets]))
        return plain(df, sets, slices)

    monkeypatch.setattr(keys, "_ruled_out", ruled_out)
    return seen


def test_sets_with_many_repeats_are_ruled_out_before_all_rows_are_read(spark, monkeypatch):
    monkeypatch.setattr(keys, "FIRST_ROWS", 2000, raising=False)
    seen = watched(monkeypatch)
    df = spark.range(20000).selectExpr("id div 2 as d", "id % 2 as t", "id % 50 as q", "cast(id % 7 as string) as w")
    assert [tuple(r["key"]) for r in mc.unique_keys(df, max_columns=2).collect()] == [("d", "t"), ("d", "q")] + [("d", "w")]
    on_all_rows = [s for slices, sets in seen if slices > 1 for s in sets]
    assert not {("t",), ("q",), ("w",), ("t", "q"), ("t", "w"), ("q", "w")} & set(on_all_rows)


def test_one_repeat_in_all_rows_is_found(spark, monkeypatch):
    monkeypatch.setattr(keys, "FIRST_ROWS", 100, raising=False)
    df = spark.range(5000).selectExpr("if(id = 4999, 17, id) as a", "if(id = 4999, null, id) as b", "id % 3 as c")
    assert [(r["key"], r["n_null_rows"]) for r in mc.unique_keys(df, max_columns=2).collect()] == [(["b"], 1), (["a", "c"], 0)]
