from __future__ import annotations

import movecheck as mc
from movecheck.__main__ import main
from tests.conftest import by_name, rows

CONTRACT = "\n".join(
    ["src_column_name|target_column_name|source_datatype|isnullable", "id|key|bigint|false", "price|price|decimal(38,9)|true"]
)


def prepare(spark, tmp_path):
    source, contract = str(tmp_path / "source"), tmp_path / "contract.csv"
    spark.createDataFrame([(1, 1.5), (2, 2.25)], "id int, price double").write.orc(source)
    contract.write_text(CONTRACT, encoding="ISO-8859-1")
    return source, str(contract)


def test_load_then_reconcile(spark, tmp_path):
    source, contract = prepare(spark, tmp_path)
    target, reports = str(tmp_path / "target"), [str(tmp_path / f"report{i}") for i in range(3)]
    main(["--output", reports[0], "load", "--path", source, "--contract", contract, "--target", target,
          "--cluster-by", "key", "--decimal", "38,9", "--strict"])
    assert [r.n_rows for r in spark.read.parquet(reports[0]).collect()] == [0, 0]
    compare = ["reconcile", "--path", source, "--contract", contract, "--table", target, "--multiset"]
    main(["--output", reports[1], *compare])
    assert {r.n_rows for r in spark.read.parquet(reports[1]).collect()} == {0}
    mc.write_table(spark.read.parquet(target).filter("key = 1"), target)
    main(["--output", reports[2], *compare])
    found = spark.read.parquet(reports[2]).collect()
    assert {(r.entry, r.side, r.n_rows, r.key, r.n_copies) for r in found} == {
        ("count", "only_left", 0, None, None), ("count", "only_right", 1, None, None),
        ("sample", "only_right", None, 1, 1),
    }


def test_profile_and_drift(spark, tmp_path, capsys):
    source, _ = prepare(spark, tmp_path)
    main(["profile", "--path", source, "--exact-distinct"])
    shown = capsys.readouterr().out
    assert "max_precision" in shown and "price" in shown
    main(["profile", "--path", source, "--text-sizes"])
    assert "max_scale" in capsys.readouterr().out
    newer, aligned, report = (str(tmp_path / n) for n in ("newer", "aligned", "report"))
    spark.createDataFrame([(3, 1)], "id bigint, price int").write.orc(newer)
    main(["--output", report, "drift", "--old", source, "--new", newer, "--aligned", aligned])
    assert by_name(spark.read.parquet(report))["id"]["status"] == "type_differs"
    assert spark.read.orc(aligned).schema.simpleString() == "struct<id:bigint,price:int>"
    assert rows(spark.read.orc(aligned)) == [(1, 1), (2, 2)]
