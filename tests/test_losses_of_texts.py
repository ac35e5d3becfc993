from __future__ import annotations

import movecheck as mc


def contract(kind):
    return mc.Contract.from_rows([{"src_column_name": "x", "source_datatype": kind, "isnullable": "false"}])


def test_each_cast_is_made_once(spark):
    texts = spark.createDataFrame([("1",), ("x",), (None,)], "x string")
    found = mc.contract_losses(texts, contract("int"))
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count(" as int)") == 1


def test_losses_of_hostile_texts(spark):
    values = ["1", "-1", "+7", "1.", "1.0", "1.5", "1e2", "15e-1", " 3 ", "5\n", "1.50", "1.505", "0.001", "x", "", ".5", "99999999999", None]
    texts = spark.createDataFrame([(v,) for v in values], "x string")

    def counts(kind):
        (r,) = mc.contract_losses(texts, contract(kind)).collect()
        return r["n_rows"], r["n_nulls"], r["n_lost"], r["n_altered"], r["n_violations"]

    plain = {}
    for kind in ("int", "decimal(9,2)"):
        lost = altered = 0
        for v in values[:-1]:
            one = spark.createDataFrame([(v,)], "x string")
            (cast,) = one.selectExpr(f"try_cast(x as {kind}) as y", "try_cast(x as decimal(38,12)) as z").collect()
            lost += cast["y"] is None
            altered += cast["y"] is not None and cast["y"] != cast["z"]
        plain[kind] = (lost, altered)
    for kind, (lost, altered) in plain.items():
        n_rows, n_nulls, n_lost, n_altered, n_violations = counts(kind)
        assert (n_rows, n_nulls, n_violations) == (len(values), 1, n_lost + 1)
        assert n_lost <= lost + 1 and (kind == "int" or (n_lost, n_altered) == (lost, altered))


def test_types_at_their_ends(spark):
    ends = {
        "2147483647": "int", "-2147483648": "int", "2147483648": "bigint", "-2147483649": "bigint",
        "9223372036854775807": "bigint", "9223372036854775808": "decimal(19,0)", "-0": "string", "-0.0": "double",
        "007": "string", "1.50": "decimal(3,2)", "2020-01-31": "date", "2020-02-31": "string",
        "2020-01-31 10:00:00": "timestamp_ntz", "2020-01-31 10:00:00.10": "string", "5.": "string",
    }
    rows = spark.createDataFrame([tuple(ends)], ", ".join(f"c{i} string" for i in range(len(ends))))
    got = {r["src_column_name"]: r["source_datatype"] for r in mc.infer_contract(rows).collect()}
    assert [got[f"c{i}"] for i in range(len(ends))] == list(ends.values())
