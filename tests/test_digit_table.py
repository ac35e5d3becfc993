from __future__ import annotations

import random
from decimal import Decimal

import movecheck as mc


def table(spark, values, kind="decimal(38,10)"):
    return mc.digit_table(spark.createDataFrame([(Decimal(v) if v is not None else None,) for v in values], f"x {kind}"))


def test_digits_of_floats_wholes_and_decimals(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (12.50D, CAST(0.1 AS FLOAT), 100, -0.050BD), (-0.5D, CAST('NaN' AS FLOAT), -7, 0.000BD), "
        "(1e20D, CAST(NULL AS FLOAT), 0, 12.000BD), (1.5e-7D, CAST('inf' AS FLOAT), NULL, NULL) AS t(d, f, i, m)"
    )
    got = {(r[0], r[1], r[2]): r[3] for r in mc.digit_table(df).collect()}
    assert got == {
        ("d", 2, 1): 1, ("d", 0, 1): 1, ("d", 21, 0): 1, ("d", 0, 8): 1,
        ("f", 0, 1): 1, ("f", None, None): 2,
        ("i", 3, 0): 1, ("i", 1, 0): 1, ("i", 0, 0): 1,
        ("m", 0, 2): 1, ("m", 0, 0): 1, ("m", 2, 0): 1,
    }


def test_few_odd_values_do_not_decide(spark):
    values = ["1.25"] * 50 + ["123456.5"] * 2 + ["0.123456"] * 3
    digits = table(spark, values)
    (strict,) = mc.smallest_decimals(digits).collect()
    assert strict[1:] == (12, 6, 55, 0, 0)
    (loose,) = mc.smallest_decimals(digits, max_lost=2, max_rounded=3).collect()
    assert loose[1:] == (3, 2, 55, 2, 3)


def test_equals_trying_every_type(spark):
    rng = random.Random(5)
    for _ in range(4):
        values = [f"{rng.randint(0, 10 ** rng.randint(0, 9))}.{rng.randint(0, 10 ** rng.randint(0, 6))}" for _ in range(150)]
        rows = [(r["integer_digits"], r["scale"], r["n_values"]) for r in table(spark, values).collect()]
        for lost, rounded in ((0, 0), (5, 9), (40, 0), (0, 60), (150, 150)):
            options = []
            for i in range(39):
                for s in range(39 - i):
                    gone = sum(n for a, b, n in rows if a > i)
                    cut = sum(n for a, b, n in rows if a <= i and b > s)
                    if gone <= lost and cut <= rounded:
                        options.append((max(i + s, 1), gone, cut))
            (best,) = mc.smallest_decimals(table(spark, values), lost, rounded).collect()
            assert (best["precision"], best["n_lost"], best["n_rounded"]) == min(options)


def test_values_beyond_any_decimal(spark):
    df = spark.sql("SELECT * FROM VALUES (1e300D), (CAST('NaN' AS DOUBLE)), (2.5D) AS t(x)")
    (none,) = mc.smallest_decimals(mc.digit_table(df)).collect()
    assert (none["precision"], none["n_values"]) == (None, 3)
    (some,) = mc.smallest_decimals(mc.digit_table(df), max_lost=2).collect()
    assert some[1:] == (2, 1, 3, 2, 0)


def test_empty_and_unnumbered(spark):
    assert mc.smallest_decimals(mc.digit_table(spark.range(0))).isEmpty()
    assert mc.digit_table(spark.sql("SELECT 'a' AS t")).isEmpty()
