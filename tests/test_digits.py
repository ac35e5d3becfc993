from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import types as T

import movecheck as mc
from tests.conftest import by_name, plan_of, rows


def profile(spark, values, ddl, **options):
    frame = spark.createDataFrame([(v,) for v in values], f"x {ddl}")
    return by_name(mc.profile_columns(frame, **options))["x"]


def digits(found):
    return found["max_precision"], found["max_integer_digits"], found["max_scale"], found["n_unmeasured"]


@pytest.mark.parametrize(
    "value, wanted",
    [
        (12.5, (3, 2, 1, 0)),
        (-5.0, (2, 1, 1, 0)),
        (0.0, (2, 1, 1, 0)),
        (1.5, (2, 1, 1, 0)),
        (1e7, (9, 8, 1, 0)),
        (1.5e-7, (9, 1, 8, 0)),
        (1e20, (22, 21, 1, 0)),
        (1e-30, (31, 1, 30, 0)),
        (1e300, (302, 301, 1, 0)),
        (-1.25e-20, (23, 1, 22, 0)),
        (math.nan, (None, None, None, 1)),
        (-math.inf, (None, None, None, 1)),
    ],
)
def test_float_digits(spark, value, wanted):
    assert digits(profile(spark, [value], "double")) == wanted


@pytest.mark.parametrize(
    "ddl, values, wanted",
    [
        ("int", [100, -5, None], (3, 3, 0, 0)),
        ("bigint", [-(2**63), 1], (19, 19, 0, 0)),
        ("smallint", [-300, 7], (3, 3, 0, 0)),
        ("int", [None, None], (None, None, None, 0)),
        ("decimal(38,18)", [Decimal(0)], (19, 1, 18, 0)),
        ("decimal(10,3)", [Decimal("-1234.5"), Decimal("0.001")], (7, 4, 3, 0)),
        ("decimal(10,0)", [Decimal("-1234")], (4, 4, 0, 0)),
    ],
)
def test_exact_digits(spark, ddl, values, wanted):
    assert digits(profile(spark, values, ddl)) == wanted


def test_strip_zeros(spark):
    assert digits(profile(spark, [20.0], "double", strip_zeros=True)) == (2, 2, 0, 0)
    found = profile(spark, [Decimal("1.500"), Decimal("10.000")], "decimal(10,3)", strip_zeros=True)
    assert digits(found) == (2, 2, 1, 0)


def test_profile_of_every_kind_of_column(spark):
    frame = spark.createDataFrame(
        [(1, "abc", [1], {"a": 1}, True, None), (1, "\xe9", None, None, False, None), (2, None, [1], None, None, None)],
        "i int, s string, a array<int>, m map<string,int>, b boolean, n double",
    ).selectExpr("*", "cast(s AS binary) AS y", "parse_json('1') AS v", "named_struct('f', i) AS t")
    got = by_name(mc.profile_columns(frame, exact_distinct=True))
    assert len(got) == 9
    assert (got["y"]["n_distinct"], got["y"]["min_value"], got["t"]["n_distinct"]) == (2, None, 2)
    assert (got["v"]["n_distinct"], got["v"]["n_nulls"]) == (None, 0)
    assert (got["i"]["n_rows"], got["i"]["n_nulls"], got["i"]["n_distinct"]) == (3, 0, 2)
    assert (got["i"]["min_value"], got["i"]["max_value"]) == ("1", "2")
    assert (got["s"]["max_length"], got["s"]["n_nulls"], got["s"]["max_scale"]) == (3, 1, None)
    assert (got["a"]["n_distinct"], got["a"]["min_value"], got["a"]["n_nulls"]) == (1, None, 1)
    assert (got["m"]["n_distinct"], got["m"]["n_nulls"]) == (None, 2)
    assert (got["b"]["min_value"], got["b"]["max_value"]) == ("false", "true")
    assert (got["n"]["n_nulls"], got["n"]["max_precision"], got["n"]["n_distinct"]) == (3, None, 0)
    estimated = by_name(mc.profile_columns(frame))
    assert estimated["i"]["n_distinct"] == 2 and estimated["m"]["n_distinct"] is None
    skipped = by_name(mc.profile_columns(frame, ["I"], count_distinct=False))
    assert list(skipped) == ["i"] and skipped["i"]["n_distinct"] is None


def test_profile_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "i int, d double, s string, x decimal(5,2)")
    got = by_name(mc.profile_columns(frame, exact_distinct=True))
    assert all(r["n_rows"] == 0 and r["max_precision"] is None for r in got.values())
    assert rows(mc.numeric_profile(frame, "d")) == [(None, None, None, None, 0, 0, 0)]


def test_numeric_profile(spark):
    frame = spark.createDataFrame([(12.5,), (-5.0,), (None,), (12.5,), (100.25,)], "Amount double")
    assert rows(mc.numeric_profile(frame, "amount")) == [(5, 2, -5.0, 100.25, 4, 3, 0)]
    odd = spark.createDataFrame([(1e30,), (1e30,), (2.5,)], "x double")
    assert rows(mc.numeric_profile(odd, "x")) == [(32, 1, 2.5, 1e30, 3, 2, 0)]
    with pytest.raises(TypeError):
        mc.numeric_profile(spark.createDataFrame([("a",)], "s string"), "s")


def test_profile_runs_without_python(spark):
    frame = spark.range(100).selectExpr("id", "id / 7 AS d", "cast(id AS string) AS s")
    plan = plan_of(mc.profile_columns(frame))
    assert "Python" not in plan and "Arrow" not in plan


def general_text_sizes(value) -> tuple[int, int]:
    """The signed text rule, on Python's own decimal text."""
    sign, digits, exponent = Decimal(str(value)).as_tuple()
    if isinstance(exponent, str):
        return (3, 3) if exponent == "n" else (8, 8 + sign)
    n = len(digits)
    first = exponent + n - 1
    if exponent > 0 or first < -6:
        tail = 2 + len(str(abs(first)))
        return (1 + tail, 1 + tail + sign) if n == 1 else (1, n - 1 + tail)
    return (n, n + sign) if exponent == 0 else (max(n + exponent, 1), -exponent)


FIXED = [
    12.5, -5.0, 0.0, -0.0, 100.0, 1e20, 1.5e-7, -1.5e-7, 1e-7, 1e-6, 1.25e-6, 1e-5, 1e-4, 0.001, 9999999.5,
    1e7, 1e15, 1e16, 1.5e16, 1.2345678901234567e16, 12345678901234567.0, -1.25e17, 1.23e300, -1e-300,
    math.nan, math.inf, -math.inf, 5e15 + 0.5, 123456789012345.6,
]


def each(spark, values, ddl):
    """The text profile of every value alone."""
    found = []
    for start in range(0, len(values), 40):
        part = values[start : start + 40]
        frame = spark.createDataFrame([tuple(part)], ", ".join(f"c{i} {ddl}" for i in range(len(part))))
        got = by_name(mc.text_digit_profile(frame))
        found += [(got[f"c{i}"]["max_precision"], got[f"c{i}"]["max_scale"]) for i in range(len(part))]
    return found


def test_text_digits_of_floats(spark):
    chance = random.Random(5)
    values = FIXED + [
        round(chance.uniform(-10, 10), chance.randint(0, 5)) * 10.0 ** chance.randint(-12, 25) for _ in range(50)
    ]
    got = each(spark, values, "double")
    wanted = [general_text_sizes(v) for v in values]
    wrong = [(v, g, w) for v, g, w in zip(values, got, wanted) if g != w]
    assert not wrong


def test_text_digits_of_exact_numbers(spark):
    ints = [0, 100, -5, -(2**63), 2**63 - 1]
    assert each(spark, ints, "bigint") == [general_text_sizes(v) for v in ints]
    for scale in (0, 2, 6, 9, 18):
        unit = Decimal(1).scaleb(-scale)
        values = [n * unit for n in (0, 1, -1, 12, -12, 120, 123456, -98765432109876)]
        assert each(spark, values, f"decimal(38,{scale})") == [general_text_sizes(v) for v in values]


def test_text_digits_of_narrow_floats_widen_first(spark):
    assert each(spark, [0.1], "float") == [general_text_sizes(0.10000000149011612)]


def test_text_profile_of_a_table(spark):
    frame = spark.createDataFrame(
        [(1, "abc", [1], None), (-22, None, None, None)], "i int, s string, a array<int>, d decimal(10,2)"
    )
    got = by_name(mc.text_digit_profile(frame))
    sizes = {n: (r["max_precision"], r["max_scale"], r["max_length"]) for n, r in got.items()}
    assert sizes == {"i": (2, 3, None), "s": (None, None, 3), "a": (None, None, None), "d": (None, None, None)}
    empty = by_name(mc.text_digit_profile(frame.limit(0)))
    assert all(r["max_scale"] is None for r in empty.values()) and isinstance(frame.schema["d"].dataType, T.DecimalType)
