from __future__ import annotations

import pytest
from pyspark.sql import types as T

from movecheck.functions.types import common_type, contract_type

# Columns need a session.
pytestmark = pytest.mark.usefixtures("spark")


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("string", T.StringType()),
        ("INT", T.IntegerType()),
        ("Float", T.FloatType()),
        ("boolean", T.BooleanType()),
        ("date", T.DateType()),
        ("timestamp", T.TimestampType()),
        ("bigint", T.LongType()),
        ("double", T.DoubleType()),
        ("decimal(38,9)", T.DecimalType(38, 9)),
        ("NUMERIC(28, 9)", T.DecimalType(28, 9)),
        ("numeric", T.DecimalType(38, 9)),
        ("decimal()", T.DecimalType(38, 9)),
        ("decimal(a,b)", T.DecimalType(38, 9)),
        ("decimal(1,2,3)", T.DecimalType(38, 9)),
        ("numeric(10)", T.DecimalType(10, 0)),
        ("ARRAY<FLOAT>", T.ArrayType(T.FloatType())),
        ("array< array<int> >", T.ArrayType(T.ArrayType(T.IntegerType()))),
        ("array<decimal(10,2)>", T.ArrayType(T.DecimalType(10, 2))),
        ("geography", T.StringType()),
        ("", T.StringType()),
        (None, T.StringType()),
    ],
)
def test_contract_type(text, wanted):
    assert contract_type(text) == wanted


@pytest.mark.parametrize("text", ["decimal(40,2)", "decimal(5,6)", "numeric(0)", "decimal(5,-1)"])
def test_decimal_out_of_range_is_refused(text):
    with pytest.raises(ValueError):
        contract_type(text)


@pytest.mark.parametrize("text", ["geography", "", "decimal(a,b)", "array<thing>"])
def test_strict_refuses_unknown(text):
    with pytest.raises(ValueError):
        contract_type(text, strict=True)


@pytest.mark.parametrize(
    "left, right, wanted",
    [
        ("int", "bigint", "bigint"),
        ("float", "double", "double"),
        ("int", "double", "double"),
        ("int", "decimal(5,2)", "decimal(12,2)"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("decimal(38,18)", "decimal(38,9)", "string"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("string", "int", "string"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("struct<a:int>", "struct<a:bigint>", "struct<a:bigint>"),
        ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("void", "int", "int"),
    ],
)
def test_common_type(left, right, wanted):
    parse = T.DataType.fromDDL
    assert common_type(parse(left), parse(right)).simpleString() == wanted
    assert common_type(parse(right), parse(left)).simpleString() == wanted


def test_no_common_type():
    with pytest.raises(TypeError):
        common_type(T.ArrayType(T.IntegerType()), T.IntegerType())
