import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from zilverspoor.contracts import CONTRACTS, TableContract
from zilverspoor.operators.conform import (
    conform,
    harmonise_decimals,
    portable_type,
    to_bronze,
    widen_decimals,
)
from zilverspoor.plans import MAPPINGS


@pytest.mark.parametrize(
    "source, target",
    [
        (T.DecimalType(4, 0), T.ShortType()),
        (T.DecimalType(9, 0), T.IntegerType()),
        (T.DecimalType(11, 0), T.LongType()),
        (T.DecimalType(18, 0), T.LongType()),
        (T.DecimalType(20, 0), T.DecimalType(20, 0)),
        (T.DecimalType(10, 2), T.DecimalType(10, 2)),
        (T.FloatType(), T.FloatType()),
        (T.VarcharType(3), T.StringType()),
        (T.TimestampType(), T.TimestampNTZType()),
        (T.BinaryType(), T.BinaryType()),
        (T.DayTimeIntervalType(), T.StringType()),
    ],
)
def test_portable_type(source, target):
    assert portable_type(source) == target


def test_one_digit_number_is_boolean_only_when_asked():
    assert portable_type(T.DecimalType(1, 0), one_digit_is_boolean=True) == T.BooleanType()
    assert portable_type(T.DecimalType(1, 0)) == T.ShortType()


def test_values_survive_bronze(spark):
    big = 9_223_372_036_854_775_000
    schema = "ID bigint, BIG decimal(20,0), TXT string, D date, TS timestamp_ntz, F double, B boolean"
    ts = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    data = [
        (1, Decimal(-big), "a\x00b", dt.date(2024, 2, 29), ts, 1.5, True),
        (2, None, None, None, None, None, None),
        (3, Decimal(big), "", dt.date(1, 1, 1), ts, -0.0, False),
    ]
    got = to_bronze(spark.createDataFrame(data, schema)).orderBy("id").collect()
    assert tuple(got[0]) == (1, Decimal(-big), "ab", dt.date(2024, 2, 29), ts, 1.5, True)
    assert tuple(got[1]) == (2, None, None, None, None, None, None)
    assert got[2]["txt"] == ""


def test_decimals_widen_without_losing_digits(spark):
    assert widen_decimals(T.DecimalType(10, 2), T.DecimalType(8, 6)) == T.DecimalType(14, 6)
    with pytest.raises(ValueError):
        widen_decimals(T.DecimalType(38, 0), T.DecimalType(38, 20))
    one = spark.createDataFrame([(Decimal("12345678.90"),)], "P decimal(10,2)")
    two = spark.createDataFrame([(Decimal("1.234567"),)], "p decimal(8,6)")
    both = harmonise_decimals([one, two])
    assert both.schema["p"].dataType == T.DecimalType(14, 6)
    assert {r["p"] for r in both.collect()} == {Decimal("12345678.900000"), Decimal("1.234567")}


def test_conform_splits_rows(spark):
    contract = TableContract(
        "T",
        T.StructType(
            [
                T.StructField("ID", T.VarcharType(3)),
                T.StructField("N", T.IntegerType()),
                T.StructField("MISSING", T.DateType()),
            ]
        ),
        primary_key=("ID",),
    )
    df = spark.createDataFrame(
        [("abc", "1"), ("abcd", "2"), ("a", "x"), (None, "3"), ("b", None)], "id string, n string"
    )
    result = conform(df, contract)
    assert sorted(tuple(r) for r in result.accepted.collect()) == [("abc", 1, None), ("b", None, None)]
    problems = sorted(p for r in result.rejected.collect() for p in r["problems"])
    assert problems == ["cast:N", "length:ID", "null:ID"]


def test_every_mapping_has_a_contract():
    assert set(MAPPINGS) == set(CONTRACTS)


def test_reasons_are_only_gathered_for_rows_that_have_some(spark):
    """The array takes a loop over its values, which no row without a reason should pay for."""
    contract = TableContract("T", T.StructType([T.StructField("A", T.IntegerType()), T.StructField("B", T.VarcharType(2))]))
    df = spark.createDataFrame([("1", "xy"), ("x", "xyz"), ("2", "xyz"), (None, None)], "a string, b string")
    checked = conform(df, contract).checked
    got = {(r["A"], r["B"], tuple(r["__problems"])) for r in checked.collect()}
    assert got == {
        (1, "xy", ()), (None, "xyz", ("cast:A", "length:B")), (2, "xyz", ("length:B",)), (None, None, ())
    }
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"CASE WHEN isnotnull\(coalesce\(.* THEN \w+\(filter\(array\(", plan)


def test_only_values_that_may_not_fit_are_looked_at(spark):
    fields = [T.StructField("A", T.VarcharType(20)), T.StructField("B", T.VarcharType(5)), T.StructField("C", T.LongType())]
    contract = TableContract("T", T.StructType(fields), primary_key=("A",))
    df = spark.createDataFrame([(-(2**63), 12345, 7), (None, 123456, None)], "a long, b int, c long")
    got = {tuple(r) for r in conform(df, contract).rejected.selectExpr("A", "B", "C", "array_join(problems, ' ')").collect()}
    assert got == {(None, "123456", None, "null:A length:B")}
    assert conform(df, contract).accepted.collect() == [(str(-(2**63)), "12345", 7)]
    plan = conform(df, contract).checked._jdf.queryExecution().optimizedPlan().toString()
    assert "length:B" in plan and "length:A" not in plan and "cast:C" not in plan
