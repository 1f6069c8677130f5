import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from zilverspoor import functions as Z
from zilverspoor.functions import nested


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    df = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "number, expected",
    [
        (None, None),
        (0, None),
        (-1, None),
        (20240000, dt.date(2024, 1, 1)),
        (20240100, dt.date(2024, 1, 1)),
        (20240015, dt.date(2024, 1, 16)),
        (20240230, None),
        (202, None),
        (20240229, dt.date(2024, 2, 29)),
    ],
)
def test_incomplete_date(spark, number, expected):
    assert one(spark, Z.incomplete_date_to_date(F.col("x")), x=("int", number)) == expected


@pytest.mark.parametrize(
    "number, expected",
    [(20240229, dt.date(2024, 2, 29)), (20230229, None), (2024011, None), (0, None), (None, None)],
)
def test_yyyymmdd_to_date(spark, number, expected):
    assert one(spark, Z.yyyymmdd_to_date(F.col("x")), x=("int", number)) == expected


@pytest.mark.parametrize(
    "utc, day",
    [
        (dt.datetime(2024, 3, 30, 22, 30), dt.date(2024, 3, 30)),
        (dt.datetime(2024, 3, 30, 23, 30), dt.date(2024, 3, 31)),
        (dt.datetime(2024, 3, 31, 22, 30), dt.date(2024, 4, 1)),
        (dt.datetime(2024, 10, 26, 22, 30), dt.date(2024, 10, 27)),
        (dt.datetime(2024, 10, 27, 22, 30), dt.date(2024, 10, 27)),
        (dt.datetime(2024, 10, 27, 23, 30), dt.date(2024, 10, 28)),
        (None, None),
    ],
)
def test_local_date_follows_daylight_saving(spark, utc, day):
    assert one(spark, Z.local_date(F.col("x")), x=("timestamp_ntz", utc)) == day


def test_local_date_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        late = dt.datetime(2024, 7, 1, 22, 30)
        assert one(spark, Z.local_date(F.col("x")), x=("timestamp_ntz", late)) == dt.date(2024, 7, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["Europe/Amsterdam", "America/St_Johns"])
def test_local_date_over_two_centuries(spark, zone):
    step = 86_400 * 3 + 3_607  # all hours of the day, some 24,000 moments from 1890 on
    ts = F.timestamp_seconds(F.col("id") * step - 2_524_000_000).cast("timestamp_ntz")
    slow = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("ts")).cast("date")
    rows = spark.range(24_000).select(ts.alias("ts"))
    assert rows.where(~slow.eqNullSafe(Z.local_date(F.col("ts"), zone))).count() == 0


@pytest.mark.parametrize(
    "number, text",
    [(None, "000000000"), (1, "000000001"), (123456789, "123456789"), (1234567890, "234567890")],
)
def test_format_bsn(spark, number, text):
    assert one(spark, Z.format_bsn(F.col("x")), x=("bigint", number)) == text


@pytest.mark.parametrize("text, padded", [("7", "007"), ("22", "022"), ("1112", "111"), (None, None)])
def test_zero_pad_also_cuts(spark, text, padded):
    assert one(spark, Z.zero_pad(F.col("x"), 3), x=("string", text)) == padded


@pytest.mark.parametrize("a", ["x", None])
@pytest.mark.parametrize("b", [1, None])
def test_two_kinds_of_concatenation(spark, a, b):
    skip = Z.concat_skip_null(F.col("a"), F.col("b"))
    propagate = Z.concat_propagate(F.col("a"), F.col("b"))
    values = {"a": ("string", a), "b": ("int", b)}
    assert one(spark, skip, **values) == (a or "") + ("" if b is None else str(b))
    assert one(spark, propagate, **values) == (None if a is None or b is None else f"{a}{b}")


def test_address_line_keeps_or_drops_separators(spark):
    names = ["street", "number", "letter", "addition", "marker", "digits", "letters", "town"]
    values = dict(zip(names, ["Kade", "1", None, "bis", None, "7500", "AB", None]))
    typed = {k: ("string", v) for k, v in values.items()}
    plain = Z.address_line(*[F.col(n) for n in names])
    clean = Z.address_line(*[F.col(n) for n in names], clean=True)
    assert one(spark, plain, **typed) == "Kade 1  bis  7500AB,"
    assert one(spark, clean, **typed) == "Kade 1 bis 7500AB"


def test_pair_key_is_the_same_from_both_sides(spark):
    day = ("date", dt.date(2020, 1, 2))
    key = Z.pair_key(F.col("a"), F.col("b"), F.col("d"))
    assert one(spark, key, a=("int", 3), b=("int", 9), d=day) == "9-3-20200102"
    assert one(spark, key, a=("int", 9), b=("int", 3), d=day) == "9-3-20200102"
    assert one(spark, key, a=("int", 9), b=("int", None), d=("date", None)) == "9-9-x"


@pytest.mark.parametrize(
    "begin, expected", [(20240100, 20240101), (0, 20230615), (20240115, 20240115), (None, None)]
)
def test_begin_number(spark, begin, expected):
    assert one(spark, Z.begin_number(F.col("x"), F.lit(20230615)), x=("int", begin)) == expected


def test_yesterday(spark):
    assert one(spark, Z.yesterday_number(F.col("d")), d=("date", dt.date(2024, 3, 1))) == 20240229


def test_strip_nul(spark):
    assert one(spark, Z.strip_nul(F.col("x")), x=("string", "contains\x00nul")) == "containsnul"
    assert one(spark, Z.strip_nul(F.col("x")), x=("string", None)) is None


def test_scalars(spark):
    df = spark.createDataFrame(
        [(Decimal("1.23"), bytearray(b"\x00\xff"), dt.timedelta(seconds=5), [{"a": "é", "b": None}], [])],
        "amount decimal(5,2), blob binary, delta interval day to second, "
        "items array<struct<a:string,b:int>>, none array<int>",
    )
    got = nested.scalars(df).first().asDict()
    assert got == {
        "amount": "1.23",
        "blob": "AP8=",
        "delta": 5.0,
        "items": '[{"a":"é","b":null}]',
        "none": "[]",
    }
