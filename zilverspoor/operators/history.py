"""Histories of closed rows joined by the one current row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zilverspoor.functions.dates import date_minus_one


def union_history(history: DataFrame, current: DataFrame) -> DataFrame:
    """Closed history and current rows in one frame; what either lacks is NULL."""
    return history.unionByName(current, allowMissingColumns=True)


def close_interval(end_day: Column, end: Column, next_begin: Column) -> Column:
    """End day of an interval: one day earlier when the next one starts on it."""
    return F.when(next_begin == end, date_minus_one(end_day)).otherwise(end_day)


def current_rows(df: DataFrame, flags: Mapping[str, object]) -> DataFrame:
    """Rows whose flag columns have the given values.

    Filtering the right side before a left join is the same as testing the flag
    in its ON clause, and the filter reaches the scan.
    """
    for column, value in flags.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def latest_rows(df: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Of the rows of one key the one of the latest version; none is the lowest version.

    Rows of one version are told apart by their values, so the result does not depend on the order
    of arrival. Rows are compared before the shuffle already.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in key])
    rank = F.struct(F.col(f"`{version}`").isNotNull(), F.col(f"`{version}`"), rest)
    latest = df.groupBy(*key).agg(F.max_by(rest, rank).alias("row"))
    return latest.select(*key, "row.*").select(*df.columns)
