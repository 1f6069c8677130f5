"""Tables of an application database over JDBC."""

from __future__ import annotations

import datetime
import decimal
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.operators.conform import to_bronze


@dataclass(frozen=True)
class Slices:
    """Split a table on a numeric, date or timestamp column into parallel reads."""

    column: str
    lower: str
    upper: str
    count: int


def slice_predicates(keys: DataFrame, column: str, count: int, accuracy: int = 10_000) -> list[str]:
    """Conditions that cut a table into about equal slices, whatever the key's distribution.

    ``keys`` has the key column, all of it or a fair sample. Split points are approximate quantiles,
    from sketches that are merged; a key value is never cut, so one that fills several slices gets
    one to itself. The first and the last slice are open, so keys that come later are read as well,
    and rows without a key are a slice of their own. Every row meets exactly one condition.
    """
    kind = keys.schema[column].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"a table cannot be sliced by {column}, which is {kind.simpleString()}")
    shares = [i / count for i in range(1, count)]
    found = []
    if shares:
        found = keys.agg(F.percentile_approx(f"`{column}`", shares, accuracy)).first()[0] or []
    points = sorted(set(found))
    name = '"' + column.replace('"', '""') + '"'
    if not points:
        return [f"{name} IS NOT NULL", f"{name} IS NULL"]
    at = [_literal(p) for p in points]
    inside = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(at, at[1:])]
    return [f"{name} < {at[0]}", *inside, f"{name} >= {at[-1]}", f"{name} IS NULL"]


def _literal(value) -> str:
    """A value as standard SQL writes it."""
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, float) and not math.isfinite(value):
        raise ValueError(f"{value} is no split point")
    return f"{value:f}" if isinstance(value, decimal.Decimal) else repr(value)


def read_sliced(
    spark: SparkSession, url: str, table: str, column: str, count: int, **options
) -> DataFrame:
    """A database table in about equal slices of a key, read side by side.

    The key alone is read first, as a stream of one narrow column, to find where to cut.
    """
    shared = {k: v for k, v in options.items() if k in ("fetch_size", "properties", "custom_schema")}
    keys = read_table(spark, url, table, [column], one_digit_is_boolean=False, **shared)
    predicates = slice_predicates(keys, keys.columns[0], count)
    return read_table(spark, url, table, predicates=predicates, **options)


def jdbc_options(
    url: str, table: str, fetch_size: int = 100_000, slices: Slices | None = None, **more: str
) -> dict[str, str]:
    """Reader options; every executor task streams its slice ``fetch_size`` rows at a time."""
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",  # moments without a zone stay as the database has them
        **more,
    }
    if slices is not None:
        options |= {
            "partitionColumn": slices.column,
            "lowerBound": str(slices.lower),
            "upperBound": str(slices.upper),
            "numPartitions": str(slices.count),
        }
    return options


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str] = (),
    slices: Slices | None = None,
    predicates: Sequence[str] = (),
    row_limit: int = 0,
    custom_schema: str | None = None,
    one_digit_is_boolean: bool | None = None,
    fetch_size: int = 100_000,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table as a bronze frame.

    Give ``slices`` for one split column or ``predicates`` for one read per
    condition; with neither, one task reads the table. Column choice, filters
    and the row limit are pushed to the database by Spark.
    """
    if slices is not None and predicates:
        raise ValueError("give slices or predicates, not both")
    extra = dict(properties or {})
    if custom_schema:
        extra["customSchema"] = custom_schema
    if predicates:
        df = spark.read.jdbc(
            url, table, predicates=list(predicates), properties={"fetchsize": str(fetch_size), "preferTimestampNTZ": "true"} | extra
        )
    else:
        options = jdbc_options(url, table, fetch_size, slices, **extra)
        df = spark.read.format("jdbc").options(**options).load()
    if one_digit_is_boolean is None:
        one_digit_is_boolean = url.lower().startswith("jdbc:oracle:")
    return as_bronze(df, columns, row_limit, one_digit_is_boolean)


def as_bronze(
    df: DataFrame,
    columns: Sequence[str] = (),
    row_limit: int = 0,
    one_digit_is_boolean: bool = False,
) -> DataFrame:
    """What is wanted of a source table, in bronze types; choices and limits reach the source."""
    if columns:
        df = df.select(*columns)
    if row_limit > 0:
        df = df.limit(row_limit)
    return to_bronze(df, one_digit_is_boolean)


def count_rows(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None
) -> int:
    """Row count of a database table; the database counts, one row travels."""
    query = f"(SELECT count(*) AS n FROM {table}) counted"
    options = jdbc_options(url, query, 1, **(properties or {}))
    return int(spark.read.format("jdbc").options(**options).load().first()[0])
