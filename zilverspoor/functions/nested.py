"""Turn service values into scalars a table can hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_text(value: Column) -> Column:
    """Nested value as JSON text, NULL fields kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def scalar(value: Column, data_type: T.DataType) -> Column:
    """A column of any type as a scalar of a storable type.

    Decimals become text (their scale varies per page), binary becomes base64,
    intervals seconds, nested values JSON text; the rest is kept.
    """
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return json_text(value)
    if isinstance(data_type, T.DecimalType):
        return value.cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.base64(value)
    if isinstance(data_type, T.DayTimeIntervalType):
        return value.cast(T.DayTimeIntervalType(3, 3)).cast("decimal(18,6)").cast("double")
    return value


def scalars(df: DataFrame) -> DataFrame:
    """``scalar`` over every column."""
    return df.select(*[scalar(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def time_text(ts: Column) -> Column:
    """Time of day as ISO text."""
    return F.date_format(ts, "HH:mm:ss")
