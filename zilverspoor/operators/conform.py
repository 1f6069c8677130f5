"""Type rules: portable bronze types, decimal widening and silver contracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.contracts import TableContract
from zilverspoor.functions.text import strip_nul
from zilverspoor.operators.columns import lower_columns

_KEPT = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    T.DateType,
    T.BinaryType,
    T.TimestampNTZType,
)
#: Values of these types never have more characters as text.
_CHARACTERS = {T.BooleanType: 5, T.ByteType: 4, T.ShortType: 6, T.IntegerType: 11, T.LongType: 20}


def portable_type(data_type: T.DataType, one_digit_is_boolean: bool = False) -> T.DataType:
    """The bronze type of a source column.

    Whole numbers get the smallest integer type that holds every value of their
    precision; beyond 18 digits they stay decimal. A one-digit number is a
    boolean for sources that have no boolean type of their own.
    """
    if isinstance(data_type, T.DecimalType):
        if data_type.scale > 0:
            return data_type
        if one_digit_is_boolean and data_type.precision == 1:
            return T.BooleanType()
        for digits, whole in ((4, T.ShortType()), (9, T.IntegerType()), (18, T.LongType())):
            if data_type.precision <= digits:
                return whole
        return data_type
    if isinstance(data_type, T.TimestampType):
        return T.TimestampNTZType()
    return data_type if isinstance(data_type, _KEPT) else T.StringType()


def _to_portable(column: Column, source: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.BooleanType) and not isinstance(source, T.BooleanType):
        return column != 0
    if isinstance(source, T.StringType):
        return strip_nul(column)
    if isinstance(source, T.TimestampType) and isinstance(target, T.TimestampNTZType):
        # the moment in UTC, whatever the session's zone; by numbers, as clock times repeat
        seconds = (F.unix_micros(column).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
        return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return column if source == target else column.cast(target)


def to_bronze(df: DataFrame, one_digit_is_boolean: bool = False) -> DataFrame:
    """Lower-case names, portable types, text without NUL characters; nullability is kept."""
    df = lower_columns(df)
    return df.select(
        *[
            _to_portable(
                F.col(f"`{f.name}`"), f.dataType, portable_type(f.dataType, one_digit_is_boolean)
            ).alias(f.name)
            for f in df.schema
        ]
    )


def widen_decimals(left: T.DecimalType, right: T.DecimalType) -> T.DecimalType:
    """The smallest decimal that holds every value of both."""
    scale = max(left.scale, right.scale)
    precision = max(left.precision - left.scale, right.precision - right.scale) + scale
    if precision > 38:
        raise ValueError(f"{left.simpleString()} and {right.simpleString()} need {precision} digits")
    return T.DecimalType(precision, scale)


def harmonise_decimals(parts: Sequence[DataFrame]) -> DataFrame:
    """One frame from parts whose decimal columns differ in precision or scale."""
    parts = [lower_columns(p) for p in parts]
    widest: dict[str, T.DecimalType] = {}
    for part in parts:
        for field in part.schema:
            if isinstance(field.dataType, T.DecimalType):
                seen = widest.get(field.name, field.dataType)
                widest[field.name] = widen_decimals(seen, field.dataType)
    cast = [
        p.select(*[F.col(c).cast(widest[c]).alias(c) if c in widest else F.col(c) for c in p.columns])
        for p in parts
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


@dataclass(frozen=True)
class Conformed:
    """Rows that fit a contract, and the others with the reasons why not.

    ``checked`` has all rows, the reasons being the last column.
    """

    checked: DataFrame
    reasons: str = "__problems"

    @property
    def accepted(self) -> DataFrame:
        return self.checked.where(F.size(self.reasons) == 0).drop(self.reasons)

    @property
    def rejected(self) -> DataFrame:
        found = self.checked.where(F.size(self.reasons) > 0)
        return found.withColumnRenamed(self.reasons, "problems")


def _cast_to(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.VarcharType, T.CharType)):
        return column.cast("string")
    return column.try_cast(data_type)


def conform(df: DataFrame, contract: TableContract, null_keys: bool = False) -> Conformed:
    """Cast to the contract's columns by name and separate rows that do not fit.

    A row is rejected when a value does not cast, a text is too long or, unless
    ``null_keys`` lets them pass, a key column is NULL. One scan serves each side; nothing is compared across rows.
    """
    have = {c.lower(): c for c in df.columns}
    kinds = {f.name: f.dataType for f in df.schema}
    columns, problems = [], []
    for field in contract.schema:
        source = have.get(field.name.lower())
        if source is None:
            value = F.lit(None).cast(_plain(field.dataType))
        else:
            raw = F.col(f"`{source}`")
            value = _cast_to(raw, field.dataType)
            if _always_fits(kinds[source], field.dataType):
                pass
            elif isinstance(field.dataType, (T.VarcharType, T.CharType)):
                too_long = F.length(value) > field.dataType.length
                problems.append(F.when(too_long, F.lit(f"length:{field.name}")))
            else:
                lost = raw.isNotNull() & value.isNull()
                problems.append(F.when(lost, F.lit(f"cast:{field.name}")))
        if field.name in contract.primary_key and not null_keys:
            problems.append(F.when(value.isNull(), F.lit(f"null:{field.name}")))
        columns.append(value.alias(field.name))
    found = none = F.array().cast("array<string>")
    if problems:  # the array is only made for a row that has any
        some = F.coalesce(*problems).isNotNull()
        found = F.when(some, F.array_compact(F.array(*problems))).otherwise(none)
    return Conformed(df.select(*columns, found.alias("__problems")))


def _always_fits(source: T.DataType, target: T.DataType) -> bool:
    """Whether no value of a type can be lost or too long, so that none needs to be looked at."""
    if isinstance(target, (T.VarcharType, T.CharType)):
        return type(source) in _CHARACTERS and _CHARACTERS[type(source)] <= target.length
    return source == target


def _plain(data_type: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(data_type, (T.VarcharType, T.CharType)) else data_type
