"""Key, enum and reconciliation checks. All aggregate before they shuffle or join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that are incomplete or occur more than once, with their row count."""
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(incomplete | (F.col("n_rows") > 1))
    )


def fk_orphans(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, key: Sequence[str]
) -> DataFrame:
    """Foreign-key values without a parent, with their row count; NULL refers to nothing."""
    used = child.dropna(subset=list(columns)).groupBy(*columns).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    parents = parent.select(*[F.col(k).alias(f"__{k}") for k in key])
    match = reduce(
        lambda a, b: a & b, [F.col(c) == F.col(f"__{k}") for c, k in zip(columns, key)]
    )
    return used.join(parents, match, "left_anti")


def enum_violations(df: DataFrame, column: str, enum: DataFrame, key: str) -> DataFrame:
    """Values that are not in the enum table, with their row count."""
    return fk_orphans(df, [column], enum, [key])


def row_counts(frames: Mapping[str, DataFrame], label: str = "n_rows") -> DataFrame:
    """Row count per table as one frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias(label)).select(F.lit(name).alias("table_name"), label)
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile_counts(
    source: Mapping[str, DataFrame], loaded: Mapping[str, DataFrame]
) -> DataFrame:
    """Source rows against loaded rows per table."""
    return (
        row_counts(source, "source_rows")
        .join(row_counts(loaded, "loaded_rows"), "table_name", "full")
        .withColumn("matches", F.col("source_rows").eqNullSafe(F.col("loaded_rows")))
    )


def comparable(column: Column, data_type: T.DataType) -> Column:
    """A value in a form two systems agree on: 5 decimals, milliseconds, hex bytes."""
    if isinstance(data_type, T.DecimalType):
        return F.round(column, 5).cast("decimal(38,5)")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.round(column.cast("double"), 5)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("millisecond", column)
    if isinstance(data_type, T.BinaryType):
        return F.hex(column)
    return column


def _comparable_rows(df: DataFrame) -> DataFrame:
    return df.select(*[comparable(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])


def reconcile_values(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs between two frames.

    Each side counts its copies before the shuffle, so many equal rows travel as
    one; ``left_copies`` and ``right_copies`` tell by how much they differ.
    """
    columns = left.columns
    tagged = _comparable_rows(left).withColumns(
        {"__l": F.lit(1).cast("bigint"), "__r": F.lit(0).cast("bigint")}
    ).unionByName(
        _comparable_rows(right.select(*columns)).withColumns(
            {"__l": F.lit(0).cast("bigint"), "__r": F.lit(1).cast("bigint")}
        )
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.sum("__l").alias("left_copies"), F.sum("__r").alias("right_copies"))
        .where("left_copies <> right_copies")
    )
