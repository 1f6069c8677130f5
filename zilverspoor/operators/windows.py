"""Ordered-group operators that never gather a whole group in one task.

A plain window ships every row of a group to one task. One person or the NULL
group can hold a third of a register, so here

* picking a row per group is cut down per map task before the shuffle
  (Spark's window group limit);
* running maxima, minima and looking ahead first aggregate to one row per (group,
  order value). Order values are calendar days, so a group has a few ten thousand
  of them at most; the window runs on those and its result is joined back on
  (group, order value), a join whose hot keys AQE splits;
* numbering sorts by sampled ranges and adds what earlier ranges hold.

NULL order values come last ascending and first descending, in every operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.session import keep

# Fixed value: Spark's increasing ids count the rows of a partition in this many bits.
_PLACE_BITS = 33


def by(column: str | Column, descending: bool = False) -> Column:
    """Sort expression with the NULL placement used throughout."""
    column = F.col(column) if isinstance(column, str) else column
    return column.desc_nulls_first() if descending else column.asc_nulls_last()


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join on keys where NULL equals NULL; the right side's keys are dropped.

    Spark compares such keys through expressions, so an aggregate on the right is
    shuffled again although it was grouped by the same columns. That is wanted:
    AQE splits a hot key only where both sides come straight from a shuffle.
    """
    renamed = right.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"__{key}"])
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def _null_free(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """Columns that are equal exactly when the keys are, with NULL equal to NULL."""
    kinds = {f.name: f.dataType for f in df.schema}
    day = "1970-01-01"
    stand_in = {T.StringType: "", T.BooleanType: "false", T.DateType: day}
    stand_in |= {T.TimestampType: day, T.TimestampNTZType: day}
    columns = {}
    for key in keys:
        value = F.lit(stand_in.get(type(kinds[key]), "0")).cast(kinds[key])
        columns[f"__{key}"] = F.coalesce(key, value)
        columns[f"__{key}_unknown"] = F.col(key).isNull()
    return columns


def top_row(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row of each group; ``order`` should end in a tie-break.

    ``row_number`` must stay the only window expression: only then Spark drops
    all but one row per group before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def first_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """Per group the given columns of its first row; NULLs count as values."""
    return top_row(df, keys, order).select(*keys, *columns)


def first_as_aggregate(latest_day: str, values: Sequence[str]) -> Column:
    """Aggregate to the values of the row with the latest day, as one struct.

    Same choice as ``first_in_group`` ordered by the day descending (NULL first)
    and then by the values ascending (NULL last), for use next to other aggregates.
    """
    rank = [-F.unix_date(latest_day)]  # NULL sorts first in a struct
    for value in values:
        rank += [F.col(value).isNull(), F.col(value)]
    names = [f"rank{i}" for i in range(len(rank))]
    first = F.min(F.struct(*[r.alias(n) for r, n in zip(rank, names)]))
    return F.struct(
        *[first[f"rank{2 * i + 2}"].alias(v) for i, v in enumerate(values)],
        F.date_from_unix_date(-first["rank0"]).alias(latest_day),
    )


def with_partition_min(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the smallest value of the group to each of its rows."""
    least = df.groupBy(*keys).agg(F.min(value).alias(out))
    return join_null_safe(df, least, keys, "inner")


def rows_at_min(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The rows that carry the smallest value of their group."""
    return with_partition_min(df, keys, value, "__least").where(
        F.col(value) == F.col("__least")
    ).drop("__least")


def running_max_steps(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, descending: bool = False
) -> DataFrame:
    """Per (group, order value) the largest ``value`` seen up to it, peers included."""
    steps = df.groupBy(*keys, order).agg(F.max(value).alias("__step"))
    window = Window.partitionBy(*keys).orderBy(by(order, descending))
    return steps.select(*keys, order, F.max("__step").over(window).alias(out))


def with_running_max(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, descending: bool = False
) -> DataFrame:
    """Running maximum over an ordered group, rows with equal order included."""
    steps = running_max_steps(df, keys, order, value, out, descending)
    return join_null_safe(df, steps, [*keys, order], "inner")


def look_ahead(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Add the order value of the next row in the group.

    Rows with the same order value follow each other by ``ties`` (all other
    columns when not given, NULLs first): all but the last of them see their own
    value next, and of several equal last rows exactly one looks further.

    The rows are written once, numbered, so what leads to them runs once. The
    steps from value to value come from three narrow columns; only values that
    several rows of a group share need their ties looked at, by partial maxima.
    Both joins take whole rows, so that these are shuffled once for the two of
    them; that holds while every column is a tie or needed later, so ``df`` should
    have no others.
    """
    ties = list(ties or [c for c in df.columns if c not in keys and c != order])
    rows = keep(df.withColumn("__row", F.monotonically_increasing_id()), "look-ahead")
    day = [*keys, order]
    found = rows.groupBy(*day).agg(F.count(F.lit(1)).alias("__n"), F.max("__row").alias("__any"))
    found = keep(found, "look-ahead-days")
    shared = found.where("__n > 1").select(*day)
    place = F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate([*ties, "__row"])])
    whole = F.struct(place.alias("place"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    # an inner join with the few shared values keeps all other rows out of the maximum
    lasts = join_null_safe(rows, shared, day, "inner")
    lasts = lasts.groupBy(*day).agg(F.max_by(whole, place)["place"].alias("__last"))
    following = F.lead(order).over(Window.partitionBy(*keys).orderBy(by(order)))
    steps = join_null_safe(found, lasts, day).select(
        *day, "__any", "__last", following.alias("__next")
    )
    alone = F.col("__last").isNull() & (F.col("__row") == F.col("__any"))
    is_last = alone | (place == F.col("__last"))
    seen = F.when(is_last, F.col("__next")).otherwise(F.col(order))
    return join_null_safe(rows, steps, day, "inner").select(*df.columns, seen.alias(out))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    unique_id: str,
    out: str,
    descending: bool = False,
) -> DataFrame:
    """Row number in each group by ``order``, then by ``unique_id`` ascending.

    A sample sort: rows are dealt by ranges of (group, order, id), whose bounds
    Spark takes from a sample, so a large group lies in several successive slices.
    In a sorted slice the place is the number; what a group has in earlier slices
    is added. No window runs on rows, and the join back is one that AQE splits.
    """
    plain = _null_free(df, keys)
    group = list(plain)
    ordered = [*group, by(order, descending), F.col(unique_id)]
    sliced = df.withColumns(plain).repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    # written once: slices and places are facts then, whatever runs again
    sliced = sliced.withColumn("__place", F.monotonically_increasing_id())
    rows = keep(sliced, "numbered").withColumn("__slice", F.shiftright("__place", _PLACE_BITS))
    parts = rows.groupBy(*group, "__slice").agg(
        F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    earlier = (
        Window.partitionBy(*group)
        .orderBy("__slice")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    before = F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    offsets = parts.select(*group, "__slice", (before + 1 - F.col("__first")).alias("__offset"))
    number = F.col("__place") + F.col("__offset")
    return rows.join(offsets, [*group, "__slice"]).select(*df.columns, number.alias(out))
