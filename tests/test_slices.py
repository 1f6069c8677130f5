import pytest
from pyspark.sql import functions as F

from zilverspoor.sources.jdbc import slice_predicates


def each(df, predicates):
    """How many of the conditions every row meets, and the rows of every slice."""
    met = [F.expr(p.replace('"', "`")) for p in predicates]
    counts = [F.count_if(m) for m in met]
    once = F.count_if(sum(F.coalesce(m, F.lit(False)).cast("int") for m in met) == 1)
    row = df.agg(F.count(F.lit(1)), once, *counts).first()
    return row[0], row[1], list(row[2:])


@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(12,3)", "double", "date", "timestamp", "timestamp_ntz"])
def test_every_row_is_in_one_slice(spark, kind):
    """A third of all rows has one key, a tenth none, and the rest crowds at the small end."""
    value = F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 10 == 1, None).otherwise(F.pow(F.col("id") % 1000, 2) / 100)
    if kind == "date":
        key = F.expr("date_add(DATE'2000-01-01', cast(v as int))")
    elif kind.startswith("timestamp"):
        key = F.expr("timestamp_seconds(cast(v as bigint) * 3600 + 0.25)").cast(kind)
    else:
        key = F.col("v").cast(kind)
    df = spark.range(30_000).withColumn("v", value).select(key.alias("the key"))
    predicates = slice_predicates(df, "the key", 10)
    n, once, slices = each(df, predicates)
    assert once == n == sum(slices)
    nulls = slices.pop()
    assert nulls == df.where("`the key` is null").count() > 0
    hot = max(slices)
    slices.remove(hot)
    assert hot < 15_000 and max(slices) < 2 * (n - nulls) / 10


def test_keys_that_come_later_are_read(spark):
    predicates = slice_predicates(spark.range(100).toDF("k"), "k", 4)
    later = spark.createDataFrame([(-5,), (1000,), (None,)], "k long")
    n, once, slices = each(later, predicates)
    assert once == n == 3 and slices[0] == slices[-2] == slices[-1] == 1


def test_small_and_empty_tables(spark):
    for rows in ([], [(None,)], [(3,), (3,)]):
        df = spark.createDataFrame(rows, "k long")
        for count in (1, 4):
            n, once, _ = each(df, slice_predicates(df, "k", count))
            assert once == n == len(rows)


def test_text_keys_are_refused(spark):
    with pytest.raises(ValueError, match="string"):
        slice_predicates(spark.createDataFrame([("a",)], "k string"), "k", 4)
