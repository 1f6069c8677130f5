"""Skew-proof operators against the plain windows they stand for."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from zilverspoor.operators.windows import (
    by,
    first_in_group,
    look_ahead,
    number_rows,
    rows_at_min,
    top_row,
    with_partition_min,
    with_running_max,
)


def stays(spark, seed):
    """Few days, ties, NULL days and NULL groups; one group holds a third of the rows."""
    rnd = random.Random(seed)
    data = [
        (
            i,
            rnd.choice([None, 1, 1, 1, 2, 3, 4, 5, 6]),
            rnd.choice([None, 20200101, 20200102, 20200105, 99991231]),
            rnd.choice([None, *range(5)]),
        )
        for i in range(400)
    ]
    return spark.createDataFrame(data, "id int, grp int, day int, val int").repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("descending", [False, True])
def test_running_max_equals_the_window(spark, rows, seed, descending):
    df = stays(spark, seed)
    window = Window.partitionBy("grp").orderBy(by("day", descending))
    expected = df.withColumn("m", F.max("val").over(window))
    got = with_running_max(df, ["grp"], "day", "val", "m", descending)
    assert rows(got.select("id", "m")) == rows(expected.select("id", "m"))


@pytest.mark.parametrize("seed", [1, 2])
def test_look_ahead_equals_lead(spark, rows, seed):
    df = stays(spark, seed)
    window = Window.partitionBy("grp").orderBy(by("day"), F.col("val").asc_nulls_first(), F.col("id"))
    expected = df.withColumn("n", F.lead("day").over(window))
    got = look_ahead(df, ["grp"], "day", "n", ties=["val", "id"])
    assert rows(got.select("id", "n")) == rows(expected.select("id", "n"))


@pytest.mark.parametrize("seed", [1, 2])
def test_look_ahead_with_copies_equals_lead(spark, rows, seed):
    df = stays(spark, seed).drop("id")  # most rows occur several times now
    window = Window.partitionBy("grp").orderBy(by("day"), F.col("val").asc_nulls_first())
    expected = df.withColumn("n", F.lead("day").over(window))
    assert rows(look_ahead(df, ["grp"], "day", "n")) == rows(expected)


@pytest.mark.parametrize("descending", [False, True])
def test_number_rows_equals_row_number(spark, rows, descending):
    df = stays(spark, 3).withColumn("id", F.col("id") * 100_000)  # several id blocks
    window = Window.partitionBy("grp").orderBy(by("day", descending), "id")
    expected = df.withColumn("rn", F.row_number().over(window))
    got = number_rows(df, ["grp"], "day", "id", "rn", descending)
    assert rows(got.select("id", "rn")) == rows(expected.select("id", "rn"))


def test_top_row_is_cut_before_the_shuffle(spark):
    plan = top_row(stays(spark, 1), ["grp"], [by("day", True), by("id")])._jdf.queryExecution()
    assert plan.executedPlan().toString().count("WindowGroupLimit") == 2


def test_partition_min_and_rows_at_min(spark, rows):
    df = stays(spark, 4)
    window = Window.partitionBy("grp", "day")
    expected = df.withColumn("m", F.min("val").over(window))
    got = with_partition_min(df, ["grp", "day"], "val", "m")
    assert rows(got.select("id", "m")) == rows(expected.select("id", "m"))
    at_min = rows_at_min(df, ["grp", "day"], "val")
    assert rows(at_min.select("id")) == rows(expected.where("m = val").select("id"))


def test_first_in_group_keeps_null_values(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, "old"), (1, 9, None), (None, 3, "n"), (None, None, "open")], "g int, o int, v string"
    )
    got = first_in_group(df, ["g"], [by("o", descending=True)], ["v"])
    assert rows(got) == [(None, "open"), (1, None)]


@pytest.mark.parametrize(
    "kind", ["string", "date", "timestamp", "timestamp_ntz", "boolean", "decimal(9,2)", "double", "binary"]
)
def test_keys_of_any_type(spark, rows, kind):
    values = {"string": "a", "boolean": "true", "binary": "b"}
    value = values.get(kind, "2020-01-01" if kind[:4] in ("date", "time") else "1")
    df = spark.range(6).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(value)).cast(kind).alias("key")
    )
    got = rows_at_min(df, ["key"], "id")
    assert rows(got.select("id")) == [(0,), (1,)]


def test_sparse_ids_of_one_hot_group_are_dealt_evenly(spark):
    """A third of the rows is one (group, day), with ids that are far apart."""
    df = spark.range(300_000).select(
        F.xxhash64("id").alias("id"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("grp"),
        F.when(F.col("id") % 3 == 0, 20200101).otherwise(F.col("id") % 28).alias("day"),
    )
    got = number_rows(df, ["grp"], "day", "id", "rn")
    hot = got.where("grp = -1").orderBy("id").select("rn").collect()
    assert [r["rn"] for r in hot] == list(range(1, 100_001))
    window = Window.partitionBy("grp").orderBy("day", "id")
    rest = df.where("grp <> -1").withColumn("rn", F.row_number().over(window).cast("bigint"))
    assert got.where("grp <> -1").exceptAll(rest).isEmpty()
    # the slices as they were written; small ones have been put together
    written = got._jdf.inputFiles()
    sizes = [spark.read.parquet(f).count() for f in written if "/numbered-" in f]
    assert len(sizes) > 1 and max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]


def test_look_ahead_reads_its_input_once(spark):
    df = stays(spark, 1)
    plan = look_ahead(df, ["grp"], "day", "n")._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "Relation" in plan  # only what was written is read again


def test_look_ahead_shuffles_whole_rows_once(spark, rows):
    df = stays(spark, 1)
    small = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(small)
    spark.conf.set(small, "-1")
    try:
        # one column more than the ties, and a tie that nobody needs later
        df = df.withColumn("other", F.col("id") + 1)
        got = look_ahead(df, ["grp"], "day", "n", ties=["val", "id"]).drop("id")
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set(small, before)
    assert plan.count("ReusedExchange") == 1
