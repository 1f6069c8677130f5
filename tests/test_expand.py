from pyspark.sql import functions as F

from zilverspoor.operators.expand import FEW, repeat_rows


def test_copies(spark, rows):
    df = spark.createDataFrame(
        [(1, 3, "a"), (2, 0, "b"), (3, None, "c"), (4, -2, "d"), (5, 1, None), (1, 3, "a"), (6, 25, "e")],
        "n int, `the copies` long, block string",
    )
    got = repeat_rows(df, "the copies", block=4)
    assert got.columns == ["n", "block"]
    assert rows(got) == [(1, "a")] * 6 + [(5, None)] + [(6, "e")] * 25
    assert repeat_rows(df.limit(0), "the copies").count() == 0


def test_one_row_of_many_copies_is_spread_over_all_tasks(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") == 7, 2_000_000).otherwise(1).alias("n"))
    got = repeat_rows(df, "n", block=10_000).groupBy(F.spark_partition_id().alias("task"))
    counts = sorted(r["count"] for r in got.count().collect())
    assert sum(counts) == 2_000_999
    assert len(counts) == 8 and counts[-1] < 2 * counts[0]


def test_few_copies_are_made_in_place(spark, rows):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("n"))
    got = repeat_rows(df, "n", most=3)
    assert rows(got) == rows(repeat_rows(df, "n"))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    many = repeat_rows(df, "n", most=FEW + 1)
    assert "RoundRobin" in many._jdf.queryExecution().executedPlan().toString()
