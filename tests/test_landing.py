import pytest
from pyspark.sql import types as T

from zilverspoor.sinks.tables import TableStore
from zilverspoor.streaming.landing import (
    append_batches,
    land,
    landing_stream,
    read_landed,
    upsert_batches,
)

SCHEMA = T.StructType(
    [T.StructField("ID", T.IntegerType()), T.StructField("Txt", T.StringType()), T.StructField("V", T.IntegerType())]
)


def drop_part(spark, folder, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_each_file_once(spark, tmp_path):
    folder, bronze, state = (str(tmp_path / n) for n in ("in", "bronze", "state"))
    for data in ([(1, "a\x00", 1)], [(2, "b", 1)]):
        drop_part(spark, folder, *data)
        land(landing_stream(spark, folder, SCHEMA), state, append_batches(bronze))
    # a run without new files adds nothing
    land(landing_stream(spark, folder, SCHEMA), state, append_batches(bronze))
    got = read_landed(spark, bronze, "id int, txt string, v int")
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1), (2, "b", 1)]


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    write = append_batches(str(tmp_path))
    batch = spark.createDataFrame([(1,)], "id int")
    write(batch, 0)
    write(batch, 0)
    assert read_landed(spark, str(tmp_path), "id int").count() == 1


def test_a_new_checkpoint_keeps_landed_rows(spark, tmp_path):
    folder, bronze = str(tmp_path / "in"), str(tmp_path / "bronze")
    drop_part(spark, folder, (1, "a", 1))
    land(landing_stream(spark, folder, SCHEMA), str(tmp_path / "one"), append_batches(bronze))
    other = str(tmp_path / "in2")
    drop_part(spark, other, (2, "b", 1))
    land(landing_stream(spark, other, SCHEMA), str(tmp_path / "two"), append_batches(bronze))
    got = read_landed(spark, bronze, "id int, txt string, v int")
    assert sorted(r["id"] for r in got.collect()) == [1, 2]


@pytest.mark.parametrize("backwards", [False, True])
def test_late_null_and_tied_versions(spark, tmp_path, backwards):
    """The same rows stay in whatever order batches come."""
    store = TableStore(spark, f"landing_late_{backwards}", str(tmp_path / "tables"))
    store.replace(spark.createDataFrame([], "id int, txt string, v int"), "t")
    merge = upsert_batches(store, "t", ["id"], "v")
    batches = [
        [(1, "nine", 9), (2, "a", None), (3, "p", 5), (3, "q", 5)],
        [(1, "two", 2), (2, None, None), (3, "o", 5), (4, "x", None)],
        [(4, "y", 0), (2, "b", None), (1, None, None)],
    ]
    for i, data in enumerate(reversed(batches) if backwards else batches):
        merge(spark.createDataFrame(data, "id int, txt string, v int"), i)
    got = sorted(map(tuple, store.read("t").collect()))
    assert got == [(1, "nine", 9), (2, "b", None), (3, "q", 5), (4, "y", 0)]


def test_upsert_batches(spark, tmp_path):
    store = TableStore(spark, "landing_upsert", str(tmp_path / "tables"))
    store.replace(spark.createDataFrame([(1, "old", 0)], "id int, txt string, v int"), "t")
    drop_part(spark, str(tmp_path / "in"), (1, "mid", 1), (1, "new", 2), (2, "x", 1))
    write = upsert_batches(store, "t", ["id"], "v")
    land(landing_stream(spark, str(tmp_path / "in"), SCHEMA), str(tmp_path / "state"), write)
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "new", 2), (2, "x", 1)]


def test_a_batch_reads_the_buckets_of_its_keys(spark, tmp_path):
    store = TableStore(spark, "landing_reads", str(tmp_path / "tables"))
    rows = spark.range(4000).selectExpr("cast(id as int) id", "'x' txt", "cast(id % 7 as int) v")
    store.replace(rows.limit(0), "t")
    upsert_batches(store, "t", ["id"], "v")(rows, 0)
    version = store.version("t")
    for ids in ([5], [5, 77], list(range(0, 4000, 40))):
        batch = spark.createDataFrame([(i, "new", 9) for i in ids], rows.schema)
        staged = store.stage(batch, "t", "upsert", ["id"], newest_by="v")
        touched = store.spark.createDataFrame([(i,) for i in ids], "id int").selectExpr(
            f"pmod(xxhash64(id), {version.buckets}) b"
        ).distinct()
        inside = rows.selectExpr(f"pmod(xxhash64(id), {version.buckets}) b").join(touched, "b").count()
        assert staged.read_rows == inside < (600 * len(ids))
        assert len(staged.folders) == touched.count()
