import decimal
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.sinks.parts import dump_parts, write_manifest
from zilverspoor.sources.files import (
    Between,
    ManifestError,
    group_part_files,
    list_files,
    read_csv,
    read_csv_folder,
    read_manifest,
    read_manifest_tables,
    read_part_folder,
    read_part_set,
    table_name,
)
from zilverspoor.sources.footers import read_footers, schema_of
from zilverspoor.sources.jdbc import Slices, jdbc_options, read_table


@pytest.mark.parametrize(
    "file, table",
    [
        ("Client_part0000.parquet", "Client"),
        ("/data/Orders_part0012.parquet", "Orders"),
        ("user_partitions.parquet", "user_partitions"),
        ("tbl_part0009.parquet", "tbl"),
        ("tbl_extra.parquet", "tbl_extra"),
        ("[APICUST].[METADATA]_part0000.parquet", "APICUST_METADATA"),
    ],
)
def test_table_name(file, table):
    assert table_name(file) == table


def test_grouping_sorts_and_skips_other_files():
    files = ["t_part0001.parquet", "t_part0000.parquet", "t.csv", "u.parquet"]
    assert group_part_files(files) == {
        "t": ["t_part0000.parquet", "t_part0001.parquet"],
        "u": ["u.parquet"],
    }


def write_part(folder, name, table):
    import pyarrow.parquet as pq

    pq.write_table(table, f"{folder}/{name}")


def test_part_folder_with_brackets_and_decimals(spark, tmp_path):
    import pyarrow as pa

    def part(value, precision, scale):
        kind = pa.decimal128(precision, scale)
        return pa.table({"ID": [1], "Price": pa.array([decimal.Decimal(value)], kind)})

    write_part(tmp_path, "[A].[B]_part0000.parquet", part("1.25", 10, 2))
    write_part(tmp_path, "[A].[B]_part0001.parquet", part("1.2345", 12, 4))
    tables = read_part_folder(spark, str(tmp_path), widen_decimals=True)
    assert list(tables) == ["A_B"]
    assert tables["A_B"].columns == ["id", "price"]
    assert sorted(str(r["price"]) for r in tables["A_B"].collect()) == ["1.2345", "1.2500"]
    one = read_part_set(spark, [f"{tmp_path}/[A].[B]_part0000.parquet"])
    assert one.count() == 1


def test_dump_in_chunks_and_read_by_manifest(spark, tmp_path):
    seven = spark.range(7).coalesce(1)
    manifest = dump_parts({"t": seven, "empty": spark.range(0)}, str(tmp_path), 3)
    files = read_manifest(spark, manifest)
    assert list(files) == ["t"] and len(files["t"]) == 3
    # a stray file of another run is not picked up
    seven.write.mode("append").parquet(files["t"][0].rsplit("/", 1)[0])
    assert read_manifest_tables(spark, manifest)["t"].count() == 7


def test_a_bad_manifest_is_an_error(spark, tmp_path):
    with pytest.raises(ManifestError):
        read_manifest(spark, str(tmp_path / "none"))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "m.json").write_text("{not json")
    with pytest.raises(ManifestError):
        read_manifest(spark, str(tmp_path / "broken"))
    line = {"run_id": "r", "created_at": "x", "table_name": "t", "file": str(tmp_path / "gone.parquet")}
    (tmp_path / "gone").mkdir()
    (tmp_path / "gone" / "m.json").write_text(json.dumps(line))
    with pytest.raises(ManifestError):
        read_manifest_tables(spark, str(tmp_path / "gone"))


def test_csv_folder(spark, tmp_path):
    (tmp_path / "Client.csv").write_text("ClientNr,Naam\n1,Ada\n2,\n")
    (tmp_path / "other.txt").write_text("x")
    tables = read_csv_folder(spark, str(tmp_path))
    assert list(tables) == ["client"]
    assert sorted(map(tuple, tables["client"].collect())) == [(1, "Ada"), (2, None)]
    typed = read_csv_folder(spark, str(tmp_path), {"client": CLIENT})
    assert sorted(map(tuple, typed["client"].collect()))[0] == ("1", "Ada")


CLIENT = T.StructType([T.StructField("ClientNr", T.StringType()), T.StructField("Naam", T.StringType())])


def test_csv_by_header_with_breaks_and_bad_values(spark, tmp_path):
    kinds = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    (tmp_path / "t.csv").write_text('B,extra,A\n"two\nlines, ""quoted""",x,7\n')
    row = read_csv_folder(spark, str(tmp_path), kinds)["t"].first()
    assert (row["a"], row["b"]) == (7, 'two\nlines, "quoted"')
    (tmp_path / "t.csv").write_text("a,b\nx1,y\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv_folder(spark, str(tmp_path), kinds)["t"].collect()
    (tmp_path / "t.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="no column"):
        read_csv_folder(spark, str(tmp_path), kinds)


def test_list_files(spark, tmp_path):
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "t"))
    assert list_files(spark, str(tmp_path / "t"))[0].endswith(".parquet")


def test_jdbc_options_split_a_table():
    options = jdbc_options("jdbc:x", "t", 500, Slices("id", "0", "100", 4))
    assert options["fetchsize"] == "500" and options["numPartitions"] == "4"
    assert options["partitionColumn"] == "id"


def test_jdbc_slices_and_predicates_exclude_each_other(spark):
    with pytest.raises(ValueError):
        read_table(spark, "jdbc:x", "t", slices=Slices("id", "0", "1", 2), predicates=["id = 1"])


def test_footers_of_many_parts_in_one_job(spark, tmp_path):
    import pyarrow as pa

    for i in range(300):
        kind = pa.decimal128(10, 2) if i % 3 else pa.decimal128(12, 4)
        write_part(tmp_path, f"T_part{i:04d}.parquet", pa.table({"Id": [i], "Price": pa.array([decimal.Decimal(i)], kind)}))
    tracker, group = spark.sparkContext.statusTracker(), "footers"
    spark.sparkContext.setJobGroup(group, group)
    try:
        table = read_part_folder(spark, str(tmp_path), widen_decimals=True)["T"]
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 6  # one query by its stages, and a listing for each schema; not one for each part
    assert table.count() == 300 and dict(table.dtypes)["price"] == "decimal(12,4)"


def test_footers_say_what_spark_reads(spark, tmp_path):
    df = spark.sql(
        """SELECT id AS Id, cast(id AS string) name, cast(id / 3 AS decimal(9,3)) price, id % 2 = 0 even,
        date_add(DATE'2020-01-01', cast(id AS int)) day, cast(id AS double) d, array(id) list,
        named_struct('x', id) s, if(id > 4, NULL, cast(id AS int)) some, cast(NULL AS int) nothing,
        timestamp_micros(id) at FROM range(10)"""
    )
    path = str(tmp_path / "t")
    df.coalesce(1).write.parquet(path)
    row = read_footers(spark, list_files(spark, path)).first()
    assert schema_of(row["schema"]).simpleString() == spark.read.parquet(path).schema.simpleString()
    assert row["rows"] == 10 and row["bytes"] > 500
    bounds = {k: (b["low"], b["high"], b["nulls"]) for k, b in row["bounds"].items()}
    assert bounds["Id"] == ("0", "9", 0) and bounds["name"] == ("0", "9", 0)
    assert bounds["price"] == ("0.000", "3.000", 0) and bounds["day"][1] == "2020-01-10"
    assert bounds["some"] == ("0", "4", 5) and bounds["nothing"] == (None, None, 10)
    assert "d" not in bounds


@pytest.mark.parametrize(
    "asked, files",
    [
        (Between("ID", 25, 34), 2), (Between("id", None, 9), 1), (Between("id", 1000), 0), (Between("day", "2020-02-01"), 7),
        (Between("d", 3.0, 4.0), 10), (Between("text", "b", "c"), 10), (Between("none", 1, 2), 0), (Between("late", 95), 1),
    ],
)
def test_a_range_opens_only_files_that_reach_into_it(spark, tmp_path, asked, files):
    df = spark.sql(
        """SELECT id AS Id, cast(id AS double) d, date_add(DATE'2020-01-01', cast(id AS int)) day,
        if(id % 2 = 0, 'a', 'd') text, cast(NULL AS int) none, if(id >= 90, id, NULL) late FROM range(0, 100, 1, 1)"""
    )
    manifest = dump_parts({"t": df}, str(tmp_path), max_rows_per_part=10)
    found = read_manifest_tables(spark, manifest, {"t": asked})["t"]
    column = asked.column.lower()
    want = df.toDF(*[c.lower() for c in df.columns])
    if asked.low is not None:
        want = want.where(F.col(column) >= F.lit(asked.low))
    if asked.high is not None:
        want = want.where(F.col(column) <= F.lit(asked.high))
    assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in want.collect())
    assert len(found.inputFiles()) == files or (files == 0 and found.isEmpty())


def test_a_manifest_of_parts_of_several_shapes(spark, tmp_path):
    one = spark.sql("SELECT 1 id, cast(1.5 AS decimal(4,1)) price")
    two = spark.sql("SELECT 2 id, cast(2.125 AS decimal(9,3)) price")
    for i, df in enumerate((one, two)):
        df.write.parquet(str(tmp_path / "run" / f"p{i}"))
    manifest = write_manifest(spark, str(tmp_path / "m"), "r", {"t": str(tmp_path / "run" / "p0")})
    more = write_manifest(spark, str(tmp_path / "m2"), "r", {"t": str(tmp_path / "run" / "p1")})
    both = str(tmp_path / "both")
    spark.read.text([manifest, more]).write.text(both)
    table = read_manifest_tables(spark, both)["t"]
    assert sorted((r["id"], str(r["price"])) for r in table.collect()) == [(1, "1.500"), (2, "2.125")]


def csv_text(seed, n):
    """Records with line breaks, quotes and separators in quoted text, and quotes that open nothing."""
    rng = random.Random(seed)
    pieces = ["a", "b c", "\n", "\n\n", '""', ",", "é日本", "x" * 30, '"",""', "\n,", '\n""\n']
    out = ["ID,Txt,More"]
    for i in range(n):
        inside = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))
        plain = rng.choice(["", "plain", 'in"ch', 'say "x" or', "é"])
        first, second = rng.sample([f'"{inside}"', plain], 2)
        out.append(f"{i},{first},{second}")
    return out


KINDS = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("more", T.StringType()), T.StructField("txt", T.StringType())]
)


@pytest.mark.parametrize("block", [64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_split_csv_equals_the_whole_one(spark, tmp_path, block, end):
    path = str(tmp_path / "T.csv")
    with open(path, "w", newline="") as out:
        out.write(end.join(csv_text(block, 300)) + end)
    whole = read_csv(spark, path, KINDS, split=False).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        table = read_csv(spark, path, KINDS)
        got = read_csv(spark, path, KINDS, split=True).collect()
        split = "from_csv" in table._jdf.queryExecution().optimizedPlan().toString()
        assert split == (block < 1 << 20)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(whole) == 300
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))


def test_a_record_longer_than_blocks(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    long = "\n".join(f"line {i}, of many" for i in range(500))
    with open(path, "w") as out:
        out.write(f'id,txt\n1,"{long}"\n2,x\n\n3,"{long}"')
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100)
    try:
        rows = {r["id"]: r["txt"] for r in read_csv(spark, path, T.StructType(KINDS[0:1].fields + KINDS[2:].fields)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == {1: long, 2: "x", 3: long}


def test_lines_as_functions_of_a_bit():
    import re

    from zilverspoor.sources.csv_split import _patterns

    cases = {  # line: (ends inside if begun outside, if begun inside)
        "": (False, True), "a,b": (False, True), '"a': (True, False), 'a"': (False, False), 'a,"b': (True, False),
        '""': (False, True), '"a""': (True, False), '"a",b': (False, False), 'a",b,"c': (True, True), 'x"y,"z': (True, True),
        '",': (True, False), '","': (False, True), 'in"ch,"': (True, True), '"""': (True, False),
    }
    outside, inside = (re.compile(p) for p in _patterns(","))
    for line, want in cases.items():
        assert (bool(outside.search(line)), bool(inside.search(line))) == want, line
