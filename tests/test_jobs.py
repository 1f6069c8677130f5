import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fake_service import FakeService
from zilverspoor.jobs import (
    EntityOptions,
    files_to_staging,
    service_to_staging,
    staging_to_silver,
    tables_to_staging,
)
from zilverspoor.sinks.parts import dump_parts
from zilverspoor.sinks.tables import TableStore

METADATA = """<?xml version="1.0"?>
<edmx:Edmx Version="4.0" xmlns:edmx="http://docs.oasis-open.org/odata/ns/edmx"><edmx:DataServices>
<Schema Namespace="Shop" xmlns="http://docs.oasis-open.org/odata/ns/edm">
<EntityType Name="Item"><Key><PropertyRef Name="id"/></Key><Property Name="value"/>
<Property Name="id" Type="Edm.Int64" Nullable="false"/></EntityType>
<EntityContainer Name="C"><EntitySet Name="[Shop].[Items]" EntityType="Shop.Item"/></EntityContainer>
</Schema></edmx:DataServices></edmx:Edmx>"""


class Service(FakeService):
    def __call__(self, url):
        return METADATA if url == "$metadata" else super().__call__(url)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"j{uuid.uuid4().hex[:8]}", str(tmp_path))


def test_tables_to_staging_and_on_to_silver(spark, store, tmp_path):
    frames = {
        "wvbesl": spark.createDataFrame([(1, 7), (2, 8)], "besluitnr int, clientnr int"),
        "szclient": spark.createDataFrame([(7, 1)], "clientnr int, ind_gezag int"),
    }
    for mode, rows in (("replace", 2), ("append", 4), ("truncate", 2)):
        counters = {"wvbesl": frames["wvbesl"].count, "szclient": lambda: 1 / 0}
        lines = tables_to_staging(frames, store, mode, counters).collect()
        report = {r["table_name"]: tuple(r)[1:] for r in lines}
        # a source that cannot be counted is loaded all the same
        assert report == {"wvbesl": (2, 2, True), "szclient": (None, 1, None)}
        assert store.read("wvbesl").count() == rows
    silver = TableStore(spark, f"{store.database}_silver", str(tmp_path / "silver"))
    report = staging_to_silver(store.database, silver, ["BESCHIKKING", "CLIENT", "WET_ENUM"])
    got = {r["target"]: r["status"] for r in report.collect()}
    assert got == {"BESCHIKKING": "loaded", "CLIENT": "loaded", "WET_ENUM": "skipped"}
    assert silver.read("BESCHIKKING").count() == 2
    assert silver.read("WET_ENUM").count() == 9  # the seed stays when the mapping is skipped


@pytest.mark.parametrize("counts", [True, False])
def test_service_to_staging(spark, store, counts):
    report = service_to_staging(Service(12, counts=counts), store, page_rows=5).first()
    assert report["table_name"] == "shop_items" and report["loaded_rows"] == 12
    assert report["matches"] is (True if counts else None)
    assert store.read("shop_items").columns == ["id", "value"]


def test_service_options_and_unknown_sets(spark, store):
    options = {"[SHOP].[ITEMS]": EntityOptions(select="id")}
    service_to_staging(Service(3), store, ["[shop].[items]"], options)
    assert store.read("shop_items").columns == ["id"]
    with pytest.raises(ValueError, match="Nope"):
        service_to_staging(Service(3), store, ["Nope"])


def test_files_to_staging(spark, store, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "Id int, Txt string")
    manifest = dump_parts({"orders": rows}, str(tmp_path / "dump"), run_id="r")
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "people.csv").write_text("Id,Name\n1,Ada\n")
    (tmp_path / "parts").mkdir()
    part = str(tmp_path / "parts" / "[Shop].[Orders]_part0000.parquet")
    pq.write_table(pa.table({"Id": [1, 2]}), part)
    for kind, path, table, count in (
        ("manifest", manifest, "orders", 2),
        ("csv", str(tmp_path / "csv"), "people", 1),
    ):
        report = files_to_staging(path, store, kind=kind).first()
        assert (report["table_name"], report["loaded_rows"]) == (table, count)
        assert store.read(table).columns[0] == "id"
    assert files_to_staging(str(tmp_path / "parts"), store).first()["loaded_rows"] == 2
    with pytest.raises(ValueError):
        files_to_staging("x", store, kind="other")
