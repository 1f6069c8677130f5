"""Sources: table scans, part sets, manifests, CSV and OData pages."""

from __future__ import annotations

import glob
import json
import re
from functools import reduce
from urllib.parse import parse_qs, urlparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.checks.core import Tables, check
from zilverspoor.operators.windows import number_rows
from zilverspoor.sinks.parts import dump_parts, write_manifest
from zilverspoor.sources.files import (
    Between,
    group_part_files,
    list_files,
    read_csv,
    read_csv_folder,
    read_manifest_tables,
    read_part_set,
    source_count,
)
from zilverspoor.sources.jdbc import as_bronze, slice_predicates
from zilverspoor.sources.odata import (
    EntityType,
    entity_navigation,
    entity_properties,
    parse_pages,
    read_entity_sets,
    read_entity_types,
    read_pages,
)
from zilverspoor.sources.odata_service import read_service
from zilverspoor.streaming.landing import (
    append_batches,
    land,
    landing_stream,
    read_landed,
    upsert_batches,
)


@check("scan_table", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def scan_table(t: Tables) -> DataFrame:
    return as_bronze(t.lineitem, ["l_orderkey", "l_linenumber", "l_quantity"])


@check(
    "scan_partitioned",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_returnflag = 'R'",
)
def scan_partitioned(t: Tables) -> DataFrame:
    """One read for each slice of a skewed key: half of the lines have one supplier, some have none."""
    key = F.expr("if(l_suppkey % 2 = 0, 7, if(l_suppkey % 11 = 0, null, l_suppkey)) as key")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", key)
    slices = slice_predicates(lines, "key", 12)
    reads = [lines.where(p.replace('"', "`")) for p in slices]  # as a database would select them
    return as_bronze(
        reduce(DataFrame.unionByName, reads).where("l_returnflag = 'R'"),
        ["l_orderkey", "l_linenumber", "l_extendedprice"],
    )


@check("scan_row_limit", "SELECT least(count(*), 1000) AS n_rows FROM lineitem")
def scan_row_limit(t: Tables) -> DataFrame:
    return source_count(as_bronze(t.lineitem, ["l_orderkey"], row_limit=1000))


def _write_parts(t: Tables, folder: str) -> list[str]:
    """Orders as one part per status, named the way services name entity sets."""
    paths = []
    for number, status in enumerate(("F", "O", "P")):
        path = f"{folder}/[SALES].[Orders]_part{number:04d}.parquet"
        rows = t.orders.where(F.col("o_orderstatus") == status)
        rows.select("o_orderkey", F.col("o_custkey").alias("O_CUSTKEY")).write.parquet(path)
        paths.append(path)
    return paths


@check(
    "scan_part_set",
    "SELECT 'SALES_Orders' AS table_name, o_orderkey, o_custkey FROM orders",
)
def scan_part_set(t: Tables) -> DataFrame:
    groups = group_part_files(_write_parts(t, t.run_dir("parts")))
    (name, files), = groups.items()
    return read_part_set(t.spark, files).select(F.lit(name).alias("table_name"), "*")


@check("scan_manifest", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P'")
def scan_manifest(t: Tables) -> DataFrame:
    """A third part lies in the folder, but this run's manifest does not list it."""
    folder = t.run_dir("manifest")
    parts = {}
    for status in ("F", "O", "P"):
        path = f"{folder}/orders_{status}"
        rows = t.orders.where(F.col("o_orderstatus") == status)
        rows.select("o_orderkey", "o_custkey").write.parquet(path)
        parts[status] = path
    listed = {"orders_f": parts["F"], "orders_o": parts["O"]}
    manifest = write_manifest(t.spark, f"{folder}/run-manifest", "run", listed)
    tables = read_manifest_tables(t.spark, manifest)
    return tables["orders_f"].unionByName(tables["orders_o"])


@check(
    "scan_manifest_range",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 100 AND 900",
)
def scan_manifest_range(t: Tables) -> DataFrame:
    """Files whose bounds lie outside of the range are not opened."""
    parts = t.orders.select("o_orderkey", "o_custkey").orderBy("o_orderkey")
    manifest = dump_parts({"orders": parts}, t.run_dir("bounds"), max_rows_per_part=500)
    asked = Between("o_orderkey", 100, 900)
    return read_manifest_tables(t.spark, manifest, {"orders": asked})["orders"]


@check(
    "scan_csv_split",
    """SELECT o_orderkey, o_orderstatus || chr(10) || '"' || o_orderdate || '",' || chr(10) AS note,
    o_custkey FROM orders""",
)
def scan_csv_split(t: Tables) -> DataFrame:
    """Every record spans several lines; the files are cut into blocks wherever these end."""
    folder = t.run_dir("csv")
    note = F.concat("o_orderstatus", F.lit('\n"'), F.col("o_orderdate").cast("string"), F.lit('",\n'))
    rows = t.orders.select("o_orderkey", note.alias("note"), "o_custkey")
    written = rows.coalesce(2).write.option("header", "true").option("escape", '"')
    written.option("ignoreTrailingWhiteSpace", "false").csv(folder)
    files = list_files(t.spark, folder, "*.csv")
    return reduce(
        DataFrame.unionByName, [read_csv(t.spark, f, rows.schema, split=True) for f in files]
    )


@check(
    "scan_csv_folder",
    """SELECT c_custkey, c_name || chr(10) || '"' || c_mktsegment || '", ' || c_name AS c_name,
    c_nationkey, c_mktsegment FROM customer""",
)
def scan_csv_folder(t: Tables) -> DataFrame:
    """Quoted text holds a line break, and the header has another order than the schema."""
    folder = t.run_dir("csv")
    text = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('", '), "c_name")
    rows = t.customer.select("c_custkey", text.alias("c_name"), "c_nationkey", "c_mktsegment")
    other = rows.select("c_mktsegment", "c_name", "c_custkey", "c_nationkey")
    written = other.toDF(*[c.upper() for c in other.columns]).write.option("header", "true")
    written.option("escape", '"').csv(folder)
    tables = read_csv_folder(t.spark, folder, rows.schema)
    return reduce(DataFrame.unionByName, tables.values())


# -- OData --------------------------------------------------------------------------

_PAGE_ROWS = 500
CUSTOMER = EntityType(
    "Customer",
    ("Id",),
    {
        "Name": T.StringType(),
        "Id": T.LongType(),
        "Balance": T.DecimalType(12, 2),
        "Remark": T.StringType(),
    },
    {"Nation": T.StructType([T.StructField("Key", T.IntegerType()), T.StructField("Tag", T.StringType())])},
)


def _write_pages(t: Tables, version: str) -> str:
    """Customers as a service would page them: a page is one JSON line."""
    rows = t.customer.select(
        F.floor(F.col("c_custkey") / _PAGE_ROWS).alias("page"),
        F.struct(
            F.col("c_name").alias("Name"),
            F.col("c_custkey").alias("Id"),
            F.col("c_acctbal").cast("decimal(12,2)").alias("Balance"),
            F.struct(
                F.col("c_nationkey").alias("Key"), F.lit(None).cast("string").alias("Tag")
            ).alias("Nation"),
        ).alias("row"),
    )
    # at most _PAGE_ROWS customers share a page
    pages = rows.groupBy("page").agg(F.collect_list("row").alias("rows"))
    link = F.concat(F.lit("Customers?$skiptoken="), (F.col("page") + 1).cast("string"))
    if version == "v4":
        page = F.struct(F.col("rows").alias("value"), link.alias("@odata.nextLink"))
    else:
        page = F.struct(F.struct(F.col("rows").alias("results"), link.alias("__next")).alias("d"))
    path = t.run_dir(f"odata-{version}")
    pages.select(F.to_json(page)).write.text(path)
    return path


_ENTITY_SQL = """SELECT c_custkey AS "Id", c_name AS "Name",
    CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS "Balance",
    CAST(NULL AS VARCHAR) AS "Remark" FROM customer"""


@check("odata_pages", _ENTITY_SQL)
def odata_pages(t: Tables) -> DataFrame:
    return read_pages(t.spark, _write_pages(t, "v4"), CUSTOMER)


@check("odata_pages_v2", _ENTITY_SQL)
def odata_pages_v2(t: Tables) -> DataFrame:
    return read_pages(t.spark, _write_pages(t, "v2"), CUSTOMER, version="v2")


@check(
    "odata_select_filter",
    """SELECT c_custkey AS "Id", CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS "Balance"
    FROM customer WHERE c_acctbal > 1000""",
)
def odata_select_filter(t: Tables) -> DataFrame:
    return read_pages(
        t.spark,
        _write_pages(t, "v4"),
        CUSTOMER,
        select="Balance,Id,Unknown",
        condition=F.col("Balance") > 1000,
    )


@check(
    "odata_project_keys_first",
    """SELECT 'Id,Remark,Name,Nation' AS column_order, c_custkey AS "Id",
    CAST(NULL AS VARCHAR) AS "Remark", c_name AS "Name",
    '{"Key":' || CAST(c_nationkey AS VARCHAR) || ',"Tag":null}' AS "Nation" FROM customer""",
)
def odata_project_keys_first(t: Tables) -> DataFrame:
    rows = read_pages(
        t.spark, _write_pages(t, "v4"), CUSTOMER, select="Remark, Name, Id", expand="Nation/Key"
    )
    return rows.select(F.lit(",".join(rows.columns)).alias("column_order"), "*")


_CHUNK = 512


class TableService:
    """A paged service over rows that Spark has written in files of ``_CHUNK`` rows each.

    It counts too few rows, answers some requests with an empty page that leads on, and its links
    forget what was left of a range. Rows come in key order only if that is asked for. It opens the
    files that a request needs, where that is answered: on the executors.
    """

    def __init__(self, folder: str, size: int):
        self.folder = folder.removeprefix("file:")
        self.size = size

    def rows(self, start: int, stop: int) -> list[str]:
        found: list[str] = []
        for chunk in range(start // _CHUNK, -(-stop // _CHUNK)):
            (name,) = glob.glob(f"{self.folder}/chunk={chunk}/part-*")
            with open(name, encoding="utf-8") as lines:
                kept = sorted((json.loads(line) for line in lines), key=lambda x: x["position"])
            base = chunk * _CHUNK
            found += [x["row"] for x in kept[max(0, start - base) : stop - base]]
        return found

    def __call__(self, url: str) -> str:
        parsed = urlparse(url)
        asked = {k: v[0] for k, v in parse_qs(parsed.query).items()}
        if parsed.path.endswith("/$count"):
            return str(self.size // 2)
        skip, top = int(asked.get("$skip", 0)), int(asked.get("$top", self.size))
        part = self.rows(skip, min(self.size, skip + min(top, 70))) if skip < self.size else []
        if "$orderby" not in asked:
            part = part[::-1]
        if skip % 3 == 0 and part and "again" not in asked:
            return json.dumps({"value": [], "@odata.nextLink": f"{url}&again=1"})
        link = f', "@odata.nextLink": "Customers?$orderby=Id&$skip={skip + len(part)}"'
        more = link if part and skip + len(part) < self.size else ""
        return f'{{"value": [{",".join(part)}]{more}}}'


class KeyedService(TableService):
    """A service that refuses positions: it is asked for keys from one on, in their order.

    Its keys follow each other from 0 on.
    """

    def __call__(self, url: str) -> str:
        asked = {k: v[0] for k, v in parse_qs(urlparse(url).query).items()}
        if "$skip" in asked or not asked.get("$orderby", "").startswith("Id"):
            raise RuntimeError("501")
        bound = dict(re.findall(r"Id (ge|gt|lt) (\d+)", asked.get("$filter", "")))
        start = max(int(bound.get("ge", 0)), int(bound.get("gt", -1)) + 1)
        stop = min(int(bound.get("lt", self.size)), self.size)
        top = min(int(asked["$top"]), 70)
        if asked["$orderby"] == "Id desc":
            start = max(start, stop - top)
        part = self.rows(start, min(stop, start + top)) if start < stop else []
        return f'{{"value": [{",".join(part)}]}}'


def _service(t: Tables, kind: type[TableService]) -> TableService:
    row = F.to_json(
        F.struct(
            F.col("c_custkey").alias("Id"),
            F.col("c_name").alias("Name"),
            F.col("c_acctbal").cast("decimal(12,2)").alias("Balance"),
        )
    )
    rows = number_rows(t.customer.withColumn("row", row), [], "c_custkey", "c_custkey", "position")
    folder = t.run_dir("service")
    rows.select("position", "row", F.floor((F.col("position") - 1) / _CHUNK).alias("chunk")).repartition(
        "chunk"
    ).write.partitionBy("chunk").json(folder)
    return kind(folder, t.customer.count())


@check("odata_service_pages", _ENTITY_SQL)
def odata_service_pages(t: Tables) -> DataFrame:
    service = _service(t, TableService)
    return read_service(t.spark, service, "Customers", CUSTOMER, page_rows=100, pages_per_task=2)


@check("odata_service_keys", _ENTITY_SQL)
def odata_service_keys(t: Tables) -> DataFrame:
    """A service without positions, read by many tasks in ranges of keys."""
    service = _service(t, KeyedService)
    return read_service(t.spark, service, "Customers", CUSTOMER, page_rows=100, by_key=True)


_MOMENTS = EntityType("Moment", ("Id",), {"Id": T.LongType(), "At": T.TimestampType()}, {})


@check(
    "odata_datetimeoffset",
    """SELECT o_orderkey AS "Id",
    CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) + 1800
      - (CAST(o_orderkey % 27 AS BIGINT) - 13) * 3600 AS instant FROM orders""",
)
def odata_datetimeoffset(t: Tables) -> DataFrame:
    """Half past midnight at offsets from -13 to +13 hours; every eighth says Z or nothing."""
    hours = (F.col("o_orderkey") % 27 - 13).cast("int")
    sign = F.when(hours < 0, "-").otherwise("+")
    offset = F.concat(sign, F.lpad(F.abs(hours).cast("string"), 2, "0"), F.lit(":00"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    at = F.concat(day, F.lit("T00:30:00"), F.when(hours == 0, F.when(F.col("o_orderkey") % 2 == 0, "Z").otherwise("")).otherwise(offset))
    row = F.struct(F.col("o_orderkey").alias("Id"), at.alias("At"))
    page = F.to_json(F.struct(F.array(row).alias("value")))
    pages = parse_pages(t.orders.select(page.alias("body")), _MOMENTS)
    return pages.select("Id", F.unix_seconds("At").alias("instant"))


def _write_metadata(t: Tables) -> str:
    """Service metadata with one entity type and one entity set per part."""
    name = F.concat(F.lit("Part"), F.col("p_partkey").cast("string"))

    def prop(label, kind, nullable=None):
        return F.struct(
            label.alias("_Name"),
            F.lit(kind).alias("_Type"),
            F.lit(nullable).cast("string").alias("_Nullable"),
        )

    orders = F.struct(
        F.lit("Orders").alias("_Name"), F.lit("Collection(Shop.Order)").alias("_Type")
    )
    entity_type = F.struct(
        name.alias("_Name"),
        F.struct(F.struct(F.lit("Id").alias("_Name")).alias("PropertyRef")).alias("Key"),
        F.array(
            prop(F.lit("Id"), "Edm.Int64", "false"), prop(F.col("p_type"), "Edm.Decimal")
        ).alias("Property"),
        F.when(F.col("p_size") > 25, orders).alias("NavigationProperty"),
    )
    entity_set = F.struct(
        F.regexp_replace(name, "^Part", "Parts").alias("_Name"),
        F.concat(F.lit("Shop."), name).alias("_EntityType"),
    )
    documents = t.part.select(
        entity_type.alias("EntityType"), F.struct(entity_set.alias("EntitySet")).alias("EntityContainer")
    )
    path = t.run_dir("metadata")
    documents.write.format("xml").option("rowTag", "Schema").option("rootTag", "Edmx").save(path)
    return path


@check(
    "odata_metadata",
    """SELECT s.entity_set, s.entity_type, p.property, p.edm_type, p.nullable, p.is_key
    FROM (SELECT 'Parts' || CAST(p_partkey AS VARCHAR) AS entity_set,
      'Part' || CAST(p_partkey AS VARCHAR) AS entity_type, p_type FROM part) AS s,
    LATERAL (SELECT 'Id' AS property, 'Edm.Int64' AS edm_type, FALSE AS nullable, TRUE AS is_key
      UNION ALL SELECT s.p_type, 'Edm.Decimal', TRUE, FALSE) AS p""",
)
def odata_metadata(t: Tables) -> DataFrame:
    path = _write_metadata(t)
    properties = entity_properties(read_entity_types(t.spark, path))
    return read_entity_sets(t.spark, path).join(properties, "entity_type")


@check(
    "odata_navigation",
    """SELECT 'Part' || CAST(p_partkey AS VARCHAR) AS entity_type, 'Orders' AS navigation,
    'Collection(Shop.Order)' AS target_type FROM part WHERE p_size > 25""",
)
def odata_navigation(t: Tables) -> DataFrame:
    return entity_navigation(read_entity_types(t.spark, _write_metadata(t)))


@check("landing_incremental", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def landing_incremental(t: Tables) -> DataFrame:
    """Two runs; the second takes the part that came after the first, and only that."""
    folder, bronze, state = t.run_dir("landing"), t.run_dir("bronze"), t.run_dir("state")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    parts = rows.toDF(*[c.upper() for c in rows.columns])
    for condition in ("O_ORDERSTATUS = 'F'", "O_ORDERSTATUS <> 'F'"):
        parts.where(condition).write.mode("append").parquet(folder)
        land(landing_stream(t.spark, folder, parts.schema), state, append_batches(bronze))
    return read_landed(t.spark, bronze, rows.schema)


@check(
    "landing_upsert",
    """SELECT o_custkey, o_orderkey, o_totalprice, o_version FROM (
      SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 4 END AS o_version FROM orders)
    QUALIFY row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_version DESC NULLS LAST, o_orderkey DESC, o_totalprice DESC) = 1""",
)
def landing_upsert(t: Tables) -> DataFrame:
    """Orders of a customer in three batches: late, without a version, and of one version."""
    folder, state = t.run_dir("landing"), t.run_dir("state")
    version = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 4)
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", version.alias("o_version"))
    store = t.store("landing")
    store.replace(rows.limit(0), "orders")
    write = upsert_batches(store, "orders", ["o_custkey"], "o_version")
    for part in range(3):
        rows.where(F.col("o_orderkey") % 3 == part).write.mode("append").parquet(folder)
        land(landing_stream(t.spark, folder, rows.schema), state, write)
    return store.read("orders")
