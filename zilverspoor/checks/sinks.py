"""Write modes: each query writes the given rows and reads the table back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zilverspoor.checks.core import Tables, check
from zilverspoor.checks.fixtures import frames, with_fixtures
from zilverspoor.contracts import BESCHIKKING, WET_ENUM
from zilverspoor.plans import Bronze
from zilverspoor.sinks.load import REJECTED, create_silver, load_silver
from zilverspoor.sinks.parts import dump_parts
from zilverspoor.sinks.tables import TableStore
from zilverspoor.sources.files import read_manifest_tables

_OPEN, _DONE = "o_orderstatus <> 'F'", "o_orderstatus = 'F'"
_ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"


def _orders(t: Tables, condition: str = "true") -> DataFrame:
    return t.orders.where(condition).select("o_orderkey", "o_custkey", "o_orderstatus")


def _loaded(t: Tables, label: str) -> TableStore:
    """A store whose table ``orders`` holds the finished orders."""
    store = t.store(label)
    store.load_staging(_orders(t, _DONE), "orders", "replace")
    return store


@check("write_replace", f"SELECT o_orderkey AS besluitnr FROM orders WHERE {_OPEN}")
def write_replace(t: Tables) -> DataFrame:
    """The new rows bring their own columns."""
    store = _loaded(t, "replace")
    rows = _orders(t, _OPEN).select(F.col("o_orderkey").alias("besluitnr"))
    store.load_staging(rows, "orders", "replace")
    return store.read("orders")


@check("write_truncate", f"{_ORDER_SQL} WHERE {_OPEN}")
def write_truncate(t: Tables) -> DataFrame:
    store = _loaded(t, "truncate")
    store.load_staging(_orders(t, _OPEN), "orders", "truncate")
    return store.read("orders")


@check("write_append", _ORDER_SQL)
def write_append(t: Tables) -> DataFrame:
    store = _loaded(t, "append")
    store.load_staging(_orders(t, _OPEN), "orders", "append")
    return store.read("orders")


_DECISION_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS "BESCHIKKING_ID",
    CAST({client} AS VARCHAR) AS "CLIENT_ID", CAST({wet} AS VARCHAR) AS "WET" FROM orders"""


def _decisions(t: Tables, condition: str, client: str, wet: str = "null") -> DataFrame:
    return t.orders.where(condition).select(
        F.col("o_orderkey").cast("string").alias("BESCHIKKING_ID"),
        F.expr(client).cast("string").alias("CLIENT_ID"),
        F.expr(wet).cast("string").alias("WET"),
    )


def _silver(t: Tables, label: str) -> TableStore:
    """A store whose decisions are the finished orders."""
    store = t.store(label)
    store.create(BESCHIKKING)
    store.write(_decisions(t, _DONE, "o_custkey", "'JEUGDWET'"), "BESCHIKKING", "append")
    return store


def _decided(store: TableStore) -> DataFrame:
    return store.read("BESCHIKKING").select("BESCHIKKING_ID", "CLIENT_ID", "WET")


@check("silver_overwrite", _DECISION_SQL.format(client="o_custkey + 1", wet="NULL"))
def silver_overwrite(t: Tables) -> DataFrame:
    store = _silver(t, "overwrite")
    store.write(_decisions(t, "true", "o_custkey + 1"), "BESCHIKKING", "overwrite")
    return _decided(store)


@check(
    "silver_append",
    _DECISION_SQL.format(
        client="o_custkey", wet="CASE WHEN o_orderstatus = 'F' THEN 'JEUGDWET' END"
    ),
)
def silver_append(t: Tables) -> DataFrame:
    store = _silver(t, "append")
    store.write(_decisions(t, _OPEN, "o_custkey"), "BESCHIKKING", "append")
    return _decided(store)


@check(
    "silver_truncate",
    _DECISION_SQL.format(client="o_custkey", wet="NULL") + f" WHERE {_OPEN}",
)
def silver_truncate(t: Tables) -> DataFrame:
    store = _silver(t, "truncate")
    store.write(_decisions(t, _OPEN, "o_custkey"), "BESCHIKKING", "truncate")
    return _decided(store)


@check(
    "silver_upsert",
    _DECISION_SQL.format(
        client="CASE WHEN o_orderstatus = 'F' AND o_totalprice < 200000 THEN o_custkey "
        "ELSE o_custkey + 1 END",
        wet="CASE WHEN o_orderstatus = 'F' AND o_totalprice < 200000 THEN 'JEUGDWET' END",
    ),
)
def silver_upsert(t: Tables) -> DataFrame:
    """Dear finished orders change, their law becomes NULL; open orders are new."""
    store = _silver(t, "upsert")
    rows = _decisions(t, f"not ({_DONE} and o_totalprice < 200000)", "o_custkey + 1")
    store.write(rows, "BESCHIKKING", "upsert", key=BESCHIKKING.primary_key)
    return _decided(store)


@check(
    "insert_by_name",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "BESCHIKKING_ID", CAST(NULL AS VARCHAR) AS "CODE",
    CAST(o_custkey AS VARCHAR) AS "CLIENT_ID" FROM orders""",
)
def insert_by_name(t: Tables) -> DataFrame:
    """Labels in another order and another case; columns not named stay NULL."""
    store = t.store("byname")
    store.create(BESCHIKKING)
    rows = t.orders.select(
        F.col("o_custkey").cast("string").alias("client_id"),
        F.col("o_orderkey").cast("string").alias("Beschikking_Id"),
    )
    store.append(rows, "BESCHIKKING")
    return store.read("BESCHIKKING").select("BESCHIKKING_ID", "CODE", "CLIENT_ID")


@check(
    "dump_parts",
    with_fixtures("SELECT besluitnr, clientnr FROM wvbesl", "wvbesl"),
)
def dump_parts_query(t: Tables) -> DataFrame:
    """Written as parts of at most 2,000 rows and read back through the manifest."""
    src = frames(t, "wvbesl", "szclient")
    empty = src["szclient"].where("false")
    manifest = dump_parts(
        {"wvbesl": src["wvbesl"], "szclient": empty}, t.run_dir("dump"), max_rows_per_part=2000
    )
    return read_manifest_tables(t.spark, manifest)["wvbesl"]


@check(
    "enum_seed",
    """SELECT e.id AS "WET_ENUM_ID", e.value AS "VALUE", count(p.p_partkey) AS n_used
    FROM (VALUES ('1', 'ANDERE_WET'), ('2', 'BIJZONDERE_BIJSTAND'), ('3', 'I_O_A_W_I_O_A_Z_'),
      ('4', 'JEUGDWET'), ('5', 'LEEG'), ('6', 'NIET_VAN_TOEPASSING'), ('7', 'ONBEKEND'),
      ('8', 'PARTICIPATIEWET_PW_I'), ('9', 'WMO')) AS e(id, value)
    LEFT JOIN part p ON CAST(p.p_size AS VARCHAR) = e.id GROUP BY e.id, e.value""",
)
def enum_seed(t: Tables) -> DataFrame:
    """The seeded laws with the number of parts that use each."""
    store = t.store("seed")
    store.create(WET_ENUM)
    used = t.part.groupBy(F.col("p_size").cast("string").alias("WET_ENUM_ID")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return store.read("WET_ENUM").join(used, "WET_ENUM_ID", "left").select(
        "WET_ENUM_ID", "VALUE", F.coalesce("n", F.lit(0)).alias("n_used")
    )


@check(
    "silver_rejects",
    """SELECT CAST(p_partkey AS VARCHAR) AS code,
    CASE WHEN p_size % 5 = 0 THEN 'length:VALUE' ELSE 'fits' END AS fate FROM part""",
)
def silver_rejects(t: Tables) -> DataFrame:
    """Laws with too long a text stay out of the table and are kept with reasons."""
    store = t.store("rejects")
    create_silver(store, [WET_ENUM])
    key = F.col("p_partkey").cast("string")
    laws = t.part.select(
        key.alias("kode_regeling"),
        F.when(F.col("p_size") % 5 == 0, F.concat(F.repeat(F.lit("x"), 300), key))
        .otherwise(F.concat(F.lit("law "), key))
        .alias("omschryving"),
    )
    load_silver(Bronze({"szregel": laws}), store, ["WET_ENUM"])
    number = lambda c: F.regexp_extract(c, "(\\d+)$", 1)
    good = store.read("WET_ENUM").select(number("VALUE").alias("code"), F.lit("fits").alias("fate"))
    value = F.get_json_object("row", "$.VALUE")
    bad = store.read(REJECTED).select(
        number(value).alias("code"), F.array_join("problems", ",").alias("fate")
    )
    return good.unionByName(bad)
