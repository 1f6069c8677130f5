"""Projections, filters, set operations, simple aggregates and name resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zilverspoor.checks.core import Tables, check, text
from zilverspoor.checks.fixtures import frames, with_fixtures
from zilverspoor.functions import code_label
from zilverspoor.operators.columns import (
    coerce_labels,
    lower_columns,
    project,
    resolve_columns,
    resolve_table,
)
from zilverspoor.operators.conform import conform, harmonise_decimals, to_bronze
from zilverspoor.operators.history import union_history
from zilverspoor.operators.windows import by, top_row
from zilverspoor.contracts import DECLARATIEREGEL
from zilverspoor.plans.civil import (
    END_REASONS,
    YES_NO,
    closed_addresses,
    counted_persons,
    marriage_conversions,
)


@check("project_rename", 'SELECT c_custkey AS "CLIENT_ID", c_name AS "NAAM" FROM customer')
def project_rename(t: Tables) -> DataFrame:
    return project(t.customer, {"CLIENT_ID": "c_custkey", "NAAM": "c_name"})


@check(
    "typed_nulls",
    """SELECT s_suppkey AS id, CAST(NULL AS VARCHAR) AS code, CAST(NULL AS VARCHAR) AS day,
    CAST(NULL AS INTEGER) AS number FROM supplier""",
)
def typed_nulls(t: Tables) -> DataFrame:
    nulls = {"code": "string", "day": "date", "number": "int"}
    return project(t.supplier, {"id": "s_suppkey"}, nulls)


@check(
    "project_constants",
    """SELECT s_suppkey AS id, 'CEN_BRP' AS bron, 1 AS actueel, -1 AS rvlg,
    'Woonadres' AS herkomst FROM supplier""",
)
def project_constants(t: Tables) -> DataFrame:
    constants = {"bron": "CEN_BRP", "actueel": 1, "rvlg": -1, "herkomst": "Woonadres"}
    return project(t.supplier, {"id": "s_suppkey"}, constants=constants)


@check("lower_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def lower(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return lower_columns(orders.toDF("O_ORDERKEY", "O_CustKey", "o_orderstatus"))


@check("coerce_label_case", 'SELECT p_partkey AS "P_PARTKEY", p_name AS "P_NAME" FROM part')
def coerce_label_case(t: Tables) -> DataFrame:
    return coerce_labels(t.part.select("p_partkey", "p_name"), "upper")


@check(
    "filter_three_valued",
    with_fixtures(
        "SELECT * FROM gba_tbwnhis WHERE dwon_end >= 20000101 AND kwon_end <> 'F'", "gba_tbwnhis"
    ),
)
def filter_three_valued(t: Tables) -> DataFrame:
    return closed_addresses(frames(t, "gba_tbwnhis")["gba_tbwnhis"])


@check(
    "filter_null",
    with_fixtures(
        "SELECT rsys_prs, kops IS NULL AS unknown FROM gba_tinsgeg "
        "WHERE kops IS NULL OR dops IS NOT NULL",
        "gba_tinsgeg",
    ),
)
def filter_null(t: Tables) -> DataFrame:
    persons = frames(t, "gba_tinsgeg")["gba_tinsgeg"]
    return persons.where(F.col("kops").isNull() | F.col("dops").isNotNull()).select(
        "rsys_prs", F.col("kops").isNull().alias("unknown")
    )


@check(
    "filter_coalesce_exclude",
    with_fixtures("SELECT * FROM gba_tinsgeg WHERE coalesce(kops, 'x') <> 'F'", "gba_tinsgeg"),
)
def filter_coalesce_exclude(t: Tables) -> DataFrame:
    return counted_persons(frames(t, "gba_tinsgeg")["gba_tinsgeg"])


@check(
    "case_searched",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'groot'
    WHEN o_orderstatus = 'F' THEN 'klaar' ELSE o_orderpriority END AS soort FROM orders""",
)
def case_searched(t: Tables) -> DataFrame:
    kind = (
        F.when(F.col("o_totalprice") > 300000, "groot")
        .when(F.col("o_orderstatus") == "F", "klaar")
        .otherwise(F.col("o_orderpriority"))
    )
    return t.orders.select("o_orderkey", kind.alias("soort"))


@check(
    "case_decode",
    with_fixtures(
        """SELECT rsys_prs, rsys_adr, CASE kwon_end WHEN 'W' THEN 'Adreswijziging'
        WHEN 'V' THEN 'Vertrokken' WHEN 'O' THEN 'Overleden' WHEN 'F' THEN 'Foutieve persoonslijst'
        WHEN 'U' THEN 'Vernummering' WHEN 'A' THEN 'Vernaming' WHEN 'M' THEN 'Ministerieel besluit'
        WHEN 'X' THEN 'Geactualiseerd' END AS reden,
        CASE rvlg WHEN 1 THEN 'Ja' WHEN 0 THEN 'Nee' END AS eerste FROM gba_tbwnhis""",
        "gba_tbwnhis",
    ),
)
def case_decode(t: Tables) -> DataFrame:
    return frames(t, "gba_tbwnhis")["gba_tbwnhis"].select(
        "rsys_prs",
        "rsys_adr",
        code_label(F.col("kwon_end"), END_REASONS).alias("reden"),
        code_label(F.col("rvlg"), YES_NO).alias("eerste"),
    )


@check(
    "agg_group_min",
    with_fixtures(
        """SELECT rsys_prs, rvlg_hw, min(dgld) AS first_conversion FROM gba_thuwhis
        WHERE substr(kakt, 3, 1) = 'H' GROUP BY rsys_prs, rvlg_hw""",
        "gba_thuwhis",
    ),
)
def agg_group_min(t: Tables) -> DataFrame:
    return marriage_conversions(frames(t, "gba_thuwhis")["gba_thuwhis"])


@check("distinct_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus").distinct()


@check(
    "top1_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey) AS rn FROM orders) AS r WHERE rn = 1""",
)
def top1_per_group(t: Tables) -> DataFrame:
    latest = top_row(t.orders, ["o_custkey"], [by("o_orderdate", True), by("o_orderkey")])
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")


@check(
    "union_history_current",
    with_fixtures(
        """SELECT rsys_prs, rsys_adr, dwon_bgn, dwon_end, kwon_end, NULL AS kigs_gzr
        FROM gba_tbwnhis WHERE dwon_end >= 20000101 AND kwon_end <> 'F'
        UNION ALL SELECT rsys_prs, rsys_adr, dadrh, NULL, NULL, kigs_gzr FROM gba_tvbpakt""",
        "gba_tbwnhis",
        "gba_tvbpakt",
    ),
)
def union_history_current(t: Tables) -> DataFrame:
    src = frames(t, "gba_tbwnhis", "gba_tvbpakt")
    current = src["gba_tvbpakt"].select(
        "rsys_prs", "rsys_adr", F.col("dadrh").alias("dwon_bgn"), "kigs_gzr"
    )
    return union_history(closed_addresses(src["gba_tbwnhis"]).drop("rvlg"), current)


# -- types --------------------------------------------------------------------------


@check(
    "bronze_typed",
    text(
        """SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
        CAST(l_quantity AS DECIMAL(10,2)) AS l_quantity, CAST(l_partkey AS INTEGER) AS l_partkey,
        l_returnflag FROM lineitem""",
        "l_quantity",
    ),
)
def bronze_typed(t: Tables) -> DataFrame:
    source = t.lineitem.select(
        F.col("l_orderkey").cast("decimal(18,0)").alias("L_ORDERKEY"),
        F.col("l_linenumber").cast("decimal(4,0)").alias("L_LINENUMBER"),
        F.col("l_quantity").cast("decimal(10,2)").alias("L_Quantity"),
        F.col("l_partkey").cast("decimal(9,0)").alias("L_PARTKEY"),
        F.concat("l_returnflag", F.lit("\x00")).alias("L_RETURNFLAG"),
    )
    return to_bronze(source)


@check(
    "bool_hint",
    "SELECT o_orderkey, o_orderkey % 3 <> 0 AS flag, o_orderkey % 3 AS number FROM orders",
)
def bool_hint(t: Tables) -> DataFrame:
    source = t.orders.select(
        "o_orderkey",
        (F.col("o_orderkey") % 3).cast("decimal(1,0)").alias("FLAG"),
        (F.col("o_orderkey") % 3).alias("NUMBER"),
    )
    return to_bronze(source, one_digit_is_boolean=True)


@check(
    "decimal_harmonise",
    text(
        """SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag = 'A'
          THEN CAST(l_extendedprice AS DECIMAL(10,2)) ELSE CAST(l_discount AS DECIMAL(14,4)) END
          AS DECIMAL(14,4)) AS price FROM lineitem""",
        "price",
    ),
)
def decimal_harmonise(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    one = t.lineitem.where("l_returnflag = 'A'").select(
        "l_orderkey", "l_linenumber", price.cast("decimal(10,2)").alias("price")
    )
    other = t.lineitem.where("l_returnflag <> 'A'").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").cast("decimal(14,4)").alias("PRICE")
    )
    return harmonise_decimals([one, other])


@check(
    "conform_contract",
    """SELECT CAST(l_orderkey AS VARCHAR) AS id, CASE WHEN length(l_returnflag || l_linestatus
      || CAST(l_orderkey AS VARCHAR) || repeat('x', CAST(l_linenumber * 2 AS INTEGER))) > 20
      THEN 'length:CODE' END AS problem,
    CAST(TRY_CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) AS bedrag FROM lineitem""",
)
def conform_contract(t: Tables) -> DataFrame:
    """Every row ends on one of the two sides; rejected ones say why."""
    code = F.concat(
        "l_returnflag",
        "l_linestatus",
        F.col("l_orderkey").cast("string"),
        F.expr("repeat('x', cast(l_linenumber * 2 as int))"),
    )
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("declaratieregel_id"),
        F.col("l_extendedprice").alias("bedrag"),
        code.alias("code"),
    )
    result = conform(rows, DECLARATIEREGEL)
    accepted = result.accepted.select(
        F.col("DECLARATIEREGEL_ID").alias("id"),
        F.lit(None).cast("string").alias("problem"),
        F.col("BEDRAG").alias("bedrag"),
    )
    rejected = result.rejected.select(
        F.col("DECLARATIEREGEL_ID").alias("id"),
        F.array_join("problems", ",").alias("problem"),
        F.col("BEDRAG").alias("bedrag"),
    )
    return accepted.unionByName(rejected)


# -- names --------------------------------------------------------------------------


@check("resolve_required", "SELECT o_orderkey AS besluitnr, o_custkey AS clientnr FROM orders")
def resolve_required(t: Tables) -> DataFrame:
    """Two spellings of a table; only the upper-case one has what is needed."""
    complete = t.orders.selectExpr("o_orderkey as BESLUITNR", "o_custkey as CLIENTNR")
    tables = {"wvbesl": t.nation.selectExpr("n_nationkey as besluitnr"), "WVBESL": complete}
    found = resolve_table(tables, "wvbesl", ["besluitnr", "clientnr"])
    return resolve_columns(found, ["besluitnr", "clientnr"])


@check("resolve_columns", "SELECT c_custkey AS clientnr, c_name AS naam FROM customer")
def resolve_columns_query(t: Tables) -> DataFrame:
    source = t.customer.select("c_custkey", "c_name", "c_acctbal").toDF("ClientNr", "NAAM", "saldo")
    return resolve_columns(source, ["clientnr", "naam"])
