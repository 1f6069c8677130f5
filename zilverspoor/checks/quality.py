"""Key, enum and reconciliation checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zilverspoor.checks.core import Tables, check
from zilverspoor.checks.fixtures import frames, with_fixtures
from zilverspoor.contracts import BESCHIKKING, CLIENT, DECLARATIEREGEL
from zilverspoor.operators.quality import (
    enum_violations,
    fk_orphans,
    pk_violations,
    reconcile_counts,
    reconcile_values,
    row_counts,
)
from zilverspoor.sinks.load import create_silver, key_report, reference_report


@check(
    "pk_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def pk_violations_query(t: Tables) -> DataFrame:
    return pk_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@check(
    "fk_orphans",
    with_fixtures(
        """SELECT h.rsys_adr, count(*) AS n_rows FROM gba_tbwnhis h
        WHERE h.rsys_adr IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM gba_tgbaadr a WHERE a.rsys_adr = h.rsys_adr + 1500)
        GROUP BY h.rsys_adr""",
        "gba_tbwnhis",
        "gba_tgbaadr",
    ),
)
def fk_orphans_query(t: Tables) -> DataFrame:
    src = frames(t, "gba_tbwnhis", "gba_tgbaadr")
    addresses = src["gba_tgbaadr"].select((F.col("rsys_adr") - 1500).alias("address_key"))
    return fk_orphans(src["gba_tbwnhis"], ["rsys_adr"], addresses, ["address_key"])


@check(
    "enum_violations",
    with_fixtures(
        """SELECT kwon_end, count(*) AS n_rows FROM gba_tbwnhis WHERE kwon_end IS NOT NULL
        AND kwon_end NOT IN (SELECT kode FROM gba_tdomein WHERE kveld = 'KWON_END')
        GROUP BY kwon_end""",
        "gba_tbwnhis",
        "gba_tdomein",
    ),
)
def enum_violations_query(t: Tables) -> DataFrame:
    src = frames(t, "gba_tbwnhis", "gba_tdomein")
    reasons = src["gba_tdomein"].where("kveld = 'KWON_END'")
    return enum_violations(src["gba_tbwnhis"], "kwon_end", reasons, "kode")


@check(
    "source_counts",
    """SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'orders', count(*) FROM orders""",
)
def source_counts(t: Tables) -> DataFrame:
    return row_counts({"customer": t.customer, "lineitem": t.lineitem, "orders": t.orders})


@check(
    "reconcile_counts",
    """SELECT 'customer' AS table_name, count(*) AS source_rows, count(*) AS loaded_rows,
      TRUE AS matches FROM customer
    UNION ALL SELECT 'orders', count(*), count(*) FILTER (o_orderstatus <> 'P'),
      count(*) = count(*) FILTER (o_orderstatus <> 'P') FROM orders
    UNION ALL SELECT 'part', count(*), NULL, FALSE FROM part""",
)
def reconcile_counts_query(t: Tables) -> DataFrame:
    source = {"customer": t.customer, "orders": t.orders, "part": t.part}
    loaded = {"customer": t.customer, "orders": t.orders.where("o_orderstatus <> 'P'")}
    return reconcile_counts(source, loaded)


@check(
    "reconcile_values",
    """SELECT l_orderkey, l_returnflag, round(l_tax, 5) AS l_tax, count(*) AS left_copies,
      count(*) FILTER (l_returnflag <> 'R') AS right_copies FROM lineitem
    GROUP BY l_orderkey, l_returnflag, round(l_tax, 5)
    HAVING count(*) <> count(*) FILTER (l_returnflag <> 'R')""",
)
def reconcile_values_query(t: Tables) -> DataFrame:
    """Noise below the fifth decimal is no difference; a missing copy is."""
    rows = t.lineitem.select("l_orderkey", "l_returnflag", "l_tax")
    loaded = rows.where("l_returnflag <> 'R'").withColumn("l_tax", F.col("l_tax") + 1e-9)
    return reconcile_values(rows, loaded)


@check(
    "silver_key_report",
    """SELECT 'DECLARATIEREGEL' AS table_name, 'DECLARATIEREGEL_ID' AS columns, 'key' AS rule,
    count(*) AS bad_values, CAST(coalesce(sum(n), 0) AS BIGINT) AS bad_rows
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
      HAVING count(*) > 1) AS twice
    UNION ALL SELECT 'BESCHIKKING', 'BESCHIKKING_ID', 'key', 0, 0""",
)
def silver_key_report(t: Tables) -> DataFrame:
    """Claim lines take the dossier number as key, which is not unique in the source."""
    store = t.store("keys")
    create_silver(store, [BESCHIKKING, DECLARATIEREGEL])
    claims = t.lineitem.selectExpr(
        "concat(l_orderkey, '-', l_linenumber) as DECLARATIEREGEL_ID",
        "cast(l_extendedprice as decimal(10,2)) as BEDRAG",
    )
    store.write(claims, "DECLARATIEREGEL", "overwrite")
    decisions = t.orders.selectExpr("cast(o_orderkey as string) as BESCHIKKING_ID")
    store.write(decisions, "BESCHIKKING", "overwrite")
    return key_report(store, [BESCHIKKING, DECLARATIEREGEL])


@check(
    "silver_reference_report",
    """SELECT 'BESCHIKKING' AS table_name, 'CLIENT_ID' AS columns, 'CLIENT' AS rule,
    count(DISTINCT o_custkey) AS bad_values, count(*) AS bad_rows FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def silver_reference_report(t: Tables) -> DataFrame:
    """Only clients with a positive balance are loaded, so some decisions lack theirs."""
    store = t.store("references")
    create_silver(store, [BESCHIKKING, CLIENT])
    decisions = t.orders.selectExpr(
        "cast(o_orderkey as string) as BESCHIKKING_ID", "cast(o_custkey as string) as CLIENT_ID"
    )
    clients = t.customer.where("c_acctbal > 0").selectExpr(
        "cast(c_custkey as string) as RECHTSPERSOON_ID"
    )
    store.write(decisions, "BESCHIKKING", "overwrite")
    store.write(clients, "CLIENT", "overwrite")
    return reference_report(store, [BESCHIKKING, CLIENT])
