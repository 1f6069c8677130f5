"""Ordered-group operators. The SQL uses plain windows throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zilverspoor.checks.core import Tables, check, text
from zilverspoor.checks.fixtures import frames, with_fixtures
from zilverspoor.checks.mappings import date_sql
from zilverspoor.functions import yyyymmdd_to_date
from zilverspoor.functions.dates import OPEN_END, UNKNOWN_BEGIN
from zilverspoor.operators.history import close_interval
from zilverspoor.operators.windows import (
    by,
    first_in_group,
    join_null_safe,
    look_ahead,
    number_rows,
    with_partition_min,
    with_running_max,
)

_DAY = "cast(date_format(cast(o_orderdate as date), 'yyyyMMdd') as int)"
_DAY_SQL = "CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER)"
# orders as stays of a customer: some without an end, some without a begin
_STAYS_SQL = f"""(SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {_DAY_SQL} END AS day FROM orders) AS s"""


def _stays(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey", "o_custkey", f"case when o_orderkey % 10 = 0 then null else {_DAY} end as day"
    )


@check(
    "win_row_number",
    f"""SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey
      ORDER BY coalesce(day, 99991231) DESC, o_orderkey) AS volgnr FROM {_STAYS_SQL}""",
)
def win_row_number(t: Tables) -> DataFrame:
    stays = _stays(t).withColumn("end_value", F.coalesce("day", F.lit(OPEN_END)))
    return number_rows(
        stays, ["o_custkey"], "end_value", "o_orderkey", "volgnr", descending=True
    ).select("o_orderkey", "o_custkey", "volgnr")


@check(
    "win_expr_partition",
    f"""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey % 50,
      coalesce(day, 19000101) ORDER BY day DESC NULLS FIRST, o_orderkey) AS volgnr
    FROM {_STAYS_SQL}""",
)
def win_expr_partition(t: Tables) -> DataFrame:
    stays = _stays(t).select(
        "o_orderkey",
        "day",
        (F.col("o_custkey") % 50).alias("unit"),
        F.coalesce("day", F.lit(UNKNOWN_BEGIN)).alias("begin_value"),
    )
    return number_rows(
        stays, ["unit", "begin_value"], "day", "o_orderkey", "volgnr", descending=True
    ).select("o_orderkey", "volgnr")


@check(
    "win_running_max",
    f"""SELECT o_orderkey, o_custkey, max(o_orderkey) OVER (PARTITION BY o_custkey
      ORDER BY coalesce(day, 99991231) DESC) AS seen_max FROM {_STAYS_SQL}""",
)
def win_running_max(t: Tables) -> DataFrame:
    stays = _stays(t).withColumn("end_value", F.coalesce("day", F.lit(OPEN_END)))
    return with_running_max(
        stays, ["o_custkey"], "end_value", "o_orderkey", "seen_max", descending=True
    ).select("o_orderkey", "o_custkey", "seen_max")


@check(
    "win_partition_min",
    with_fixtures(
        """SELECT *, min(rvlg) OVER (PARTITION BY rsys_prs, rsys_adr, dwon_bgn) AS minrvlg
        FROM gba_tbwnhis""",
        "gba_tbwnhis",
    ),
)
def win_partition_min(t: Tables) -> DataFrame:
    rows = frames(t, "gba_tbwnhis")["gba_tbwnhis"]
    return with_partition_min(rows, ["rsys_prs", "rsys_adr", "dwon_bgn"], "rvlg", "minrvlg")


@check(
    "win_lead",
    f"""SELECT o_orderkey, o_custkey, day, lead(day) OVER (PARTITION BY o_custkey
      ORDER BY day NULLS LAST, o_orderkey) AS next_day FROM {_STAYS_SQL}""",
)
def win_lead(t: Tables) -> DataFrame:
    return look_ahead(_stays(t), ["o_custkey"], "day", "next_day", ["o_orderkey"])


@check(
    "win_first_value",
    """SELECT l_orderkey, l_linenumber, l_suppkey,
      first_value(l_returnflag) OVER w AS last_flag, first_value(l_suppkey) OVER w AS last_supplier
    FROM (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_partkey, l_shipdate,
      CASE WHEN l_partkey % 4 <> 0 THEN l_returnflag END AS l_returnflag FROM lineitem) AS l
    WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS FIRST,
      l_extendedprice NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST,
      l_returnflag NULLS LAST)""",
)
def win_first_value(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn(
        "l_returnflag", F.expr("case when l_partkey % 4 <> 0 then l_returnflag end")
    )
    order = [by("l_shipdate", descending=True)]
    order += [by(c) for c in ("l_extendedprice", "l_partkey", "l_suppkey", "l_returnflag")]
    latest = first_in_group(lines, ["l_orderkey"], order, ["l_returnflag", "l_suppkey"]).toDF(
        "l_orderkey", "last_flag", "last_supplier"
    )
    return join_null_safe(
        lines.select("l_orderkey", "l_linenumber", "l_suppkey"), latest, ["l_orderkey"], "inner"
    )


@check(
    "interval_close",
    text(
        with_fixtures(
            f"""SELECT rsys_prs, rsys_adr, dwon_bgn, rvlg,
            CASE WHEN lead(dwon_bgn) OVER (PARTITION BY rsys_prs ORDER BY dwon_bgn NULLS LAST,
                dwon_end NULLS FIRST, rsys_adr, rvlg, kwon_end NULLS FIRST) = dwon_end
              THEN {date_sql('dwon_end')} - 1 ELSE {date_sql('dwon_end')} END AS end_day
            FROM gba_tbwnhis""",
            "gba_tbwnhis",
        ),
        "end_day",
    ),
)
def interval_close(t: Tables) -> DataFrame:
    rows = look_ahead(
        frames(t, "gba_tbwnhis")["gba_tbwnhis"],
        ["rsys_prs"],
        "dwon_bgn",
        "next_bgn",
        ties=["dwon_end", "rsys_adr", "rvlg", "kwon_end"],
    )
    end_day = close_interval(
        yyyymmdd_to_date(F.col("dwon_end")), F.col("dwon_end"), F.col("next_bgn")
    )
    return rows.select("rsys_prs", "rsys_adr", "dwon_bgn", "rvlg", end_day.alias("end_day"))
