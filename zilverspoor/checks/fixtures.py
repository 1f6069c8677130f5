"""Register-shaped frames on the given tables, each as Spark and as SQL.

Every frame uses the whole table it stands on; a condition on an attribute says
what the rows mean (a market segment stands for the deceased, for example).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zilverspoor.checks.core import Tables


@dataclass(frozen=True)
class Fixture:
    frame: Callable[[Tables], DataFrame]
    sql: str


FIXTURES: dict[str, Fixture] = {}


def _fixture(name: str, sql: str):
    def register(frame: Callable[[Tables], DataFrame]):
        FIXTURES[name] = Fixture(frame, sql)
        return frame

    return register


def frames(tables: Tables, *names: str) -> dict[str, DataFrame]:
    return {name: FIXTURES[name].frame(tables) for name in names}


def with_fixtures(sql: str, *names: str) -> str:
    """The SQL with the named fixtures in front, and further CTEs if it has its own."""
    ctes = ",\n".join(f"{name} AS ({FIXTURES[name].sql})" for name in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def _ymd(day: str) -> str:
    return f"cast(date_format({day}, 'yyyyMMdd') as int)"


def _ymd_sql(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


# -- social domain ----------------------------------------------------------------


@_fixture(
    "szclient",
    "SELECT c_custkey AS clientnr, CAST(c_custkey % 2 AS INTEGER) AS ind_gezag FROM customer",
)
def szclient(t: Tables) -> DataFrame:
    return t.customer.selectExpr("c_custkey as clientnr", "cast(c_custkey % 2 as int) as ind_gezag")


@_fixture("wvbesl", "SELECT o_orderkey AS besluitnr, o_custkey AS clientnr FROM orders")
def wvbesl(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey as besluitnr", "o_custkey as clientnr")


@_fixture(
    "wvind_b",
    """SELECT l_orderkey AS besluitnr, l_linenumber AS volgnr_ind, l_partkey AS clientnr,
       l_shipdate + INTERVAL 1350 MINUTE AS dd_begin,
       l_shipdate + INTERVAL 30 DAY + INTERVAL 1350 MINUTE AS dd_eind,
       CAST(l_quantity AS INTEGER) AS volume, l_linestatus AS status_indicatie,
       CAST(l_suppkey % 4 AS INTEGER) AS kode_regeling FROM lineitem""",
)
def wvind_b(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey as besluitnr",
        "l_linenumber as volgnr_ind",
        "l_partkey as clientnr",
        "l_shipdate + interval 1350 minutes as dd_begin",
        "l_shipdate + interval 30 days + interval 1350 minutes as dd_eind",
        "cast(l_quantity as int) as volume",
        "l_linestatus as status_indicatie",
        "cast(l_suppkey % 4 as int) as kode_regeling",
    )


@_fixture(
    "szregel",
    "SELECT * FROM (VALUES (0, 'JEUGDWET'), (1, 'WMO'), (2, NULL)) AS v(kode_regeling, omschryving)",
)
def szregel(t: Tables) -> DataFrame:
    return t.spark.sql(FIXTURES["szregel"].sql)


@_fixture(
    "wvdos",
    """SELECT l_orderkey AS besluitnr, l_linenumber AS volgnr_ind,
       l_orderkey * 10 + l_linenumber AS uniek, min(l_returnflag) AS kode_reden_einde_voorz
       FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def wvdos(t: Tables) -> DataFrame:
    return (
        # the flags are single letters: their code points aggregate by hashing
        t.lineitem.groupBy("l_orderkey", "l_linenumber")
        .agg(F.min(F.ascii("l_returnflag")).alias("flag"))
        .selectExpr(
            "l_orderkey as besluitnr",
            "l_linenumber as volgnr_ind",
            "l_orderkey * 10 + l_linenumber as uniek",
            "char(flag) as kode_reden_einde_voorz",
        )
    )


@_fixture(
    "abc_refcod",
    """SELECT * FROM (VALUES ('A', 'JZG_REDEN_EINDE_PRODUCT', 'x'), ('R', 'WVRTEIND', 'y'),
       ('N', 'JZG_REDEN_EINDE_PRODUCT', 'z'), ('N', 'WVRTEIND', 'w'))
       AS v(code, domein, omschrijving)""",
)
def abc_refcod(t: Tables) -> DataFrame:
    return t.spark.sql(FIXTURES["abc_refcod"].sql)


@_fixture(
    "szukhis",
    """SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS uniekwvdos,
       CAST(l_extendedprice AS DECIMAL(10,2)) AS bedrag, l_suppkey AS verslagnr FROM lineitem""",
)
def szukhis(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "cast(l_orderkey * 10 + l_linenumber as string) as uniekwvdos",
        "cast(l_extendedprice as decimal(10,2)) as bedrag",
        "l_suppkey as verslagnr",
    )


@_fixture(
    "szwerker",
    """SELECT s_suppkey AS kode_werker, s_name AS naam, s_nationkey AS kode_instan,
       lower(s_name) || '@x.nl' AS e_mail,
       CASE s_suppkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'V' END AS ind_geslacht,
       CAST(NULL AS VARCHAR) AS toelichting, CAST(s_suppkey AS VARCHAR) AS telefoon
       FROM supplier""",
)
def szwerker(t: Tables) -> DataFrame:
    return t.supplier.selectExpr(
        "s_suppkey as kode_werker",
        "s_name as naam",
        "s_nationkey as kode_instan",
        "lower(s_name) || '@x.nl' as e_mail",
        "case s_suppkey % 3 when 0 then 'M' when 1 then 'V' end as ind_geslacht",
        "cast(null as string) as toelichting",
        "cast(s_suppkey as string) as telefoon",
    )


# -- civil registry ---------------------------------------------------------------


@_fixture(
    "gba_tinsgeg",
    """SELECT c_custkey AS rsys_prs,
       CASE c_custkey % 7 WHEN 0 THEN 'E' WHEN 1 THEN 'M' WHEN 2 THEN 'F' WHEN 3 THEN '.'
            WHEN 6 THEN 'R' END AS kops,
       CAST(20200101 + c_custkey % 28 AS VARCHAR) AS dops, c_mktsegment AS kbst,
       20010203 AS dtoe_gba FROM customer""",
)
def gba_tinsgeg(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey as rsys_prs",
        "case c_custkey % 7 when 0 then 'E' when 1 then 'M' when 2 then 'F' when 3 then '.' "
        "when 6 then 'R' end as kops",
        "cast(20200101 + c_custkey % 28 as string) as dops",
        "c_mktsegment as kbst",
        "20010203 as dtoe_gba",
    )


@_fixture(
    "gba_tovlakt",
    """SELECT c_custkey AS rsys_prs, CAST(20190101 + c_custkey % 28 AS INTEGER) AS dovl_gba
       FROM customer WHERE c_mktsegment = 'HOUSEHOLD'""",
)
def gba_tovlakt(t: Tables) -> DataFrame:
    return t.customer.where("c_mktsegment = 'HOUSEHOLD'").selectExpr(
        "c_custkey as rsys_prs", "cast(20190101 + c_custkey % 28 as int) as dovl_gba"
    )


_REGISTRATION_SQL = """SELECT c_custkey AS rsys_prs,
       CASE WHEN c_custkey % 11 = 0 THEN 'B' ELSE 'A' END AS ireg,
       c_custkey + 500000 AS rsys_nam,
       CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'V' END AS kgsl FROM customer"""


def _registrations(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "c_custkey as rsys_prs",
        "case when c_custkey % 11 = 0 then 'B' else 'A' end as ireg",
        "c_custkey + 500000 as rsys_nam",
        "case when c_custkey % 2 = 0 then 'M' else 'V' end as kgsl",
    )


@_fixture("gba_tprsgeg", _REGISTRATION_SQL + " WHERE c_nationkey >= 5")
def gba_tprsgeg(t: Tables) -> DataFrame:
    return _registrations(t.customer.where("c_nationkey >= 5"))


@_fixture("gba_tarcgeg", _REGISTRATION_SQL + " WHERE c_nationkey < 5")
def gba_tarcgeg(t: Tables) -> DataFrame:
    return _registrations(t.customer.where("c_nationkey < 5"))


@_fixture(
    "gba_tnamreg",
    """SELECT c_custkey + 500000 AS rsys_nam,
       1000000000 + c_custkey - CASE WHEN c_custkey % 5 = 4 THEN 1 ELSE 0 END AS radm,
       c_custkey * 37 AS rsofi, c_name AS nvoor, substr(c_name, 1, 1) || '.' AS nvlr_gba,
       CASE WHEN c_custkey % 2 = 0 THEN 'van' END AS nvgsl, c_mktsegment AS ngsl,
       CAST(19500101 + (c_custkey % 50) * 10000 AS INTEGER) AS dgeb_gba
       FROM customer WHERE c_nationkey <> 7""",
)
def gba_tnamreg(t: Tables) -> DataFrame:
    return t.customer.where("c_nationkey <> 7").selectExpr(
        "c_custkey + 500000 as rsys_nam",
        "1000000000 + c_custkey - case when c_custkey % 5 = 4 then 1 else 0 end as radm",
        "c_custkey * 37 as rsofi",
        "c_name as nvoor",
        "substr(c_name, 1, 1) || '.' as nvlr_gba",
        "case when c_custkey % 2 = 0 then 'van' end as nvgsl",
        "c_mktsegment as ngsl",
        "cast(19500101 + (c_custkey % 50) * 10000 as int) as dgeb_gba",
    )


_MOVED = "trunc(date_add(cast(o_orderdate as date), 1800), 'MM')"
_MOVED_SQL = "CAST(date_trunc('month', CAST(o_orderdate AS DATE) + 1800) AS DATE)"


@_fixture(
    "gba_tbwnhis",
    f"""SELECT o_custkey AS rsys_prs, o_custkey // 2 + o_orderkey % 2 AS rsys_adr,
       CASE WHEN o_orderkey % 37 = 3 THEN NULL WHEN o_orderkey % 31 = 5 THEN 0
            WHEN o_orderkey % 9 = 0 THEN {_ymd_sql(_MOVED_SQL)} - 1
            ELSE {_ymd_sql(_MOVED_SQL)} END AS dwon_bgn,
       {_ymd_sql(f"{_MOVED_SQL} + to_months(CAST(1 + o_orderkey % 3 AS INTEGER))")} AS dwon_end,
       nullif(substr('WVOFUAMX', o_orderkey % 9 + 1, 1), '') AS kwon_end,
       CAST(o_orderkey % 4 AS INTEGER) AS rvlg FROM orders""",
)
def gba_tbwnhis(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_custkey as rsys_prs",
        "o_custkey div 2 + o_orderkey % 2 as rsys_adr",
        f"case when o_orderkey % 37 = 3 then null when o_orderkey % 31 = 5 then 0 "
        f"when o_orderkey % 9 = 0 then {_ymd(_MOVED)} - 1 else {_ymd(_MOVED)} end as dwon_bgn",
        f"{_ymd(f'add_months({_MOVED}, cast(1 + o_orderkey % 3 as int))')} as dwon_end",
        "nullif(substr('WVOFUAMX', cast(o_orderkey % 9 + 1 as int), 1), '') as kwon_end",
        "cast(o_orderkey % 4 as int) as rvlg",
    )


@_fixture(
    "gba_tvbpakt",
    """SELECT c_custkey AS rsys_prs, c_custkey // 2 AS rsys_adr,
       CAST(CASE WHEN c_custkey % 29 = 7 THEN 0 WHEN c_custkey % 17 = 4 THEN 20100300
            ELSE 20100101 + c_custkey % 28 END AS INTEGER) AS dadrh,
       CAST(c_custkey % 10 AS INTEGER) AS kigs_gzr,
       nullif(substr('AZ', c_custkey % 3 + 1, 1), '') AS kadrf FROM customer""",
)
def gba_tvbpakt(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey as rsys_prs",
        "c_custkey div 2 as rsys_adr",
        "cast(case when c_custkey % 29 = 7 then 0 when c_custkey % 17 = 4 then 20100300 "
        "else 20100101 + c_custkey % 28 end as int) as dadrh",
        "cast(c_custkey % 10 as int) as kigs_gzr",
        "nullif(substr('AZ', cast(c_custkey % 3 + 1 as int), 1), '') as kadrf",
    )


@_fixture(
    "gba_tgbaadr",
    """SELECT p_partkey AS rsys_adr, CASE WHEN p_partkey % 4 <> 0 THEN p_partkey END AS nid_nad,
       CASE WHEN p_partkey % 5 <> 0 THEN p_partkey END AS nid_vbo, p_name AS nstr, p_size AS rhs,
       CASE WHEN p_partkey % 3 <> 0 THEN 'A' END AS nhsr_lt,
       CASE WHEN p_partkey % 5 <> 1 THEN 'bis' END AS khsr_tv,
       CASE WHEN p_partkey % 7 = 2 THEN 'to' END AS khsr_ad,
       7500 + p_size AS kpst_num, CASE WHEN p_partkey % 11 <> 0 THEN 'AB' END AS kpst_alf,
       p_brand AS nwpl_nm FROM part""",
)
def gba_tgbaadr(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_partkey as rsys_adr",
        "case when p_partkey % 4 <> 0 then p_partkey end as nid_nad",
        "case when p_partkey % 5 <> 0 then p_partkey end as nid_vbo",
        "p_name as nstr",
        "p_size as rhs",
        "case when p_partkey % 3 <> 0 then 'A' end as nhsr_lt",
        "case when p_partkey % 5 <> 1 then 'bis' end as khsr_tv",
        "case when p_partkey % 7 = 2 then 'to' end as khsr_ad",
        "7500 + p_size as kpst_num",
        "case when p_partkey % 11 <> 0 then 'AB' end as kpst_alf",
        "p_brand as nwpl_nm",
    )


@_fixture(
    "gba_tselbst",
    """SELECT c_custkey AS rsys_prs,
       CASE c_custkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS khfd_bew FROM customer""",
)
def gba_tselbst(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey as rsys_prs", "case c_custkey % 3 when 0 then 0 when 1 then 1 end as khfd_bew"
    )


_DOMAIN = """case n_regionkey when 0 then 'KADRF' when 1 then 'KWON_END' when 2 then 'KHWO'
             when 3 then 'KSRT_VRB' else 'KIGS_GZR' end"""
_CODES = """case n_regionkey when 0 then 'ABCDE' when 1 then 'WVOUA' when 2 then 'SOVND'
            when 3 then 'HQXYZ' else '12345' end"""


@_fixture(
    "gba_tdomein",
    f"""SELECT substr({_CODES}, n_nationkey // 5 + 1, 1) AS kode, {_DOMAIN} AS kveld,
       n_name AS oms FROM nation""",
)
def gba_tdomein(t: Tables) -> DataFrame:
    return t.nation.selectExpr(
        f"substr({_CODES}, cast(n_nationkey div 5 + 1 as int), 1) as kode",
        f"{_DOMAIN} as kveld",
        "n_name as oms",
    )


@_fixture(
    "ods_cen_gba_tdomein",
    """SELECT CAST(p_partkey AS VARCHAR) AS kode, p_name AS oms,
       CASE WHEN p_type = 'ECONOMY' THEN 'KIGS_GZR' ELSE 'KADRF' END AS kveld,
       p_size % 2 AS dwh_actueel FROM part""",
)
def ods_cen_gba_tdomein(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "cast(p_partkey as string) as kode",
        "p_name as oms",
        "case when p_type = 'ECONOMY' then 'KIGS_GZR' else 'KADRF' end as kveld",
        "p_size % 2 as dwh_actueel",
    )


_WEDDING = "19900000 + ({0} % 25) * 10000 + ({0} % 13) * 100 + {0} % 29"


@_fixture(
    "gba_thuwakt",
    f"""SELECT c_custkey AS rsys_prs, CAST(c_custkey % 3 AS INTEGER) AS rvlg_hw,
       c_custkey + 500001 AS rsys_nam, CAST({_WEDDING.format('c_custkey')} AS INTEGER) AS dhw,
       CASE WHEN c_nationkey % 2 = 1
            THEN CAST({_WEDDING.format('c_custkey')} + 50000 AS INTEGER) END AS dhwo,
       '1A' || CASE WHEN c_custkey % 4 = 0 THEN 'H' ELSE 'B' END || '0' AS kakt,
       nullif(substr('SOVQ', c_custkey % 5 + 1, 1), '') AS khwo,
       substr('HP', c_custkey % 2 + 1, 1) AS ksrt_vrb,
       CAST(20000101 + (c_custkey % 9) * 10000 AS INTEGER) AS dgld,
       CAST(20050101 + c_custkey % 28 AS INTEGER) AS dopn
       FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'""",
)
def gba_thuwakt(t: Tables) -> DataFrame:
    return t.customer.where("c_mktsegment <> 'AUTOMOBILE'").selectExpr(
        "c_custkey as rsys_prs",
        "cast(c_custkey % 3 as int) as rvlg_hw",
        "c_custkey + 500001 as rsys_nam",
        f"cast({_WEDDING.format('c_custkey')} as int) as dhw",
        f"case when c_nationkey % 2 = 1 then cast({_WEDDING.format('c_custkey')} + 50000 as int) "
        "end as dhwo",
        "'1A' || case when c_custkey % 4 = 0 then 'H' else 'B' end || '0' as kakt",
        "nullif(substr('SOVQ', cast(c_custkey % 5 + 1 as int), 1), '') as khwo",
        "substr('HP', cast(c_custkey % 2 + 1 as int), 1) as ksrt_vrb",
        "cast(20000101 + (c_custkey % 9) * 10000 as int) as dgld",
        "cast(20050101 + c_custkey % 28 as int) as dopn",
    )


@_fixture(
    "gba_thuwhis",
    f"""SELECT o_custkey AS rsys_prs, CAST(o_orderkey % 3 AS INTEGER) AS rvlg_hw,
       o_custkey + 500001 + o_orderkey % 2 AS rsys_nam,
       CAST({_WEDDING.format('o_orderkey')} AS INTEGER) AS dhw,
       CASE WHEN o_orderkey % 4 = 1
            THEN CAST({_WEDDING.format('o_orderkey')} + 30000 AS INTEGER) END AS dhwo,
       '2B' || CASE WHEN o_orderkey % 4 = 0 THEN 'H' ELSE 'C' END || '1' AS kakt,
       nullif(substr('SOVQ', o_orderkey % 5 + 1, 1), '') AS khwo,
       substr('HP', o_orderkey % 2 + 1, 1) AS ksrt_vrb,
       {_ymd_sql('o_orderdate')} AS dgld, {_ymd_sql('o_orderdate')} AS dopn,
       CASE WHEN o_orderkey % 5 = 0 THEN 'J' END AS ionj FROM orders""",
)
def gba_thuwhis(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_custkey as rsys_prs",
        "cast(o_orderkey % 3 as int) as rvlg_hw",
        "o_custkey + 500001 + o_orderkey % 2 as rsys_nam",
        f"cast({_WEDDING.format('o_orderkey')} as int) as dhw",
        f"case when o_orderkey % 4 = 1 then cast({_WEDDING.format('o_orderkey')} + 30000 as int) "
        "end as dhwo",
        "'2B' || case when o_orderkey % 4 = 0 then 'H' else 'C' end || '1' as kakt",
        "nullif(substr('SOVQ', cast(o_orderkey % 5 + 1 as int), 1), '') as khwo",
        "substr('HP', cast(o_orderkey % 2 + 1 as int), 1) as ksrt_vrb",
        f"{_ymd('cast(o_orderdate as date)')} as dgld",
        f"{_ymd('cast(o_orderdate as date)')} as dopn",
        "case when o_orderkey % 5 = 0 then 'J' end as ionj",
    )
