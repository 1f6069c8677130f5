"""Column expressions over whole tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zilverspoor.checks.core import Tables, check, text
from zilverspoor.checks.fixtures import frames, with_fixtures
from zilverspoor.checks.mappings import date_sql, day_sql, location_sql, partial_sql
from zilverspoor import functions as Z
from zilverspoor.functions import nested
from zilverspoor.functions.dates import OPEN_END, UNKNOWN_BEGIN

# orders with a date number whose month or day part is 00 for some, and unknown for others
_NUMBER = """CASE WHEN o_orderkey % 13 = 0 THEN 0 WHEN o_orderkey % 17 = 0 THEN NULL
    WHEN o_orderkey % 19 = 0 THEN -1 WHEN o_orderkey % 11 = 0 THEN 20240000 + o_orderkey % 20
    WHEN o_orderkey % 7 = 0 THEN 20240100 + (o_orderkey % 12) * 100
    ELSE 19900101 + (o_orderkey % 40) * 10000 + (o_orderkey % 15) * 100 + o_orderkey % 33 END"""


def _numbers(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.expr(f"cast({_NUMBER} as int)").alias("x"))


_NUMBERS_SQL = f"(SELECT o_orderkey, CAST({_NUMBER} AS INTEGER) AS x FROM orders) AS n"


@check(
    "fn_yyyymmdd_to_date",
    f"SELECT o_orderkey, CAST({date_sql('x')} AS VARCHAR) AS d FROM {_NUMBERS_SQL}",
)
def fn_yyyymmdd_to_date(t: Tables) -> DataFrame:
    return _numbers(t).select("o_orderkey", Z.yyyymmdd_to_date(F.col("x")).alias("d"))


@check(
    "fn_incomplete_date",
    f"SELECT o_orderkey, CAST({partial_sql('x')} AS VARCHAR) AS d FROM {_NUMBERS_SQL}",
)
def fn_incomplete_date(t: Tables) -> DataFrame:
    return _numbers(t).select("o_orderkey", Z.incomplete_date_to_date(F.col("x")).alias("d"))


@check(
    "fn_date_minus_one",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS d FROM orders",
)
def fn_date_minus_one(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", Z.date_minus_one(day).alias("d"))


@check(
    "fn_yesterday_int",
    """SELECT o_orderkey, CAST(strftime(CAST(o_orderdate AS DATE) - 1, '%Y%m%d') AS INTEGER)
       AS yesterday, 20240614 AS fixed_yesterday FROM orders""",
)
def fn_yesterday_int(t: Tables) -> DataFrame:
    as_of = F.lit(datetime.date(2024, 6, 15))
    return t.orders.select(
        "o_orderkey",
        Z.yesterday_number(F.col("o_orderdate").cast("date")).alias("yesterday"),
        Z.yesterday_number(as_of).alias("fixed_yesterday"),
    )


@check(
    "fn_format_date",
    "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS d FROM orders",
)
def fn_format_date(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", Z.format_date(F.col("o_orderdate").cast("date")).alias("d"))


@check(
    "fn_right",
    "SELECT l_orderkey, l_linenumber, right(CAST(l_orderkey AS VARCHAR), 2) AS tail FROM lineitem",
)
def fn_right(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", Z.right_chars(F.col("l_orderkey"), 2).alias("tail")
    )


@check(
    "fn_format_bsn",
    """SELECT o_orderkey, right('000000000' || coalesce(CAST(x AS VARCHAR), ''), 9) AS bsn
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL
      WHEN o_orderkey % 5 = 1 THEN 1234567890 + o_orderkey ELSE o_orderkey * 37 END AS x
      FROM orders) AS n""",
)
def fn_format_bsn(t: Tables) -> DataFrame:
    number = F.expr(
        "case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 "
        "then 1234567890 + o_orderkey else o_orderkey * 37 end"
    )
    return t.orders.select("o_orderkey", Z.format_bsn(number).alias("bsn"))


@check("fn_local_date", f"SELECT event_id, {day_sql('ts')} AS local_day FROM events")
def fn_local_date(t: Tables) -> DataFrame:
    return t.events.select("event_id", Z.local_date(F.col("ts")).alias("local_day"))


@check(
    "fn_begin_repair",
    with_fixtures(
        f"""SELECT rsys_prs, rsys_adr, rvlg, dwon_bgn, dwon_end,
        CASE WHEN right(CAST(dwon_bgn AS VARCHAR), 2) = '00' THEN dwon_bgn + 1
          WHEN length(CAST(dwon_bgn AS VARCHAR)) <> 8 THEN coalesce(dwon_end, 20240614)
          ELSE dwon_bgn END AS repaired,
        CAST(CASE WHEN right(CAST(dwon_bgn AS VARCHAR), 2) = '00'
          THEN {date_sql('(dwon_bgn + 1)')}
          WHEN length(CAST(dwon_bgn AS VARCHAR)) <> 8 THEN DATE '2001-02-03'
          ELSE {date_sql('dwon_bgn')} END AS VARCHAR) AS repaired_day FROM gba_tbwnhis""",
        "gba_tbwnhis",
    ),
)
def fn_begin_repair(t: Tables) -> DataFrame:
    rows = frames(t, "gba_tbwnhis")["gba_tbwnhis"]
    yesterday = Z.yesterday_number(F.lit(datetime.date(2024, 6, 15)))
    begin = F.col("dwon_bgn")
    return rows.select(
        "rsys_prs",
        "rsys_adr",
        "rvlg",
        "dwon_bgn",
        "dwon_end",
        Z.begin_number(begin, F.coalesce("dwon_end", yesterday)).alias("repaired"),
        Z.begin_date(begin, F.lit(20010203)).alias("repaired_day"),
    )


_PARTS = """CASE WHEN l_orderkey % 3 <> 0 THEN l_returnflag END AS a,
    CASE WHEN l_orderkey % 4 <> 0 THEN l_linenumber END AS b,
    CASE WHEN l_orderkey % 5 <> 0 THEN l_linestatus END AS c"""


def _parts(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey",
        "l_linenumber",
        "case when l_orderkey % 3 <> 0 then l_returnflag end as a",
        "case when l_orderkey % 4 <> 0 then l_linenumber end as b",
        "case when l_orderkey % 5 <> 0 then l_linestatus end as c",
    )


@check(
    "fn_concat_skip_null",
    f"""SELECT l_orderkey, l_linenumber, concat(a, '-', b, c) AS key
    FROM (SELECT l_orderkey, l_linenumber, {_PARTS} FROM lineitem) AS n""",
)
def fn_concat_skip_null(t: Tables) -> DataFrame:
    key = Z.concat_skip_null(F.col("a"), F.lit("-"), F.col("b"), F.col("c"))
    return _parts(t).select("l_orderkey", "l_linenumber", key.alias("key"))


@check(
    "fn_concat_propagate",
    f"""SELECT l_orderkey, l_linenumber, a || '-' || CAST(b AS VARCHAR) || c AS key
    FROM (SELECT l_orderkey, l_linenumber, {_PARTS} FROM lineitem) AS n""",
)
def fn_concat_propagate(t: Tables) -> DataFrame:
    key = Z.concat_propagate(F.col("a"), F.lit("-"), F.col("b"), F.col("c"))
    return _parts(t).select("l_orderkey", "l_linenumber", key.alias("key"))


@check(
    "fn_address_line",
    with_fixtures(
        f"""SELECT rsys_adr, {location_sql('a')} AS line,
        concat(nstr, ' ', rhs, coalesce(' ' || nhsr_lt, ''), coalesce(' ' || khsr_tv, ''),
          coalesce(' ' || khsr_ad, ''), ' ', kpst_num, kpst_alf, ',', nwpl_nm) AS clean_line
        FROM gba_tgbaadr a""",
        "gba_tgbaadr",
    ),
)
def fn_address_line(t: Tables) -> DataFrame:
    from zilverspoor.plans.civil import location

    return frames(t, "gba_tgbaadr")["gba_tgbaadr"].select(
        "rsys_adr", location().alias("line"), location(clean=True).alias("clean_line")
    )


@check(
    "fn_postcode",
    with_fixtures(
        "SELECT rsys_adr, concat(kpst_num, kpst_alf) AS postcode FROM gba_tgbaadr", "gba_tgbaadr"
    ),
)
def fn_postcode(t: Tables) -> DataFrame:
    postcode = Z.concat_skip_null(F.col("kpst_num"), F.col("kpst_alf"))
    return frames(t, "gba_tgbaadr")["gba_tgbaadr"].select("rsys_adr", postcode.alias("postcode"))


@check(
    "fn_suffixed_key",
    with_fixtures(
        "SELECT rsys_adr, CAST(nid_nad AS VARCHAR) || '-BAG' AS id FROM gba_tgbaadr", "gba_tgbaadr"
    ),
)
def fn_suffixed_key(t: Tables) -> DataFrame:
    return frames(t, "gba_tgbaadr")["gba_tgbaadr"].select(
        "rsys_adr", Z.suffixed_key(F.col("nid_nad"), "-BAG").alias("id")
    )


@check(
    "fn_pair_key",
    """SELECT o_orderkey, concat(greatest(a, b), '-', least(a, b), '-',
      coalesce(strftime(d, '%Y%m%d'), 'x')) AS couple
    FROM (SELECT o_orderkey, o_custkey AS a,
      CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 97 END AS b,
      CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders) AS n""",
)
def fn_pair_key(t: Tables) -> DataFrame:
    couple = Z.pair_key(
        F.col("o_custkey"),
        F.expr("case when o_orderkey % 6 <> 0 then o_orderkey % 97 end"),
        F.expr("case when o_orderkey % 4 <> 0 then cast(o_orderdate as date) end"),
    )
    return t.orders.select("o_orderkey", couple.alias("couple"))


@check(
    "fn_composite_key",
    with_fixtures(
        """SELECT CAST(rsys_prs AS VARCHAR) || '-' || CAST(rsys_adr AS VARCHAR) || '-'
          || CAST(dwon_bgn AS VARCHAR) || '-BRP' AS stay_key,
        concat(rsys_prs, '-', dwon_bgn, '-BRP') AS loose_key FROM gba_tbwnhis""",
        "gba_tbwnhis",
    ),
)
def fn_composite_key(t: Tables) -> DataFrame:
    dash = F.lit("-")
    person, address, begin = F.col("rsys_prs"), F.col("rsys_adr"), F.col("dwon_bgn")
    stay = Z.concat_propagate(person, dash, address, dash, begin)
    return frames(t, "gba_tbwnhis")["gba_tbwnhis"].select(
        Z.suffixed_key(stay, "-BRP").alias("stay_key"),
        Z.concat_skip_null(person, dash, begin, F.lit("-BRP")).alias("loose_key"),
    )


@check(
    "fn_lpad",
    "SELECT l_orderkey, l_linenumber, lpad(CAST(l_orderkey AS VARCHAR), 3, '0') AS padded FROM lineitem",
)
def fn_lpad(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", Z.zero_pad(F.col("l_orderkey"), 3).alias("padded")
    )


@check(
    "fn_substr_length",
    """SELECT doc_id, substr(text, 3, 5) AS part, CAST(length(text) AS BIGINT) AS n_text
    FROM documents""",
)
def fn_substr_length(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        F.substring("text", 3, 5).alias("part"),
        F.length("text").cast("bigint").alias("n_text"),
    )


@check(
    "fn_coalesce_sentinel",
    with_fixtures(
        """SELECT rsys_prs, rsys_adr, rvlg, coalesce(dwon_bgn, 19000101) AS bgn,
        coalesce(CASE WHEN rvlg = 0 THEN NULL ELSE dwon_end END, 99991231) AS end_value
        FROM gba_tbwnhis""",
        "gba_tbwnhis",
    ),
)
def fn_coalesce_sentinel(t: Tables) -> DataFrame:
    end = F.when(F.col("rvlg") != 0, F.col("dwon_end"))
    return frames(t, "gba_tbwnhis")["gba_tbwnhis"].select(
        "rsys_prs",
        "rsys_adr",
        "rvlg",
        F.coalesce("dwon_bgn", F.lit(UNKNOWN_BEGIN)).alias("bgn"),
        F.coalesce(end, F.lit(OPEN_END)).alias("end_value"),
    )


@check(
    "fn_cast",
    """SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS as_text,
    TRY_CAST(p_brand AS INTEGER) AS bad_number, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS number
    FROM part""",
)
def fn_cast(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("as_text"),
        F.col("p_brand").try_cast("int").alias("bad_number"),
        F.expr("substr(p_brand, 7)").try_cast("int").alias("number"),
    )


@check("fn_strip_nul", "SELECT doc_id, text FROM documents")
def fn_strip_nul(t: Tables) -> DataFrame:
    spoiled = F.concat(
        F.lit("\x00"), F.substring("text", 1, 10), F.lit("\x00\x00"), F.expr("substr(text, 11)")
    )
    return t.documents.select("doc_id", Z.strip_nul(spoiled).alias("text"))


@check(
    "json_flatten",
    """SELECT event_id, '{"k":' || json_extract_string(props, '$.k')
      || ',"missing":null}' AS props_text,
    '[{"k":' || json_extract_string(props, '$.k') || '},{"k":null}]' AS list_text FROM events""",
)
def json_flatten(t: Tables) -> DataFrame:
    """Nested values as compact JSON text with their NULL fields."""
    parsed = t.events.select(
        "event_id", F.from_json("props", "struct<k: bigint, missing: string>").alias("props_text")
    )
    k = F.col("props_text.k")
    nested_rows = parsed.withColumn(
        "list_text",
        F.array(F.struct(k.alias("k")), F.struct(F.lit(None).cast("bigint").alias("k"))),
    )
    return nested.scalars(nested_rows)


@check(
    "scalar_normalise",
    """SELECT event_id, CAST(CAST(value AS DECIMAL(12,3)) AS VARCHAR) AS amount,
    to_base64(encode(event_type)) AS blob, strftime(ts, '%H:%M:%S') AS at_time,
    CAST(event_id % 1000 AS DOUBLE) + 0.5 AS seconds FROM events""",
)
def scalar_normalise(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_id",
        F.col("value").cast("decimal(12,3)").alias("amount"),
        F.col("event_type").cast("binary").alias("blob"),
        nested.time_text(F.col("ts")).alias("at_time"),
        F.make_dt_interval(secs=(F.col("event_id") % 1000 + 0.5).cast("decimal(18,6)")).alias(
            "seconds"
        ),
    )
    return nested.scalars(rows)
