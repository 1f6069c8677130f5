"""Join operators as the mappings use them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zilverspoor.checks.core import Tables, check
from zilverspoor.checks.fixtures import frames, with_fixtures
from zilverspoor.operators.history import current_rows
from zilverspoor.operators.lookup import coalesced_lookup, decode, household_relations
from zilverspoor.operators.windows import by, rows_at_min, top_row
from zilverspoor.plans.civil import marriage_conversions


@check(
    "join_inner_composite",
    with_fixtures(
        """SELECT i.besluitnr, i.volgnr_ind, i.clientnr, d.uniek FROM wvind_b i
        JOIN wvdos d ON d.besluitnr = i.besluitnr AND d.volgnr_ind = i.volgnr_ind""",
        "wvind_b",
        "wvdos",
    ),
)
def join_inner_composite(t: Tables) -> DataFrame:
    src = frames(t, "wvind_b", "wvdos")
    rows = src["wvind_b"].join(src["wvdos"], ["besluitnr", "volgnr_ind"])
    return rows.select("besluitnr", "volgnr_ind", "clientnr", "uniek")


@check(
    "join_cast_key",
    with_fixtures(
        """SELECT d.uniek, h.verslagnr, CAST(h.bedrag AS VARCHAR) AS bedrag FROM wvdos d
        JOIN szukhis h ON h.uniekwvdos = CAST(d.uniek AS VARCHAR)""",
        "wvdos",
        "szukhis",
    ),
)
def join_cast_key(t: Tables) -> DataFrame:
    src = frames(t, "wvdos", "szukhis")
    rows = src["wvdos"].join(
        src["szukhis"], F.col("uniekwvdos") == F.col("uniek").cast("string")
    )
    return rows.select("uniek", "verslagnr", "bedrag")


@check(
    "join_left",
    with_fixtures(
        """SELECT i.besluitnr, i.volgnr_ind, r.omschryving FROM wvind_b i
        LEFT JOIN szregel r ON r.kode_regeling = i.kode_regeling""",
        "wvind_b",
        "szregel",
    ),
)
def join_left(t: Tables) -> DataFrame:
    src = frames(t, "wvind_b", "szregel")
    rows = src["wvind_b"].join(src["szregel"], "kode_regeling", "left")
    return rows.select("besluitnr", "volgnr_ind", "omschryving")


@check(
    "join_left_composite",
    with_fixtures(
        """SELECT i.besluitnr, i.volgnr_ind, d.kode_reden_einde_voorz FROM wvind_b i
        LEFT JOIN wvdos d ON d.besluitnr = i.besluitnr AND d.volgnr_ind = i.volgnr_ind + 1""",
        "wvind_b",
        "wvdos",
    ),
)
def join_left_composite(t: Tables) -> DataFrame:
    src = frames(t, "wvind_b", "wvdos")
    following = src["wvdos"].withColumn("volgnr_ind", F.col("volgnr_ind") - 1)
    rows = src["wvind_b"].join(following, ["besluitnr", "volgnr_ind"], "left")
    return rows.select("besluitnr", "volgnr_ind", "kode_reden_einde_voorz")


@check(
    "join_left_filtered_right",
    with_fixtures(
        """SELECT i.rsys_prs, p.rsys_nam, p.kgsl FROM gba_tinsgeg i
        LEFT JOIN gba_tprsgeg p ON p.rsys_prs = i.rsys_prs AND p.ireg = 'A'""",
        "gba_tinsgeg",
        "gba_tprsgeg",
    ),
)
def join_left_filtered_right(t: Tables) -> DataFrame:
    src = frames(t, "gba_tinsgeg", "gba_tprsgeg")
    active = current_rows(src["gba_tprsgeg"], {"ireg": "A"})
    return src["gba_tinsgeg"].join(active, "rsys_prs", "left").select(
        "rsys_prs", "rsys_nam", "kgsl"
    )


@check(
    "join_or_residual",
    with_fixtures(
        """SELECT i.besluitnr, i.volgnr_ind, c.omschrijving FROM wvind_b i
        LEFT JOIN szregel r ON r.kode_regeling = i.kode_regeling
        LEFT JOIN wvdos d ON d.besluitnr = i.besluitnr AND d.volgnr_ind = i.volgnr_ind
        LEFT JOIN abc_refcod c ON c.code = d.kode_reden_einde_voorz AND (
          (r.omschryving = 'JEUGDWET' AND c.domein = 'JZG_REDEN_EINDE_PRODUCT')
          OR (r.omschryving <> 'JEUGDWET' AND c.domein = 'WVRTEIND'))""",
        "wvind_b",
        "szregel",
        "wvdos",
        "abc_refcod",
    ),
)
def join_or_residual(t: Tables) -> DataFrame:
    src = frames(t, "wvind_b", "szregel", "wvdos", "abc_refcod")
    law, domain = F.col("omschryving"), F.col("domein")
    matches = (F.col("kode_reden_einde_voorz") == F.col("code")) & (
        ((law == "JEUGDWET") & (domain == "JZG_REDEN_EINDE_PRODUCT"))
        | ((law != "JEUGDWET") & (domain == "WVRTEIND"))
    )
    rows = (
        src["wvind_b"]
        .join(src["szregel"], "kode_regeling", "left")
        .join(src["wvdos"], ["besluitnr", "volgnr_ind"], "left")
        .join(src["abc_refcod"], matches, "left")
    )
    return rows.select("besluitnr", "volgnr_ind", "omschrijving")


@check(
    "join_range_residual",
    with_fixtures(
        """WITH first_h AS (SELECT rsys_prs, rvlg_hw, min(dgld) AS min_dgld FROM gba_thuwhis
          WHERE substr(kakt, 3, 1) = 'H' GROUP BY rsys_prs, rvlg_hw)
        SELECT h.rsys_prs, h.rvlg_hw, h.dgld, f.min_dgld FROM gba_thuwhis h
        LEFT JOIN first_h f ON f.rsys_prs = h.rsys_prs AND f.rvlg_hw = h.rvlg_hw
          AND f.min_dgld <= h.dgld""",
        "gba_thuwhis",
    ),
)
def join_range_residual(t: Tables) -> DataFrame:
    records = frames(t, "gba_thuwhis")["gba_thuwhis"]
    first = marriage_conversions(records).toDF("f_prs", "f_hw", "min_dgld")
    condition = (
        (F.col("f_prs") == F.col("rsys_prs"))
        & (F.col("f_hw") == F.col("rvlg_hw"))
        & (F.col("min_dgld") <= F.col("dgld"))
    )
    return records.join(first, condition, "left").select("rsys_prs", "rvlg_hw", "dgld", "min_dgld")


@check(
    "join_left_side_predicate",
    with_fixtures(
        """SELECT h.rsys_prs, h.rsys_adr, h.rvlg, s.khfd_bew FROM gba_tbwnhis h
        LEFT JOIN gba_tselbst s ON s.rsys_prs = h.rsys_prs AND h.kwon_end IS NULL""",
        "gba_tbwnhis",
        "gba_tselbst",
    ),
)
def join_left_side_predicate(t: Tables) -> DataFrame:
    src = frames(t, "gba_tbwnhis", "gba_tselbst")
    occupants = src["gba_tselbst"].withColumnRenamed("rsys_prs", "occupant")
    condition = (F.col("rsys_prs") == F.col("occupant")) & F.col("kwon_end").isNull()
    return src["gba_tbwnhis"].join(occupants, condition, "left").select(
        "rsys_prs", "rsys_adr", "rvlg", "khfd_bew"
    )


@check(
    "join_coalesced_key",
    with_fixtures(
        """SELECT i.rsys_prs, n.radm FROM gba_tinsgeg i
        LEFT JOIN gba_tprsgeg p ON p.rsys_prs = i.rsys_prs AND p.ireg = 'A'
        LEFT JOIN gba_tarcgeg a ON a.rsys_prs = i.rsys_prs AND a.ireg = 'A'
        LEFT JOIN gba_tnamreg n ON n.rsys_nam = coalesce(p.rsys_nam, a.rsys_nam)""",
        "gba_tinsgeg",
        "gba_tprsgeg",
        "gba_tarcgeg",
        "gba_tnamreg",
    ),
)
def join_coalesced_key(t: Tables) -> DataFrame:
    src = frames(t, "gba_tinsgeg", "gba_tprsgeg", "gba_tarcgeg", "gba_tnamreg")
    keyed = coalesced_lookup(
        src["gba_tinsgeg"],
        "rsys_prs",
        current_rows(src["gba_tprsgeg"], {"ireg": "A"}),
        current_rows(src["gba_tarcgeg"], {"ireg": "A"}),
        "rsys_nam",
        "rsys_nam",
    )
    names = src["gba_tnamreg"].select("rsys_nam", "radm")
    return keyed.join(names, "rsys_nam", "left").select("rsys_prs", "radm")


@check(
    "domain_decode",
    with_fixtures(
        """SELECT h.rsys_prs, h.rvlg_hw, h.dgld, d1.oms AS reden, d2.oms AS soort
        FROM gba_thuwhis h
        LEFT JOIN gba_tdomein d1 ON d1.kode = h.khwo AND d1.kveld = 'KHWO'
        LEFT JOIN gba_tdomein d2 ON d2.kode = h.ksrt_vrb AND d2.kveld = 'KSRT_VRB'""",
        "gba_thuwhis",
        "gba_tdomein",
    ),
)
def domain_decode(t: Tables) -> DataFrame:
    src = frames(t, "gba_thuwhis", "gba_tdomein")
    rows = decode(src["gba_thuwhis"], "khwo", src["gba_tdomein"], "KHWO", "reden")
    rows = decode(rows, "ksrt_vrb", src["gba_tdomein"], "KSRT_VRB", "soort")
    return rows.select("rsys_prs", "rvlg_hw", "dgld", "reden", "soort")


@check(
    "join_latest_row",
    """SELECT c.c_custkey, c.c_name, o.o_orderkey FROM customer c JOIN (
      SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey) AS volgnr FROM orders) AS o
    ON o.o_custkey = c.c_custkey AND o.volgnr = 1""",
)
def join_latest_row(t: Tables) -> DataFrame:
    latest = top_row(t.orders, ["o_custkey"], [by("o_orderdate", True), by("o_orderkey")])
    return t.customer.join(latest, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "c_name", "o_orderkey"
    )


@check(
    "join_min_row",
    with_fixtures(
        """SELECT i.kbst, h.* EXCLUDE (minrvlg) FROM gba_tinsgeg i JOIN (
          SELECT *, min(rvlg) OVER (PARTITION BY rsys_prs, rsys_adr, dwon_bgn) AS minrvlg
          FROM gba_tbwnhis) AS h ON h.rsys_prs = i.rsys_prs AND h.minrvlg = h.rvlg""",
        "gba_tinsgeg",
        "gba_tbwnhis",
    ),
)
def join_min_row(t: Tables) -> DataFrame:
    src = frames(t, "gba_tinsgeg", "gba_tbwnhis")
    first = rows_at_min(src["gba_tbwnhis"], ["rsys_prs", "rsys_adr", "dwon_bgn"], "rvlg")
    return src["gba_tinsgeg"].select("rsys_prs", "kbst").join(first, "rsys_prs")


_RELATIONS_SQL = """(VALUES (1, 'Hoofd gezin zonder kind(eren)', 'M'),
    (2, 'Hoofd gezin met kind(eren)', 'M'), (3, 'Ouder met kind(eren)', 'M of V'),
    (4, 'Echtgenote binnen gezin', 'V'), (5, 'Kind', 'M of V'),
    (6, 'Alleenstaand/Samenwonend', 'M of V'), (7, 'Hoofd partnerrelatie', 'M of V'),
    (8, 'Hoofd huwelijk gelijk geslacht', 'M of V ')) AS g(nummer, omschrijving, geslacht)"""


@check(
    "join_inline",
    with_fixtures(
        f"""SELECT v.rsys_prs, g.omschrijving FROM gba_tvbpakt v
        LEFT JOIN {_RELATIONS_SQL} ON g.nummer = v.kigs_gzr""",
        "gba_tvbpakt",
    ),
)
def join_inline(t: Tables) -> DataFrame:
    current = frames(t, "gba_tvbpakt")["gba_tvbpakt"]
    relations = household_relations(t.spark)
    return current.join(relations, F.col("nummer") == F.col("kigs_gzr"), "left").select(
        "rsys_prs", "omschrijving"
    )


@check(
    "inline_relation",
    with_fixtures(
        f"""SELECT g.nummer, g.omschrijving, g.geslacht, count(v.rsys_prs) AS n_persons
        FROM {_RELATIONS_SQL} LEFT JOIN gba_tvbpakt v ON g.nummer = v.kigs_gzr
        GROUP BY g.nummer, g.omschrijving, g.geslacht""",
        "gba_tvbpakt",
    ),
)
def inline_relation(t: Tables) -> DataFrame:
    used = (
        frames(t, "gba_tvbpakt")["gba_tvbpakt"]
        .groupBy("kigs_gzr")
        .agg(F.count("rsys_prs").alias("n"))
    )
    return household_relations(t.spark).join(
        used, F.col("nummer") == F.col("kigs_gzr"), "left"
    ).select(
        "nummer", "omschrijving", "geslacht", F.coalesce("n", F.lit(0)).alias("n_persons")
    )


@check(
    "join_history_current",
    with_fixtures(
        """SELECT h.rsys_prs, h.rvlg_hw, h.dopn FROM gba_thuwhis h
        JOIN gba_thuwakt k ON k.rsys_prs = h.rsys_prs AND k.rvlg_hw = h.rvlg_hw
        WHERE h.ionj IS NULL""",
        "gba_thuwhis",
        "gba_thuwakt",
    ),
)
def join_history_current(t: Tables) -> DataFrame:
    src = frames(t, "gba_thuwhis", "gba_thuwakt")
    valid = src["gba_thuwhis"].where(F.col("ionj").isNull())
    current = src["gba_thuwakt"].select("rsys_prs", "rvlg_hw")
    return valid.join(current, ["rsys_prs", "rvlg_hw"]).select("rsys_prs", "rvlg_hw", "dopn")
