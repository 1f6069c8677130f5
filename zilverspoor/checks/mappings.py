"""The mapping pipelines on fixture tables."""

from __future__ import annotations

import datetime
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zilverspoor.checks.core import Tables, check, text
from zilverspoor.checks.fixtures import frames, with_fixtures
from zilverspoor.operators.quality import row_counts
from zilverspoor.plans import MAPPINGS, Bronze, build, plan_all
from zilverspoor.plans.civil import marriage_records, marriage_states
from zilverspoor.sinks.load import create_silver, load_silver

AS_OF = datetime.date(2024, 6, 15)


def bronze(t: Tables, *names: str) -> Bronze:
    return Bronze(frames(t, *names), as_of=F.lit(AS_OF))


def run(t: Tables, target: str, row_limit: int = 0) -> DataFrame:
    return build(target, bronze(t, *MAPPINGS[target].requires), row_limit)


def _sql(target: str, sql: str) -> str:
    return with_fixtures(sql, *MAPPINGS[target].requires)


_BESCHIKKING = """SELECT besluitnr AS "BESCHIKKING_ID", clientnr AS "CLIENT_ID",
    besluitnr AS "HEEFT_VOORZIENINGEN_BESCHIKTE_VOORZIENING_ID", CAST(NULL AS VARCHAR) AS "CODE",
    CAST(NULL AS VARCHAR) AS "COMMENTAAR", CAST(NULL AS VARCHAR) AS "DATUMAFGIFTE",
    CAST(NULL AS INTEGER) AS "GRONDSLAGEN", CAST(NULL AS VARCHAR) AS "WET" FROM wvbesl"""


@check("map_beschikking", _sql("BESCHIKKING", _BESCHIKKING))
def map_beschikking(t: Tables) -> DataFrame:
    return run(t, "BESCHIKKING")


def day_sql(column: str) -> str:
    return (
        f"CAST(CAST(timezone('Europe/Amsterdam', timezone('UTC', {column})) AS DATE) AS VARCHAR)"
    )


_PROVISIONS = f"""SELECT {day_sql('i.dd_eind')} AS datumeinde, {day_sql('i.dd_begin')} AS datumstart,
    i.volume AS omvang, i.status_indicatie AS status,
    concat(i.besluitnr, i.volgnr_ind) AS beschikte_voorziening_id,
    CAST(NULL AS VARCHAR) AS redeneinde, CAST(NULL AS VARCHAR) AS code,
    CAST(NULL AS VARCHAR) AS datumeindeoorspronkelijk, CAST(NULL AS VARCHAR) AS eenheid_enum_id,
    CAST(NULL AS VARCHAR) AS frequentie_enum_id, CAST(NULL AS VARCHAR) AS heeft_leveringsvorm_293_id,
    CAST(NULL AS VARCHAR) AS is_voorziening_voorziening_id,
    CAST(NULL AS VARCHAR) AS leveringsvorm_287_enum_id,
    CAST(NULL AS VARCHAR) AS toegewezen_product_toewijzing_id, CAST(NULL AS VARCHAR) AS wet_enum_id
    FROM wvind_b i LEFT JOIN szregel r ON i.kode_regeling = r.kode_regeling
    LEFT JOIN wvbesl b ON i.besluitnr = b.besluitnr
    LEFT JOIN wvdos d ON i.besluitnr = d.besluitnr AND i.volgnr_ind = d.volgnr_ind
    LEFT JOIN abc_refcod c ON d.kode_reden_einde_voorz = c.code AND (
      (r.omschryving = 'JEUGDWET' AND c.domein = 'JZG_REDEN_EINDE_PRODUCT')
      OR (r.omschryving <> 'JEUGDWET' AND c.domein = 'WVRTEIND'))"""


@check("map_beschikte_voorziening", _sql("BESCHIKTE_VOORZIENING", _PROVISIONS))
def map_beschikte_voorziening(t: Tables) -> DataFrame:
    return run(t, "BESCHIKTE_VOORZIENING")


@check(
    "map_client",
    _sql(
        "CLIENT",
        """SELECT clientnr AS "RECHTSPERSOON_ID", ind_gezag AS "GEZAGSDRAGERGEKEND_ENUM_ID",
        CAST(NULL AS VARCHAR) AS "CODE", CAST(NULL AS VARCHAR) AS "JURIDISCHESTATUS",
        CAST(NULL AS VARCHAR) AS "WETTELIJKEVERTEGENWOORDIGING" FROM szclient""",
    ),
)
def map_client(t: Tables) -> DataFrame:
    return run(t, "CLIENT")


_CLAIMS = """SELECT d.uniek AS "DECLARATIEREGEL_ID", CAST(h.bedrag AS VARCHAR) AS "BEDRAG",
    i.clientnr AS "BETREFT_CLIENT_ID", CAST(NULL AS VARCHAR) AS "CODE",
    CAST(NULL AS VARCHAR) AS "DATUMEINDE", CAST(NULL AS VARCHAR) AS "DATUMSTART",
    i.besluitnr AS "IS_VOOR_BESCHIKKING_ID", h.verslagnr AS "VALT_BINNEN_DECLARATIE_ID"
    FROM wvind_b i JOIN wvdos d ON i.besluitnr = d.besluitnr AND i.volgnr_ind = d.volgnr_ind
    JOIN szukhis h ON CAST(h.uniekwvdos AS VARCHAR) = CAST(d.uniek AS VARCHAR)"""


@check("map_declaratieregel", _sql("DECLARATIEREGEL", _CLAIMS))
def map_declaratieregel(t: Tables) -> DataFrame:
    return run(t, "DECLARATIEREGEL")


@check(
    "map_medewerker",
    _sql(
        "MEDEWERKER",
        """SELECT kode_werker AS "MEDEWERKER_ID", naam AS "ACHTERNAAM", kode_instan AS "FUNCTIE",
        e_mail AS "EMAILADRES", ind_geslacht AS "GESLACHTSAANDUIDING",
        toelichting AS "MEDEWERKERTOELICHTING", telefoon AS "TELEFOONNUMMER",
        CAST(NULL AS VARCHAR) AS "DATUMINDIENST", CAST(NULL AS VARCHAR) AS "DATUMUITDIENST",
        CAST(NULL AS VARCHAR) AS "EXTERN", CAST(NULL AS VARCHAR) AS "MEDEWERKERIDENTIFICATIE",
        CAST(NULL AS VARCHAR) AS "ROEPNAAM", CAST(NULL AS VARCHAR) AS "VOORLETTERS",
        CAST(NULL AS VARCHAR) AS "VOORVOEGSELACHTERNAAM" FROM szwerker""",
    ),
)
def map_medewerker(t: Tables) -> DataFrame:
    return run(t, "MEDEWERKER")


_LAWS_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS "WET_ENUM_ID", p_name AS "VALUE" FROM part"""


@check("map_wet_enum", _LAWS_SQL)
def map_wet_enum(t: Tables) -> DataFrame:
    laws = t.part.selectExpr("cast(p_partkey as string) as kode_regeling", "p_name as omschryving")
    return build("WET_ENUM", Bronze({"szregel": laws}))


@check(
    "map_enum_gezinsrelatie",
    _sql(
        "ENUM_GEZINSRELATIE",
        """SELECT kode AS "ID", oms AS "Waarde" FROM ods_cen_gba_tdomein
        WHERE kveld = 'KIGS_GZR' AND dwh_actueel = 1""",
    ),
)
def map_enum_gezinsrelatie(t: Tables) -> DataFrame:
    return run(t, "ENUM_GEZINSRELATIE")


# -- civil registry: the SQL follows the definitions with plain windows -------------

_CLOSED = "FROM gba_tbwnhis WHERE dwon_end >= 20000101 AND kwon_end <> 'F'"
_REGISTERED = """LEFT JOIN gba_tprsgeg p ON p.rsys_prs = {0}.rsys_prs AND p.ireg = 'A'
    LEFT JOIN gba_tarcgeg a ON a.rsys_prs = {0}.rsys_prs AND a.ireg = 'A'
    LEFT JOIN gba_tnamreg n ON n.rsys_nam = coalesce(p.rsys_nam, a.rsys_nam)"""


def date_sql(value: str) -> str:
    number = f"CAST({value} AS VARCHAR)"
    return (
        f"CASE WHEN length({number}) = 8 "
        f"THEN CAST(try_strptime({number}, '%Y%m%d') AS DATE) END"
    )


PERSONS_SQL = f"""WITH history AS (
      SELECT rsys_prs, dwon_end {_CLOSED}
      UNION ALL SELECT rsys_prs, NULL FROM gba_tvbpakt),
    ranked AS (
      SELECT row_number() OVER w AS volgnr, max(h.rsys_prs) OVER w AS rsys_prs_max
      FROM history h {_REGISTERED.format('h')}
      WINDOW w AS (PARTITION BY n.radm ORDER BY coalesce(h.dwon_end, 99991231) DESC))
    SELECT n.radm AS "NatuurlijkPersoonId",
      right('000000000' || coalesce(CAST(n.rsofi AS VARCHAR), ''), 9) AS "BSN",
      n.dgeb_gba AS datumgeboren, o.dovl_gba AS datumoverlijden,
      coalesce(p.kgsl, a.kgsl) AS "Enum_GeslachtID", n.nvoor AS "Voornamen",
      n.nvlr_gba AS "Voorletters", n.nvgsl AS "Voorvoegselgeslachtsnaam", n.ngsl AS "Geslachtsnaam",
      CAST(n.radm AS VARCHAR) || '-BRP' AS "DWH_IDENTIFICATIE"
    FROM gba_tinsgeg i LEFT JOIN gba_tovlakt o ON o.rsys_prs = i.rsys_prs
    {_REGISTERED.format('i')}
    JOIN ranked r ON r.rsys_prs_max = i.rsys_prs AND r.volgnr = 1
    WHERE coalesce(i.kops, 'x') <> 'F'"""


@check("map_natuurlijk_persoon", _sql("NATUURLIJKPERSOON", PERSONS_SQL))
def map_natuurlijk_persoon(t: Tables) -> DataFrame:
    return run(t, "NATUURLIJKPERSOON")


def location_sql(table: str) -> str:
    t = table
    return f"""concat({t}.nstr, ' ', {t}.rhs, ' ', {t}.nhsr_lt, ' ', {t}.khsr_tv, ' ', {t}.khsr_ad,
      ' ', {t}.kpst_num, {t}.kpst_alf, ',', {t}.nwpl_nm)"""


# rows of one begin day follow each other by all that tells them apart, NULLs first
_ADDRESS_TIES = ", ".join(
    f"ad.{c} NULLS FIRST"
    for c in "nstr rhs nhsr_lt khsr_tv khsr_ad kpst_num kpst_alf nwpl_nm".split()
)

REGISTRATIONS_SQL = f"""WITH history AS (
      SELECT rsys_prs, rsys_adr, dwon_bgn, dwon_end, kwon_end, NULL AS kigs_gzr {_CLOSED}
      UNION ALL SELECT rsys_prs, rsys_adr, dadrh, NULL, NULL, kigs_gzr FROM gba_tvbpakt),
    net AS (
      SELECT h.rsys_adr, h.dwon_bgn AS raw_bgn, h.dwon_end, h.kwon_end, h.kigs_gzr,
        CAST(CASE WHEN right(CAST(h.dwon_bgn AS VARCHAR), 2) = '00' THEN h.dwon_bgn + 1
             WHEN length(CAST(h.dwon_bgn AS VARCHAR)) <> 8 THEN coalesce(h.dwon_end, 20240614)
             ELSE h.dwon_bgn END AS INTEGER) AS dwon_bgn,
        row_number() OVER (PARTITION BY n.radm, coalesce(h.dwon_bgn, 19000101)
          ORDER BY coalesce(h.dwon_end, 99991231) DESC, h.rsys_prs DESC,
          h.rsys_adr NULLS LAST, h.dwon_bgn NULLS LAST, h.kwon_end NULLS LAST,
          h.kigs_gzr NULLS LAST) AS volgnr,
        max(h.rsys_prs) OVER (PARTITION BY n.radm
          ORDER BY coalesce(h.dwon_end, 99991231) DESC) AS rsys_prs_max
      FROM history h {_REGISTERED.format('h')}),
    relations AS (SELECT * FROM (VALUES
      (1, 'Hoofd gezin zonder kind(eren)'), (2, 'Hoofd gezin met kind(eren)'),
      (3, 'Ouder met kind(eren)'), (4, 'Echtgenote binnen gezin'), (5, 'Kind'),
      (6, 'Alleenstaand/Samenwonend'), (7, 'Hoofd partnerrelatie'),
      (8, 'Hoofd huwelijk gelijk geslacht')) AS v(nummer, omschrijving)),
    joined AS (
      SELECT n.radm, i.kops, i.dops, o.dovl_gba, r.*, g.omschrijving, s.khfd_bew, ad.nid_nad,
        CASE WHEN ad.rsys_adr IS NULL THEN concat(' ', ' ', ' ', ' ', ' ', ',')
             ELSE {location_sql('ad')} END AS locatie,
        lead(r.dwon_bgn) OVER (PARTITION BY n.radm ORDER BY r.dwon_bgn NULLS LAST,
          r.dwon_end NULLS FIRST, r.rsys_adr NULLS FIRST, r.kwon_end NULLS FIRST,
          r.kigs_gzr NULLS FIRST, r.raw_bgn NULLS FIRST, s.khfd_bew NULLS FIRST,
          ad.nid_nad NULLS FIRST, {_ADDRESS_TIES}) AS next_bgn
      FROM gba_tinsgeg i LEFT JOIN gba_tovlakt o ON o.rsys_prs = i.rsys_prs
      {_REGISTERED.format('i')}
      JOIN net r ON r.rsys_prs_max = i.rsys_prs AND r.volgnr = 1
      LEFT JOIN gba_tgbaadr ad ON ad.rsys_adr = r.rsys_adr
      LEFT JOIN relations g ON g.nummer = r.kigs_gzr
      LEFT JOIN gba_tselbst s ON s.rsys_prs = i.rsys_prs AND r.dwon_end IS NULL
      WHERE coalesce(i.kops, 'x') <> 'F')
    SELECT radm AS "IngeschrevenPersoonId", radm AS "A_nummer",
      CAST({date_sql('dwon_bgn')} AS VARCHAR) AS "BegindatumVerblijf", dwon_bgn,
      CAST(CASE WHEN next_bgn = dwon_end THEN {date_sql('dwon_end')} - 1
           ELSE {date_sql('dwon_end')} END AS VARCHAR) AS "EinddatumVerblijf",
      dops AS dd_opschort_bijhouding,
      CASE WHEN kops = 'E' THEN dops END AS datumvertrekuitnederland,
      CAST(nid_nad AS VARCHAR) || '-BAG' AS "NummeraanduidingID",
      CASE kwon_end WHEN 'W' THEN 'Adreswijziging' WHEN 'V' THEN 'Vertrokken'
        WHEN 'O' THEN 'Overleden' WHEN 'F' THEN 'Foutieve persoonslijst'
        WHEN 'U' THEN 'Vernummering' WHEN 'A' THEN 'Vernaming'
        WHEN 'M' THEN 'Ministerieel besluit' WHEN 'X' THEN 'Geactualiseerd'
        END AS "RedenEindeBewoning",
      kigs_gzr AS gezinstrelatieid, omschrijving AS gezinsrelatie,
      locatie AS locatiebeschrijving,
      CASE WHEN kops = 'E' THEN 'Geemigreerd op ' || dops
        WHEN kops = 'M' THEN 'Ministerieel besluit op ' || dops
        WHEN kops = 'F' THEN 'Foute PL op ' || dops
        WHEN kops = '.' THEN 'Opschorting onbekend op ' || dops
        WHEN dovl_gba IS NOT NULL THEN 'Overleden op ' || CAST(dovl_gba AS VARCHAR)
        ELSE kops END AS "Reden_Opschort_bijhouding",
      CASE khfd_bew WHEN 1 THEN 'Ja' WHEN 0 THEN 'Nee' END AS "Hoofdbewoner",
      CAST(radm AS VARCHAR) || '-BRP' AS "DWH_IDENTIFICATIE"
    FROM joined"""


@check("map_ingeschreven_persoon", _sql("INGESCHREVENPERSOON", REGISTRATIONS_SQL))
def map_ingeschreven_persoon(t: Tables) -> DataFrame:
    return run(t, "INGESCHREVENPERSOON")


RESIDENCES_SQL = f"""WITH history AS (
      SELECT rsys_prs, rsys_adr, dwon_bgn, dwon_end, kwon_end, rvlg,
        'Woonadres' AS adresherkomst {_CLOSED}
      UNION ALL
      SELECT v.rsys_prs, v.rsys_adr, v.dadrh, NULL, NULL, -1, d.oms FROM gba_tvbpakt v
      LEFT JOIN gba_tdomein d ON d.kode = v.kadrf AND d.kveld = 'KADRF'),
    net AS (
      SELECT h.*, d.oms AS reden,
        min(rvlg) OVER (PARTITION BY rsys_prs, rsys_adr, dwon_bgn) AS minrvlg
      FROM history h LEFT JOIN gba_tdomein d ON d.kode = h.kwon_end AND d.kveld = 'KWON_END'),
    joined AS (
      SELECT r.*, i.dtoe_gba, n.radm, ad.* EXCLUDE (rsys_adr),
        CASE WHEN ad.rsys_adr IS NULL THEN concat(' ', ' ', ' ', ' ', ' ', ',')
             ELSE {location_sql('ad')} END AS locatie,
        lead(r.dwon_bgn) OVER (PARTITION BY n.radm ORDER BY r.dwon_bgn NULLS LAST,
          r.dwon_end NULLS FIRST, r.rsys_prs NULLS FIRST, r.rsys_adr NULLS FIRST,
          r.rvlg NULLS FIRST, r.adresherkomst NULLS FIRST, r.kwon_end NULLS FIRST,
          i.dtoe_gba NULLS FIRST, r.reden NULLS FIRST, ad.nid_vbo NULLS FIRST, {_ADDRESS_TIES}) AS next_bgn
      FROM gba_tinsgeg i {_REGISTERED.format('i')}
      JOIN net r ON r.rsys_prs = i.rsys_prs AND r.minrvlg = r.rvlg
      LEFT JOIN gba_tgbaadr ad ON ad.rsys_adr = r.rsys_adr
      WHERE coalesce(i.kops, 'x') <> 'F')
    SELECT adresherkomst AS "AdresHerkomst",
      CAST(CASE WHEN right(CAST(dwon_bgn AS VARCHAR), 2) = '00' THEN {date_sql('(dwon_bgn + 1)')}
        WHEN length(CAST(dwon_bgn AS VARCHAR)) <> 8 THEN {date_sql('dtoe_gba')}
        ELSE {date_sql('dwon_bgn')} END AS VARCHAR) AS "datumBegin",
      CAST(CASE WHEN next_bgn = dwon_end THEN {date_sql('dwon_end')} - 1
           ELSE {date_sql('dwon_end')} END AS VARCHAR) AS "datumEinde",
      CAST(nid_vbo AS VARCHAR) || '-BAG' AS "BAGID_adresseerbaarobject",
      reden AS "RedenEindeBewoning", locatie AS "beschrijvingLocatie", rhs AS huisnummer,
      nhsr_lt AS huisletter, khsr_tv AS huisnummertoevoeging, khsr_ad AS huisnummeraanduiding,
      concat(kpst_num, kpst_alf) AS postcode, nstr AS straatnaam, nwpl_nm AS plaats,
      CAST(radm AS VARCHAR) || '-BRP' AS "IngeschrevenPersoonId",
      CAST(rsys_prs AS VARCHAR) || '-' || CAST(rsys_adr AS VARCHAR) || '-'
        || CAST(dwon_bgn AS VARCHAR) AS "VerblijfsAdresIngeschrevenPersoonId",
      CAST(rsys_prs AS VARCHAR) || '-' || CAST(rsys_adr AS VARCHAR) || '-'
        || CAST(dwon_bgn AS VARCHAR) || '-BRP' AS "DWH_IDENTIFICATIE",
      'CEN_BRP' AS "DWH_BRON", 1 AS "DWH_ACTUEEL"
    FROM joined"""


@check("map_verblijfsadres", _sql("VERBLIJFSADRESINGESCHREVENPERSOON", RESIDENCES_SQL))
def map_verblijfsadres(t: Tables) -> DataFrame:
    return run(t, "VERBLIJFSADRESINGESCHREVENPERSOON")


def partial_sql(value: str) -> str:
    number = f"CAST({value} AS VARCHAR)"
    adjusted = f"""(CASE WHEN {value} <= 0 THEN NULL
        WHEN substr({number}, 5, 2) = '00' THEN {value} + 101
        WHEN substr({number}, 7, 2) = '00' THEN {value} + 1 ELSE {value} END)"""
    return date_sql(adjusted)


_MARRIAGE_COLUMNS = "rsys_prs, rvlg_hw, rsys_nam, dhw, dhwo, kakt, khwo, ksrt_vrb, dgld, dopn"
_BASIS = f"""basis AS (
      SELECT {', '.join('h.' + c.strip() for c in _MARRIAGE_COLUMNS.split(','))}
      FROM gba_thuwhis h JOIN gba_thuwakt k ON k.rsys_prs = h.rsys_prs AND k.rvlg_hw = h.rvlg_hw
      WHERE h.ionj IS NULL
      UNION ALL
      SELECT k.rsys_prs, k.rvlg_hw, k.rsys_nam, k.dhw,
        CASE WHEN k.dhwo IS NULL AND o.dovl_gba IS NOT NULL AND o.dovl_gba > coalesce(k.dhw, 0)
             THEN o.dovl_gba ELSE k.dhwo END, k.kakt,
        CASE WHEN k.dhwo IS NULL AND o.dovl_gba IS NOT NULL AND o.dovl_gba > coalesce(k.dhw, 0)
             THEN 'OVL' ELSE k.khwo END, k.ksrt_vrb, k.dgld, k.dopn
      FROM gba_thuwakt k LEFT JOIN gba_tovlakt o ON o.rsys_prs = k.rsys_prs)"""
_LATEST = """(PARTITION BY rsys_prs, rvlg_volg ORDER BY dopn DESC NULLS FIRST,
      rsys_nam NULLS LAST, dhw NULLS LAST, dhwo NULLS LAST, kakt NULLS LAST, khwo NULLS LAST,
      ksrt_vrb NULLS LAST, omzetting NULLS LAST, dgld NULLS LAST)"""
_STATES = f"""omz AS (
      SELECT rsys_prs, rvlg_hw, min(dgld) AS min_dgld FROM basis
      WHERE substr(kakt, 3, 1) = 'H' GROUP BY rsys_prs, rvlg_hw),
    flagged AS (
      SELECT b.rsys_prs, b.rvlg_hw,
        CASE WHEN m.rvlg_hw IS NULL THEN lpad(CAST(b.rvlg_hw + 1 AS VARCHAR), 3, '0')
             ELSE lpad(concat(m.rvlg_hw + 1, b.rvlg_hw + 1), 3, '0') END AS rvlg_volg,
        CASE WHEN m.rvlg_hw IS NULL THEN 'Nee' ELSE 'Ja' END AS omzetting, b.rsys_nam,
        {partial_sql('b.dhw')} AS dhw, {partial_sql('b.dhwo')} AS dhwo, b.kakt, b.khwo,
        b.ksrt_vrb, {partial_sql('b.dgld')} AS dgld, {partial_sql('b.dopn')} AS dopn
      FROM basis b LEFT JOIN omz m ON m.rsys_prs = b.rsys_prs AND m.rvlg_hw = b.rvlg_hw
        AND m.min_dgld <= b.dgld),
    states AS (
      SELECT DISTINCT rsys_prs, rvlg_hw, rvlg_volg, first_value(rsys_nam) OVER w AS rsys_nam,
        first_value(dhw) OVER w AS dhw, first_value(dhwo) OVER w AS dhwo,
        first_value(kakt) OVER w AS kakt, first_value(khwo) OVER w AS khwo,
        first_value(ksrt_vrb) OVER w AS ksrt_vrb, first_value(omzetting) OVER w AS omzetting,
        first_value(dgld) OVER w AS dgld, first_value(dopn) OVER w AS dopn
      FROM flagged WINDOW w AS {_LATEST})"""
MARRIAGES_SQL = f"""WITH {_BASIS}, {_STATES},
    looked AS (
      SELECT *, lead(omzetting) OVER w AS next_omzetting, lead(dhw) OVER w AS next_dhw FROM states
      WINDOW w AS (PARTITION BY rsys_prs, rvlg_hw ORDER BY dgld NULLS LAST, rvlg_volg NULLS LAST))
    SELECT s.rvlg_hw AS "VolgnummerVerbintenis", s.rsys_prs,
      CAST(s.dhw AS VARCHAR) AS "DatumVerbintenis", i.kbst, o.dovl_gba,
      CAST(CASE WHEN s.next_omzetting = 'Ja' THEN s.next_dhw - 1 ELSE s.dhwo END AS VARCHAR)
        AS "DatumOntbinding",
      s.kakt AS "Aktenummer",
      CASE WHEN s.next_omzetting = 'Ja' THEN 'Omzetting' ELSE d1.oms END AS "RedenOntbinding",
      d2.oms AS "SoortVerbintenis", CAST(s.dgld AS VARCHAR) AS "Datumgeldigvanaf",
      CAST(s.dopn AS VARCHAR) AS "DatumOpname",
      CAST(q.radm AS VARCHAR) || '-BRP' AS "IngeschrevenPersoonId_partner",
      CAST(n.radm AS VARCHAR) || '-BRP' AS "IngeschrevenPersoonId",
      concat(greatest(n.rsys_nam, q.rsys_nam), '-', least(n.rsys_nam, q.rsys_nam), '-',
        coalesce(strftime(s.dhw, '%Y%m%d'), 'x')) AS "HuwelijkId",
      concat(s.rsys_prs, '-', s.rsys_nam, '-', s.rvlg_volg, '-BRP') AS "DWH_IDENTIFICATIE"
    FROM looked s LEFT JOIN gba_tinsgeg i ON i.rsys_prs = s.rsys_prs
    LEFT JOIN gba_tovlakt o ON o.rsys_prs = s.rsys_prs
    {_REGISTERED.format('s')}
    LEFT JOIN gba_tdomein d1 ON d1.kode = s.khwo AND d1.kveld = 'KHWO'
    LEFT JOIN gba_tnamreg q ON q.rsys_nam = s.rsys_nam
    LEFT JOIN gba_tdomein d2 ON d2.kode = s.ksrt_vrb AND d2.kveld = 'KSRT_VRB'"""


@check("map_huwelijk", _sql("HUWELIJK", MARRIAGES_SQL))
def map_huwelijk(t: Tables) -> DataFrame:
    return run(t, "HUWELIJK")


# -- several mappings ---------------------------------------------------------------

_SOCIAL = ["BESCHIKKING", "CLIENT", "DECLARATIEREGEL", "MEDEWERKER"]


@check(
    "mapping_report",
    with_fixtures(
        """SELECT 'BESCHIKKING' AS target, 'loaded' AS status, count(*) AS n_rows FROM wvbesl
        UNION ALL SELECT 'CLIENT', 'loaded', count(*) FROM szclient
        UNION ALL SELECT 'DECLARATIEREGEL', 'skipped', CAST(NULL AS BIGINT)
        UNION ALL SELECT 'MEDEWERKER', 'loaded', count(*) FROM szwerker""",
        "wvbesl",
        "szclient",
        "szwerker",
    ),
)
def mapping_report(t: Tables) -> DataFrame:
    """Claim lines lack a column of their source here and are skipped."""
    tables = frames(t, "wvbesl", "szclient", "szwerker", "wvind_b", "wvdos", "szukhis")
    tables["szukhis"] = tables["szukhis"].drop("bedrag")
    store = t.store("report")
    create_silver(store)
    report = load_silver(Bronze(tables), store, _SOCIAL)
    loaded = row_counts({n: store.read(n) for n in _SOCIAL if n != "DECLARATIEREGEL"})
    return report.join(loaded.withColumnRenamed("table_name", "target"), "target", "left").select(
        "target", "status", "n_rows"
    )


@check("mapping_row_limit", "SELECT least(count(*), 100) AS n_rows FROM orders")
def mapping_row_limit(t: Tables) -> DataFrame:
    return run(t, "BESCHIKKING", row_limit=100).agg(F.count(F.lit(1)).alias("n_rows"))


@check(
    "union_marriage_basis",
    with_fixtures(
        f"WITH {_BASIS} SELECT * FROM basis", "gba_thuwhis", "gba_thuwakt", "gba_tovlakt"
    ),
)
def union_marriage_basis(t: Tables) -> DataFrame:
    return marriage_records(
        SimpleNamespace(**frames(t, "gba_thuwhis", "gba_thuwakt", "gba_tovlakt"))
    )


@check(
    "marriage_states",
    text(
        with_fixtures(
            f"WITH {_BASIS}, {_STATES} SELECT * FROM states",
            "gba_thuwhis",
            "gba_thuwakt",
            "gba_tovlakt",
        ),
        "dhw",
        "dhwo",
        "dgld",
        "dopn",
    ),
)
def marriage_states_query(t: Tables) -> DataFrame:
    src = SimpleNamespace(**frames(t, "gba_thuwhis", "gba_thuwakt", "gba_tovlakt"))
    return marriage_states(src)


def skippable(t: Tables) -> dict[str, str]:
    """What a run without the civil registry would skip, for tests."""
    return plan_all(bronze(t, "wvbesl")).skipped


_ALL = {
    "BESCHIKKING": _BESCHIKKING,
    "BESCHIKTE_VOORZIENING": _PROVISIONS,
    "CLIENT": "SELECT * FROM szclient",
    "DECLARATIEREGEL": _CLAIMS,
    "MEDEWERKER": "SELECT * FROM szwerker",
    "WET_ENUM": "SELECT * FROM szregel",
    "ENUM_GEZINSRELATIE": "SELECT * FROM ods_cen_gba_tdomein "
    "WHERE kveld = 'KIGS_GZR' AND dwh_actueel = 1",
    "NATUURLIJKPERSOON": PERSONS_SQL,
    "INGESCHREVENPERSOON": REGISTRATIONS_SQL,
    "VERBLIJFSADRESINGESCHREVENPERSOON": RESIDENCES_SQL,
    "HUWELIJK": MARRIAGES_SQL,
}


@check(
    "silver_load_all",
    " UNION ALL ".join(
        f"SELECT '{target}' AS target, 'loaded' AS status, "
        f"(SELECT count(*) FROM ({_sql(target, sql)}) AS rows_of) AS n_rows"
        for target, sql in _ALL.items()
    ),
)
def silver_load_all(t: Tables) -> DataFrame:
    """All mappings into their contract tables, shown together at the end."""
    names = {name for spec in MAPPINGS.values() for name in spec.requires}
    store = t.store("all")
    create_silver(store)
    report = load_silver(bronze(t, *sorted(names)), store)
    loaded = row_counts({target: store.read(target) for target in MAPPINGS})
    return report.drop("reason").join(
        loaded.withColumnRenamed("table_name", "target"), "target", "left"
    )
