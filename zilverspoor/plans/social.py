"""Social-domain mappings: clients, decisions, provisions, claim lines, staff, laws."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zilverspoor.functions import concat_skip_null, local_date
from zilverspoor.operators.columns import project, typed_null
from zilverspoor.operators.expand import repeat_rows
from zilverspoor.plans.registry import mapping
from zilverspoor.session import keep

# The youth law, and the code domains of end reasons under it and
# under any other law.
YOUTH_LAW = "JEUGDWET"
YOUTH_REASONS, OTHER_REASONS = "JZG_REDEN_EINDE_PRODUCT", "WVRTEIND"


@mapping("BESCHIKKING", wvbesl=["besluitnr", "clientnr"])
def decisions(src: SimpleNamespace) -> DataFrame:
    return project(
        src.wvbesl,
        {
            "BESCHIKKING_ID": "besluitnr",
            "CLIENT_ID": "clientnr",
            "HEEFT_VOORZIENINGEN_BESCHIKTE_VOORZIENING_ID": "besluitnr",
        },
        nulls={
            "CODE": "string",
            "COMMENTAAR": "string",
            "DATUMAFGIFTE": "date",
            "GRONDSLAGEN": "int",
            "WET": "string",
        },
    )


@mapping(
    "BESCHIKTE_VOORZIENING",
    wvind_b=[
        "besluitnr",
        "volgnr_ind",
        "dd_begin",
        "dd_eind",
        "volume",
        "status_indicatie",
        "kode_regeling",
    ],
    szregel=["kode_regeling", "omschryving"],
    wvbesl=["besluitnr"],
    wvdos=["besluitnr", "volgnr_ind", "kode_reden_einde_voorz"],
    abc_refcod=["code", "domein"],
)
def granted_provisions(src: SimpleNamespace) -> DataFrame:
    """Provisions with local begin and end days.

    The left joins decide how many rows come out: a provision with two dossiers,
    or two matching end reasons, appears twice. Which reasons match depends on
    the law; a provision without a known law matches none. No column of a right
    side comes out, so each is reduced to numbers of matches before it is joined,
    and rows are repeated at the end.

    A decision of one row, and dossiers that come to one row under any law, change
    nothing. Only the others are joined. They are written first: then it is known
    how large they are, and how often a row is repeated at most.
    """
    laws = src.szregel.groupBy("kode_regeling").agg(
        F.count_if(F.col("omschryving") == YOUTH_LAW).alias("youth_laws"),
        F.count_if(F.col("omschryving") != YOUTH_LAW).alias("other_laws"),
        F.count_if(F.col("omschryving").isNull()).alias("unknown_laws"),
    )
    decisions = src.wvbesl.groupBy("besluitnr").agg(F.count(F.lit(1)).alias("decisions"))
    decisions = decisions.where("decisions > 1")
    reasons = src.abc_refcod.groupBy("code").agg(
        F.count_if(F.col("domein") == YOUTH_REASONS).alias("youth_reasons"),
        F.count_if(F.col("domein") == OTHER_REASONS).alias("other_reasons"),
    )
    each = src.wvdos.groupBy("besluitnr", "volgnr_ind", "kode_reden_einde_voorz").agg(
        F.count(F.lit(1)).alias("n")
    )
    # a dossier without a matching reason still is a row
    matched = lambda c: F.sum(F.col("n") * F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)))
    dossiers = (
        each.join(reasons, F.col("kode_reden_einde_voorz") == F.col("code"), "left")
        .groupBy("besluitnr", "volgnr_ind")
        .agg(
            matched("youth_reasons").alias("youth_rows"),
            matched("other_reasons").alias("other_rows"),
            F.sum("n").alias("plain_rows"),
        )
        .where("youth_rows > 1 or other_rows > 1 or plain_rows > 1")
    )
    laws, decisions, dossiers = (
        keep(df, f"provisions-{name}")
        for name, df in (("laws", laws), ("decisions", decisions), ("dossiers", dossiers))
    )
    most = (
        _most(laws, F.col("youth_laws") + F.col("other_laws") + F.col("unknown_laws"))
        * _most(decisions, F.col("decisions"))
        * _most(dossiers, F.greatest("youth_rows", "other_rows", "plain_rows"))
    )
    one = lambda c: F.coalesce(c, F.lit(1))
    none = lambda c: F.coalesce(c, F.lit(0))
    copies = one("decisions") * (
        none("youth_laws") * one("youth_rows")
        + none("other_laws") * one("other_rows")
        + one("unknown_laws") * one("plain_rows")
    )
    # days before the joins: half the width in the shuffles, and not once per match
    provisions = src.wvind_b.select(
        "besluitnr",
        "volgnr_ind",
        "kode_regeling",
        local_date(F.col("dd_eind")).alias("datumeinde"),
        local_date(F.col("dd_begin")).alias("datumstart"),
        "volume",
        "status_indicatie",
    )
    rows = (
        provisions.join(laws, "kode_regeling", "left")
        .join(decisions, "besluitnr", "left")
        .join(dossiers, ["besluitnr", "volgnr_ind"], "left")
        .select(*provisions.columns, copies.alias("copies"))
    )
    rows = repeat_rows(rows, "copies", most=most)
    return rows.select(
        F.col("datumeinde"),
        F.col("datumstart"),
        F.col("volume").alias("omvang"),
        F.col("status_indicatie").alias("status"),
        concat_skip_null(F.col("besluitnr"), F.col("volgnr_ind")).alias(
            "beschikte_voorziening_id"
        ),
        typed_null("date").alias("redeneinde"),
        typed_null("string").alias("code"),
        typed_null("date").alias("datumeindeoorspronkelijk"),
        typed_null("string").alias("eenheid_enum_id"),
        typed_null("string").alias("frequentie_enum_id"),
        typed_null("string").alias("heeft_leveringsvorm_293_id"),
        typed_null("string").alias("is_voorziening_voorziening_id"),
        typed_null("string").alias("leveringsvorm_287_enum_id"),
        typed_null("string").alias("toegewezen_product_toewijzing_id"),
        typed_null("string").alias("wet_enum_id"),
    )


def _most(df: DataFrame, rows: Column) -> int:
    """The largest number of rows that one row becomes by a join; one for a row without a match."""
    return max(1, df.agg(F.max(rows)).first()[0] or 1)


@mapping("CLIENT", szclient=["clientnr", "ind_gezag"])
def clients(src: SimpleNamespace) -> DataFrame:
    return project(
        src.szclient,
        {"RECHTSPERSOON_ID": "clientnr", "GEZAGSDRAGERGEKEND_ENUM_ID": "ind_gezag"},
        nulls={
            "CODE": "string",
            "JURIDISCHESTATUS": "string",
            "WETTELIJKEVERTEGENWOORDIGING": "string",
        },
    )


@mapping(
    "DECLARATIEREGEL",
    szukhis=["uniekwvdos", "bedrag", "verslagnr"],
    wvdos=["besluitnr", "volgnr_ind", "uniek"],
    wvind_b=["besluitnr", "volgnr_ind", "clientnr"],
)
def claim_lines(src: SimpleNamespace) -> DataFrame:
    """Payments of a provision's dossier; the dossier key is text on one side."""
    dossiers = src.wvind_b.join(src.wvdos, ["besluitnr", "volgnr_ind"])
    rows = dossiers.join(
        src.szukhis, F.col("uniekwvdos").cast("string") == F.col("uniek").cast("string")
    )
    return rows.select(
        F.col("uniek").alias("DECLARATIEREGEL_ID"),
        F.col("bedrag").alias("BEDRAG"),
        F.col("clientnr").alias("BETREFT_CLIENT_ID"),
        typed_null("string").alias("CODE"),
        typed_null("date").alias("DATUMEINDE"),
        typed_null("date").alias("DATUMSTART"),
        F.col("besluitnr").alias("IS_VOOR_BESCHIKKING_ID"),
        F.col("verslagnr").alias("VALT_BINNEN_DECLARATIE_ID"),
    )


@mapping(
    "MEDEWERKER",
    szwerker=[
        "kode_werker",
        "naam",
        "kode_instan",
        "e_mail",
        "ind_geslacht",
        "toelichting",
        "telefoon",
    ],
)
def staff(src: SimpleNamespace) -> DataFrame:
    return project(
        src.szwerker,
        {
            "MEDEWERKER_ID": "kode_werker",
            "ACHTERNAAM": "naam",
            "FUNCTIE": "kode_instan",
            "EMAILADRES": "e_mail",
            "GESLACHTSAANDUIDING": "ind_geslacht",
            "MEDEWERKERTOELICHTING": "toelichting",
            "TELEFOONNUMMER": "telefoon",
        },
        nulls={
            "DATUMINDIENST": "date",
            "DATUMUITDIENST": "date",
            "EXTERN": "string",
            "MEDEWERKERIDENTIFICATIE": "string",
            "ROEPNAAM": "string",
            "VOORLETTERS": "string",
            "VOORVOEGSELACHTERNAAM": "string",
        },
    )


@mapping("WET_ENUM", szregel=["kode_regeling", "omschryving"])
def laws(src: SimpleNamespace) -> DataFrame:
    return project(src.szregel, {"WET_ENUM_ID": "kode_regeling", "VALUE": "omschryving"})
