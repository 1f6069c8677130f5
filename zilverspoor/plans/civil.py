"""Civil-registry mappings: persons, registrations, addresses and marriages.

The address history is the large table. It is reduced per person, or cut to one
row per (person number, begin), before names are looked up, and names are looked
up per person rather than per address row.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zilverspoor.functions import (
    address_line,
    begin_date,
    begin_number,
    code_label,
    concat_propagate,
    concat_skip_null,
    format_bsn,
    incomplete_date_to_date,
    pair_key,
    suffixed_key,
    yesterday_number,
    yyyymmdd_to_date,
    zero_pad,
)
from zilverspoor.functions.dates import OPEN_END, UNKNOWN_BEGIN
from zilverspoor.operators.history import close_interval, current_rows, union_history
from zilverspoor.operators.lookup import decode, household_relations
from zilverspoor.operators.windows import (
    by,
    first_as_aggregate,
    join_null_safe,
    look_ahead,
    rows_at_min,
    running_max_steps,
    top_row,
)
from zilverspoor.plans.registry import mapping

# The first closing day that counts, the code of a record made in
# error, the key suffixes and names of the source registers, the domains of the
# code table, single labels and the code lists below.
FIRST_END = 20000101
IN_ERROR = "F"
ACTIVE = "A"
PERSONS, BUILDINGS = "-BRP", "-BAG"
SOURCE = "CEN_BRP"
RELATION, ORIGIN, STAY_END = "KIGS_GZR", "KADRF", "KWON_END"
MARRIAGE_END, MARRIAGE_KIND = "KHWO", "KSRT_VRB"
HOME = "Woonadres"
BY_DEATH, DIED_ON = "OVL", "Overleden op "
CONVERSION_ACT, CONVERTED = "H", "Omzetting"
YES, NO = "Ja", "Nee"
END_REASONS = {
    "W": "Adreswijziging",
    "V": "Vertrokken",
    "O": "Overleden",
    "F": "Foutieve persoonslijst",
    "U": "Vernummering",
    "A": "Vernaming",
    "M": "Ministerieel besluit",
    "X": "Geactualiseerd",
}
SUSPENSIONS = {
    "E": "Geemigreerd op ",
    "M": "Ministerieel besluit op ",
    "F": "Foute PL op ",
    ".": "Opschorting onbekend op ",
}
YES_NO = {1: YES, 0: NO}

_ADDRESS = ["rsys_adr", "nstr", "rhs", "nhsr_lt", "khsr_tv", "khsr_ad", "kpst_num", "kpst_alf"]
_HISTORY = ["rsys_prs", "rsys_adr", "dwon_bgn", "dwon_end", "kwon_end"]


def closed_addresses(history: DataFrame) -> DataFrame:
    """Address rows that ended in the period kept; a row without an end code is dropped."""
    return history.where((F.col("dwon_end") >= FIRST_END) & (F.col("kwon_end") != IN_ERROR))


def counted_persons(persons: DataFrame) -> DataFrame:
    """All person lists but those made in error; no code at all counts."""
    return persons.where(F.coalesce("kops", F.lit("x")) != IN_ERROR)


def named_persons(src: SimpleNamespace, *name_columns: str) -> DataFrame:
    """Per person the active registration, current or archived, with its name row.

    Left joining this on ``rsys_prs`` gives what joining the two registers and
    then the names would, while only person-sized tables are shuffled by name.
    """
    current = current_rows(src.gba_tprsgeg, {"ireg": ACTIVE}).drop("ireg")
    archived = current_rows(src.gba_tarcgeg, {"ireg": ACTIVE}).drop("ireg")
    shared = [c for c in current.columns if c != "rsys_prs"]
    archived = archived.withColumnsRenamed({c: f"arc_{c}" for c in shared})
    both = current.join(archived, "rsys_prs", "full").select(
        "rsys_prs", *[F.coalesce(c, f"arc_{c}").alias(c) for c in shared]
    )
    both = both.withColumnRenamed("rsys_nam", "name_key")
    names = src.gba_tnamreg.select("rsys_nam", *name_columns)
    return both.join(names, F.col("name_key") == F.col("rsys_nam"), "left").drop("name_key")


def location(clean: bool = False):
    return address_line(
        *[F.col(c) for c in (*_ADDRESS[1:], "nwpl_nm")],
        clean=clean,
    )


@mapping("ENUM_GEZINSRELATIE", ods_cen_gba_tdomein=["kode", "oms", "kveld", "dwh_actueel"])
def household_relation_enum(src: SimpleNamespace) -> DataFrame:
    active = current_rows(src.ods_cen_gba_tdomein, {"kveld": RELATION, "dwh_actueel": 1})
    return active.select(F.col("kode").alias("ID"), F.col("oms").alias("Waarde"))


@mapping(
    "NATUURLIJKPERSOON",
    gba_tbwnhis=_HISTORY,
    gba_tvbpakt=["rsys_prs"],
    gba_tprsgeg=["rsys_prs", "ireg", "rsys_nam", "kgsl"],
    gba_tarcgeg=["rsys_prs", "ireg", "rsys_nam", "kgsl"],
    gba_tnamreg=["rsys_nam", "radm", "rsofi", "nvoor", "nvlr_gba", "nvgsl", "ngsl", "dgeb_gba"],
    gba_tinsgeg=["rsys_prs", "kops"],
    gba_tovlakt=["rsys_prs", "dovl_gba"],
)
def natural_persons(src: SimpleNamespace) -> DataFrame:
    """One row per person number: the list with the latest address.

    Several lists can share a person number. Of those whose address ends last
    (an open end is latest) the highest list number is taken. Both are maxima,
    so the address history shrinks to one row per list before any join.
    """
    persons = named_persons(
        src, "radm", "rsofi", "nvoor", "nvlr_gba", "nvgsl", "ngsl", "dgeb_gba"
    )
    addresses = union_history(
        closed_addresses(src.gba_tbwnhis).select("rsys_prs", "dwon_end"),
        src.gba_tvbpakt.select("rsys_prs"),
    )
    last_ends = addresses.groupBy("rsys_prs").agg(
        F.max(F.coalesce("dwon_end", F.lit(OPEN_END))).alias("last_end")
    )
    latest = (
        last_ends.join(persons.select("rsys_prs", "radm"), "rsys_prs", "left")
        .groupBy("radm")
        .agg(F.max(F.struct("last_end", "rsys_prs")).alias("latest"))
        .select(F.col("latest.rsys_prs").alias("rsys_prs"))
    )
    rows = (
        counted_persons(src.gba_tinsgeg)
        .join(latest, "rsys_prs")
        .join(src.gba_tovlakt, "rsys_prs", "left")
        .join(persons, "rsys_prs", "left")
    )
    return rows.select(
        F.col("radm").alias("NatuurlijkPersoonId"),
        format_bsn(F.col("rsofi")).alias("BSN"),
        F.col("dgeb_gba").alias("datumgeboren"),
        F.col("dovl_gba").alias("datumoverlijden"),
        F.col("kgsl").alias("Enum_GeslachtID"),
        F.col("nvoor").alias("Voornamen"),
        F.col("nvlr_gba").alias("Voorletters"),
        F.col("nvgsl").alias("Voorvoegselgeslachtsnaam"),
        F.col("ngsl").alias("Geslachtsnaam"),
        suffixed_key(F.col("radm"), PERSONS).alias("DWH_IDENTIFICATIE"),
    )


def registration_history(src: SimpleNamespace, persons: DataFrame) -> DataFrame:
    """One address row per (person number, begin), with the list it belongs to.

    The row with the latest end wins. Its list is the highest list number among
    the person number's addresses that end as late or later.
    """
    current = src.gba_tvbpakt.select(
        "rsys_prs", "rsys_adr", F.col("dadrh").alias("dwon_bgn"), "kigs_gzr"
    )
    addresses = union_history(closed_addresses(src.gba_tbwnhis), current).withColumn(
        "end_value", F.coalesce("dwon_end", F.lit(OPEN_END))
    )
    numbers = persons.select("rsys_prs", "radm")

    ends = addresses.select("rsys_prs", "end_value").distinct()
    lists = running_max_steps(
        ends.join(numbers, "rsys_prs", "left"),
        ["radm"],
        "end_value",
        "rsys_prs",
        "rsys_prs_max",
        descending=True,
    )
    # ties: highest list number, then the remaining columns
    latest = top_row(
        addresses.join(numbers, "rsys_prs", "left"),
        ["radm", F.coalesce("dwon_bgn", F.lit(UNKNOWN_BEGIN))],
        [
            by("end_value", descending=True),
            by("rsys_prs", descending=True),
            *[by(c) for c in ("rsys_adr", "dwon_bgn", "kwon_end", "kigs_gzr")],
        ],
    )
    return join_null_safe(latest, lists, ["radm", "end_value"], "inner")


#: Columns of an address by which rows of one begin day follow each other.
_ADDRESS_TIES = ["nstr", "rhs", "nhsr_lt", "khsr_tv", "khsr_ad", "kpst_num", "kpst_alf", "nwpl_nm"]


@mapping(
    "INGESCHREVENPERSOON",
    gba_tbwnhis=_HISTORY,
    gba_tvbpakt=["rsys_prs", "rsys_adr", "dadrh", "kigs_gzr"],
    gba_tprsgeg=["rsys_prs", "ireg", "rsys_nam"],
    gba_tarcgeg=["rsys_prs", "ireg", "rsys_nam"],
    gba_tnamreg=["rsys_nam", "radm"],
    gba_tinsgeg=["rsys_prs", "kops", "dops"],
    gba_tovlakt=["rsys_prs", "dovl_gba"],
    gba_tgbaadr=[*_ADDRESS, "nwpl_nm", "nid_nad"],
    gba_tselbst=["rsys_prs", "khfd_bew"],
)
def registered_persons(src: SimpleNamespace) -> DataFrame:
    """Registrations per person number and begin of residence."""
    persons = named_persons(src, "radm")
    yesterday = yesterday_number(src.as_of)
    residences = registration_history(src, persons).select(
        F.col("rsys_prs_max").alias("rsys_prs"),
        "rsys_adr",
        F.col("dwon_bgn").alias("raw_bgn"),
        begin_number(F.col("dwon_bgn"), F.coalesce("dwon_end", yesterday)).alias("dwon_bgn"),
        "dwon_end",
        "kwon_end",
        "kigs_gzr",
    )
    occupants = src.gba_tselbst.select(F.col("rsys_prs").alias("occupant"), "khfd_bew")
    relations = household_relations(src.gba_tinsgeg.sparkSession).select(
        "nummer", "omschrijving"
    )
    # every join on the person first, so they share one partitioning
    rows = (
        counted_persons(src.gba_tinsgeg)
        .join(residences, "rsys_prs")
        .join(src.gba_tovlakt, "rsys_prs", "left")
        .join(persons.select("rsys_prs", "radm"), "rsys_prs", "left")
        .join(
            occupants,
            (F.col("rsys_prs") == F.col("occupant")) & F.col("dwon_end").isNull(),
            "left",
        )
        .join(relations, F.col("nummer") == F.col("kigs_gzr"), "left")
        .join(src.gba_tgbaadr, "rsys_adr", "left")
    )
    # occupants and addresses may repeat a row any number of times
    ties = ["dwon_end", "rsys_adr", "kwon_end", "kigs_gzr", "raw_bgn", "khfd_bew", "nid_nad", *_ADDRESS_TIES]
    rows = rows.select("radm", "dwon_bgn", *ties, "kops", "dops", "dovl_gba", "omschrijving")
    rows = look_ahead(rows, ["radm"], "dwon_bgn", "next_bgn", ties)
    suspension = (
        F.when(
            F.col("kops").isin(*SUSPENSIONS),
            concat_propagate(code_label(F.col("kops"), SUSPENSIONS), F.col("dops")),
        )
        .when(
            F.col("dovl_gba").isNotNull(),
            concat_propagate(F.lit(DIED_ON), F.col("dovl_gba")),
        )
        .otherwise(F.col("kops"))
    )
    return rows.select(
        F.col("radm").alias("IngeschrevenPersoonId"),
        F.col("radm").alias("A_nummer"),
        yyyymmdd_to_date(F.col("dwon_bgn")).alias("BegindatumVerblijf"),
        F.col("dwon_bgn"),
        close_interval(
            yyyymmdd_to_date(F.col("dwon_end")), F.col("dwon_end"), F.col("next_bgn")
        ).alias("EinddatumVerblijf"),
        F.col("dops").alias("dd_opschort_bijhouding"),
        F.when(F.col("kops") == "E", F.col("dops")).alias("datumvertrekuitnederland"),
        suffixed_key(F.col("nid_nad"), BUILDINGS).alias("NummeraanduidingID"),
        code_label(F.col("kwon_end"), END_REASONS).alias("RedenEindeBewoning"),
        F.col("kigs_gzr").alias("gezinstrelatieid"),
        F.col("omschrijving").alias("gezinsrelatie"),
        location().alias("locatiebeschrijving"),
        suspension.alias("Reden_Opschort_bijhouding"),
        code_label(F.col("khfd_bew"), YES_NO).alias("Hoofdbewoner"),
        suffixed_key(F.col("radm"), PERSONS).alias("DWH_IDENTIFICATIE"),
    )


@mapping(
    "VERBLIJFSADRESINGESCHREVENPERSOON",
    gba_tbwnhis=[*_HISTORY, "rvlg"],
    gba_tvbpakt=["rsys_prs", "rsys_adr", "dadrh", "kadrf"],
    gba_tdomein=["kode", "kveld", "oms"],
    gba_tinsgeg=["rsys_prs", "kops", "dtoe_gba"],
    gba_tprsgeg=["rsys_prs", "ireg", "rsys_nam"],
    gba_tarcgeg=["rsys_prs", "ireg", "rsys_nam"],
    gba_tnamreg=["rsys_nam", "radm"],
    gba_tgbaadr=[*_ADDRESS, "nwpl_nm", "nid_vbo"],
)
def residence_addresses(src: SimpleNamespace) -> DataFrame:
    """Residence addresses; of repeated entries of one stay the first one counts."""
    closed = closed_addresses(src.gba_tbwnhis).withColumn("herkomst", F.lit(HOME))
    current = src.gba_tvbpakt.select(
        "rsys_prs", "rsys_adr", F.col("dadrh").alias("dwon_bgn"), F.lit(-1).alias("rvlg"), "kadrf"
    )
    stays = rows_at_min(
        union_history(closed, current), ["rsys_prs", "rsys_adr", "dwon_bgn"], "rvlg"
    )
    stays = (
        decode(stays, "kadrf", src.gba_tdomein, ORIGIN, "aangifte")
        .withColumn("adresherkomst", F.coalesce("herkomst", "aangifte"))
        .drop("kadrf", "herkomst", "aangifte")
    )
    rows = (
        counted_persons(src.gba_tinsgeg)
        .drop("kops")
        .join(stays, "rsys_prs")
        .join(named_persons(src, "radm").select("rsys_prs", "radm"), "rsys_prs", "left")
    )
    rows = decode(rows, "kwon_end", src.gba_tdomein, STAY_END, "reden").join(
        src.gba_tgbaadr, "rsys_adr", "left"
    )
    # after the joins, as codes and addresses that occur twice follow each other, too
    ties = [
        "dwon_end", "rsys_prs", "rsys_adr", "rvlg", "adresherkomst", "kwon_end", "dtoe_gba",
        "reden", "nid_vbo", *_ADDRESS_TIES,
    ]
    rows = look_ahead(rows.select("radm", "dwon_bgn", *ties), ["radm"], "dwon_bgn", "next_bgn", ties)
    stay_key = concat_propagate(
        F.col("rsys_prs"), F.lit("-"), F.col("rsys_adr"), F.lit("-"), F.col("dwon_bgn")
    )
    return rows.select(
        F.col("adresherkomst").alias("AdresHerkomst"),
        begin_date(F.col("dwon_bgn"), F.col("dtoe_gba")).alias("datumBegin"),
        close_interval(
            yyyymmdd_to_date(F.col("dwon_end")), F.col("dwon_end"), F.col("next_bgn")
        ).alias("datumEinde"),
        suffixed_key(F.col("nid_vbo"), BUILDINGS).alias("BAGID_adresseerbaarobject"),
        F.col("reden").alias("RedenEindeBewoning"),
        location().alias("beschrijvingLocatie"),
        F.col("rhs").alias("huisnummer"),
        F.col("nhsr_lt").alias("huisletter"),
        F.col("khsr_tv").alias("huisnummertoevoeging"),
        F.col("khsr_ad").alias("huisnummeraanduiding"),
        concat_skip_null(F.col("kpst_num"), F.col("kpst_alf")).alias("postcode"),
        F.col("nstr").alias("straatnaam"),
        F.col("nwpl_nm").alias("plaats"),
        suffixed_key(F.col("radm"), PERSONS).alias("IngeschrevenPersoonId"),
        stay_key.alias("VerblijfsAdresIngeschrevenPersoonId"),
        suffixed_key(stay_key, PERSONS).alias("DWH_IDENTIFICATIE"),
        F.lit(SOURCE).alias("DWH_BRON"),
        F.lit(1).alias("DWH_ACTUEEL"),
    )


_MARRIAGE = [
    "rsys_prs",
    "rvlg_hw",
    "rsys_nam",
    "dhw",
    "dhwo",
    "kakt",
    "khwo",
    "ksrt_vrb",
    "dgld",
    "dopn",
]


def valid_history(src: SimpleNamespace) -> DataFrame:
    return src.gba_thuwhis.where(F.col("ionj").isNull()).select(*_MARRIAGE)


def marriage_records(src: SimpleNamespace) -> DataFrame:
    """Valid history rows of marriages that still have a current row, and those rows.

    A marriage without an end day ends by the death of the person, when that came
    after the wedding.
    """
    history = valid_history(src).join(src.gba_thuwakt.select("rsys_prs", "rvlg_hw"), ["rsys_prs", "rvlg_hw"])
    by_death = F.col("dhwo").isNull() & (F.col("dovl_gba") > F.coalesce("dhw", F.lit(0)))
    current = src.gba_thuwakt.join(src.gba_tovlakt, "rsys_prs", "left").withColumns(
        {
            "khwo": F.when(by_death, F.lit(BY_DEATH)).otherwise(F.col("khwo")),
            "dhwo": F.when(by_death, F.col("dovl_gba")).otherwise(F.col("dhwo")),
        }
    )
    return history.select(*_MARRIAGE).unionByName(current.select(*_MARRIAGE))


def marriage_conversions(records: DataFrame) -> DataFrame:
    """Per marriage the first day a conversion record is valid."""
    return (
        records.where(F.substring("kakt", 3, 1) == CONVERSION_ACT)
        .groupBy("rsys_prs", "rvlg_hw")
        .agg(F.min("dgld").alias("first_conversion"))
    )


def marriage_states(src: SimpleNamespace) -> DataFrame:
    """Marriages by state (plain or converted), each with its latest record's values."""
    records = marriage_records(src)
    # history of a marriage without a current row matches no record, so the
    # conversions need no join and their filter reaches both scans
    acts = valid_history(src).unionByName(src.gba_thuwakt.select(*_MARRIAGE))
    conversions = marriage_conversions(acts).dropna(subset=["rsys_prs", "rvlg_hw"])
    number = (F.col("rvlg_hw") + 1).cast("string")
    converted = F.coalesce(F.col("first_conversion") <= F.col("dgld"), F.lit(False))
    rows = join_null_safe(records, conversions, ["rsys_prs", "rvlg_hw"]).select(
        "rsys_prs",
        "rvlg_hw",
        F.when(converted, zero_pad(concat_skip_null(number, number), 3))
        .otherwise(zero_pad(number, 3))
        .alias("rvlg_volg"),
        F.when(converted, YES).otherwise(NO).alias("omzetting"),
        "rsys_nam",
        *[incomplete_date_to_date(F.col(c)).alias(c) for c in ("dhw", "dhwo", "dgld", "dopn")],
        "kakt",
        "khwo",
        "ksrt_vrb",
    )
    values = ["rsys_nam", "dhw", "dhwo", "kakt", "khwo", "ksrt_vrb", "omzetting", "dgld"]
    # a label is shared by very few marriage numbers of one person (converted 0 and
    # plain 10 are both 011), so the set stays tiny
    labels = rows.groupBy("rsys_prs", "rvlg_volg").agg(
        first_as_aggregate("dopn", values).alias("latest"),
        F.collect_set("rvlg_hw").alias("numbers"),
    )
    return labels.select(
        "rsys_prs", F.explode_outer("numbers").alias("rvlg_hw"), "rvlg_volg", "latest.*"
    )


@mapping(
    "HUWELIJK",
    gba_thuwhis=[*_MARRIAGE, "ionj"],
    gba_thuwakt=_MARRIAGE,
    gba_tovlakt=["rsys_prs", "dovl_gba"],
    gba_tinsgeg=["rsys_prs", "kbst"],
    gba_tprsgeg=["rsys_prs", "ireg", "rsys_nam"],
    gba_tarcgeg=["rsys_prs", "ireg", "rsys_nam"],
    gba_tnamreg=["rsys_nam", "radm"],
    gba_tdomein=["kode", "kveld", "oms"],
)
def marriages(src: SimpleNamespace) -> DataFrame:
    """Marriages and partnerships; a converted one ends the day before the conversion."""
    states = marriage_states(src)
    # a marriage has two states at most, plain and converted, so this window is tiny
    window = Window.partitionBy("rsys_prs", "rvlg_hw").orderBy(by("dgld"), by("rvlg_volg"))
    states = states.select(
        *[F.col(c).alias("partner_nam" if c == "rsys_nam" else c) for c in states.columns],
        F.lead("omzetting").over(window).alias("next_omzetting"),
        F.lead("dhw").over(window).alias("next_dhw"),
    )
    persons = named_persons(src, "radm").select("rsys_prs", "rsys_nam", "radm")
    partners = src.gba_tnamreg.select(
        F.col("rsys_nam").alias("p_nam"), F.col("radm").alias("p_radm")
    )
    rows = (
        states.join(src.gba_tinsgeg, "rsys_prs", "left")
        .join(src.gba_tovlakt, "rsys_prs", "left")
        .join(persons, "rsys_prs", "left")
        .join(partners, F.col("p_nam") == F.col("partner_nam"), "left")
    )
    rows = decode(rows, "khwo", src.gba_tdomein, MARRIAGE_END, "reden")
    rows = decode(rows, "ksrt_vrb", src.gba_tdomein, MARRIAGE_KIND, "soort")
    converted = F.col("next_omzetting") == YES
    return rows.select(
        F.col("rvlg_hw").alias("VolgnummerVerbintenis"),
        F.col("rsys_prs"),
        F.col("dhw").alias("DatumVerbintenis"),
        F.col("kbst"),
        F.col("dovl_gba"),
        F.when(converted, F.date_sub("next_dhw", 1)).otherwise(F.col("dhwo")).alias(
            "DatumOntbinding"
        ),
        F.col("kakt").alias("Aktenummer"),
        F.when(converted, CONVERTED).otherwise(F.col("reden")).alias("RedenOntbinding"),
        F.col("soort").alias("SoortVerbintenis"),
        F.col("dgld").alias("Datumgeldigvanaf"),
        F.col("dopn").alias("DatumOpname"),
        suffixed_key(F.col("p_radm"), PERSONS).alias("IngeschrevenPersoonId_partner"),
        suffixed_key(F.col("radm"), PERSONS).alias("IngeschrevenPersoonId"),
        pair_key(F.col("rsys_nam"), F.col("p_nam"), F.col("dhw")).alias("HuwelijkId"),
        concat_skip_null(
            F.col("rsys_prs"),
            F.lit("-"),
            F.col("partner_nam"),
            F.lit("-"),
            F.col("rvlg_volg"),
            F.lit(PERSONS),
        ).alias("DWH_IDENTIFICATIE"),
    )
