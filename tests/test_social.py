"""Social-domain mappings on small known rows."""

import datetime as dt
from decimal import Decimal

import pytest

from zilverspoor.plans import MAPPINGS, Bronze, build

# the columns each mapping delivers, in order
LABELS = {
    "BESCHIKKING": "BESCHIKKING_ID CLIENT_ID HEEFT_VOORZIENINGEN_BESCHIKTE_VOORZIENING_ID CODE "
    "COMMENTAAR DATUMAFGIFTE GRONDSLAGEN WET",
    "CLIENT": "RECHTSPERSOON_ID GEZAGSDRAGERGEKEND_ENUM_ID CODE JURIDISCHESTATUS "
    "WETTELIJKEVERTEGENWOORDIGING",
    "DECLARATIEREGEL": "DECLARATIEREGEL_ID BEDRAG BETREFT_CLIENT_ID CODE DATUMEINDE DATUMSTART "
    "IS_VOOR_BESCHIKKING_ID VALT_BINNEN_DECLARATIE_ID",
    "MEDEWERKER": "MEDEWERKER_ID ACHTERNAAM FUNCTIE EMAILADRES GESLACHTSAANDUIDING "
    "MEDEWERKERTOELICHTING TELEFOONNUMMER DATUMINDIENST DATUMUITDIENST EXTERN "
    "MEDEWERKERIDENTIFICATIE ROEPNAAM VOORLETTERS VOORVOEGSELACHTERNAAM",
    "BESCHIKTE_VOORZIENING": "datumeinde datumstart omvang status beschikte_voorziening_id "
    "redeneinde code datumeindeoorspronkelijk eenheid_enum_id frequentie_enum_id "
    "heeft_leveringsvorm_293_id is_voorziening_voorziening_id leveringsvorm_287_enum_id "
    "toegewezen_product_toewijzing_id wet_enum_id",
    "WET_ENUM": "WET_ENUM_ID VALUE",
    "ENUM_GEZINSRELATIE": "ID Waarde",
}


@pytest.mark.parametrize("target", LABELS)
def test_labels_and_order(spark, target):
    tables = {}
    for name, columns in MAPPINGS[target].requires.items():
        schema = ", ".join(f"{c} string" for c in columns)
        tables[name] = spark.createDataFrame([], schema.replace("dd_begin string", "dd_begin timestamp_ntz").replace("dd_eind string", "dd_eind timestamp_ntz"))
    frame = build(target, Bronze(tables))
    assert frame.columns == LABELS[target].split()
    assert "void" not in {f.dataType.simpleString() for f in frame.schema}


@pytest.fixture
def bronze(spark):
    frame = spark.createDataFrame
    provision = (dt.datetime(2023, 12, 1, 23, 30), dt.datetime(2023, 12, 31, 22, 59))
    return {
        "wvind_b": frame(
            [
                ("B001", "01", "C1", *provision, 10, "A", 4),
                ("B001", "02", "C1", *provision, None, "A", 5),
                ("B002", "01", "C2", *provision, 1, None, 6),
                ("B003", None, "C3", None, None, 1, "B", None),
            ],
            "besluitnr string, volgnr_ind string, clientnr string, dd_begin timestamp_ntz, "
            "dd_eind timestamp_ntz, volume int, status_indicatie string, kode_regeling int",
        ),
        "szregel": frame([(4, "JEUGDWET"), (5, "WMO"), (6, None)], "kode_regeling int, omschryving string"),
        "wvbesl": frame([("B001",), ("B002",)], "besluitnr string"),
        "wvdos": frame(
            [("B001", "01", 11, "X"), ("B001", "02", 12, "X"), ("B001", "02", 13, "Y"), ("B002", "01", 14, "X")],
            "besluitnr string, volgnr_ind string, uniek int, kode_reden_einde_voorz string",
        ),
        "abc_refcod": frame(
            [("X", "JZG_REDEN_EINDE_PRODUCT"), ("X", "WVRTEIND"), ("X", "WVRTEIND")], "code string, domein string"
        ),
        "szukhis": frame(
            [("11", Decimal("12.34"), 1), ("11", Decimal("1.00"), 2), ("99", Decimal("5.00"), 3)],
            "uniekwvdos string, bedrag decimal(10,2), verslagnr int",
        ),
    }


def test_claim_lines(spark, bronze, rows):
    got = build("DECLARATIEREGEL", Bronze(bronze))
    assert rows(got) == [
        (11, Decimal("1.00"), "C1", None, None, None, "B001", 2),
        (11, Decimal("12.34"), "C1", None, None, None, "B001", 1),
    ]


def test_provisions_keep_the_rows_of_their_joins(bronze, rows):
    got = build("BESCHIKTE_VOORZIENING", Bronze(bronze))
    picked = rows(got.select("beschikte_voorziening_id", "datumstart", "datumeinde", "omvang", "status"))
    day, end = dt.date(2023, 12, 2), dt.date(2023, 12, 31)
    assert picked == sorted(
        [
            ("B00101", day, end, 10, "A"),  # the youth law has one reason X
            ("B00102", day, end, None, "A"),  # dossier Y has no reason
            ("B00102", day, end, None, "A"),  # dossier X has two reasons under another law
            ("B00102", day, end, None, "A"),
            ("B00201", day, end, 1, None),  # an unknown law matches no reason
            ("B003", None, None, 1, "B"),  # no sequence number, no law
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_provisions_against_sql_on_random_rows(spark, seed):
    """Laws, decisions, dossiers and reasons that are missing, unknown or there several times."""
    import random

    import duckdb
    import pyarrow as pa

    from zilverspoor.checks.compare import compare
    from zilverspoor.checks.core import portable
    from zilverspoor.checks.mappings import _PROVISIONS

    rnd = random.Random(seed)
    pick, moments = rnd.choice, [dt.datetime(2020, 1, 1, 12), dt.datetime(2021, 7, 1, 23), None]
    keys, laws, codes = [1, 2, 3, 4, None], ["a", "b", "c", None], ["x", "y", "z", None]
    tables = {
        "wvind_b": pa.table({
            "besluitnr": pa.array([pick(keys) for _ in range(60)], pa.int32()),
            "volgnr_ind": pa.array([pick([1, 2, None]) for _ in range(60)], pa.int32()),
            "dd_begin": pa.array([pick(moments) for _ in range(60)], pa.timestamp("us")),
            "dd_eind": pa.array([pick(moments) for _ in range(60)], pa.timestamp("us")),
            "volume": pa.array([pick([1, 2]) for _ in range(60)], pa.int32()),
            "status_indicatie": pa.array([pick(["s", None]) for _ in range(60)]),
            "kode_regeling": pa.array([pick(laws) for _ in range(60)]),
        }),
        "szregel": pa.table({
            "kode_regeling": pa.array(["a", "a", "a", "b", "b", None]),
            "omschryving": pa.array(["JEUGDWET", "WMO", None, "WMO", "JEUGDWET", "WMO"]),
        }),
        "wvbesl": pa.table({"besluitnr": pa.array([1, 1, 2, None], pa.int32())}),
        "wvdos": pa.table({
            "besluitnr": pa.array([pick(keys[:3]) for _ in range(30)], pa.int32()),
            "volgnr_ind": pa.array([pick([1, 2]) for _ in range(30)], pa.int32()),
            "kode_reden_einde_voorz": pa.array([pick(codes) for _ in range(30)]),
        }),
        "abc_refcod": pa.table({
            "code": pa.array(["x", "x", "x", "y", "y", "z", None]),
            "domein": pa.array(["JZG_REDEN_EINDE_PRODUCT", "JZG_REDEN_EINDE_PRODUCT", "WVRTEIND",
                                "WVRTEIND", "WVRTEIND", "other", "WVRTEIND"]),
        }),
    }
    connection = duckdb.connect()
    for name, table in tables.items():
        connection.register(name, table)
    frames = {n: spark.createDataFrame(t) for n, t in tables.items()}
    found = build("BESCHIKTE_VOORZIENING", Bronze(frames))
    assert compare(portable(found), connection, _PROVISIONS) is None


def test_provisions_are_only_shuffled_for_rows_that_come_several_times(spark, bronze, tmp_path):
    """Decisions and dossiers of one row each, then forty dossiers of one provision."""
    one = spark.range(300).selectExpr(
        "cast(id as string) as besluitnr", "'01' as volgnr_ind", "'c' as clientnr",
        "timestamp_ntz'2023-12-01 12:00:00' as dd_begin", "timestamp_ntz'2023-12-02 12:00:00' as dd_eind",
        "1 as volume", "'A' as status_indicatie", "4 as kode_regeling", "id as uniek", "'X' as kode_reden_einde_voorz",
    )
    one.write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    tables = bronze | {"wvind_b": one, "wvbesl": one.select("besluitnr"), "wvdos": one}
    tables["abc_refcod"] = bronze["abc_refcod"].limit(1)
    got = build("BESCHIKTE_VOORZIENING", Bronze(tables))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 300
    assert "Exchange hashpartitioning" not in plan and "RoundRobin" not in plan
    tables["wvdos"] = one.unionByName(one.where("besluitnr = '7'").selectExpr("*", "explode(sequence(1, 39)) as i").drop("i"))
    got = build("BESCHIKTE_VOORZIENING", Bronze(tables))
    assert got.count() == 339
    assert "RoundRobin" in got._jdf.queryExecution().executedPlan().toString()
