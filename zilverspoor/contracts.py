"""Contracts of the silver tables: columns, keys, references and enum values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Reference:
    """Columns that must occur as the key of another table."""

    columns: tuple[str, ...]
    table: str
    key: tuple[str, ...]


@dataclass(frozen=True)
class TableContract:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    seed: tuple[tuple, ...] = field(default=())

    def ddl_columns(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def _text(length: int = 255) -> T.DataType:
    return T.VarcharType(length)


_DATE, _INT, _LONG, _STRING = T.DateType(), T.IntegerType(), T.LongType(), T.StringType()

# Names, types and lengths of the canonical tables.
BESCHIKKING = TableContract(
    "BESCHIKKING",
    _schema(
        BESCHIKKING_ID=_text(),
        CLIENT_ID=_text(),
        CODE=_text(20),
        COMMENTAAR=_text(200),
        DATUMAFGIFTE=_DATE,
        GRONDSLAGEN=_INT,
        HEEFT_VOORZIENINGEN_BESCHIKTE_VOORZIENING_ID=_text(),
        TOEWIJZING_TOEWIJZING_ID=_text(),
        WET=_text(),
    ),
    primary_key=("BESCHIKKING_ID",),
    references=(
        Reference(("CLIENT_ID",), "CLIENT", ("RECHTSPERSOON_ID",)),
        Reference(
            ("HEEFT_VOORZIENINGEN_BESCHIKTE_VOORZIENING_ID",),
            "BESCHIKTE_VOORZIENING",
            ("BESCHIKTE_VOORZIENING_ID",),
        ),
    ),
)
BESCHIKTE_VOORZIENING = TableContract(
    "BESCHIKTE_VOORZIENING",
    _schema(
        BESCHIKTE_VOORZIENING_ID=_text(),
        CODE=_text(20),
        DATUMEINDE=_DATE,
        DATUMEINDEOORSPRONKELIJK=_DATE,
        DATUMSTART=_DATE,
        EENHEID_ENUM_ID=_text(),
        FREQUENTIE_ENUM_ID=_text(),
        HEEFT_LEVERINGSVORM_293_ID=_text(),
        IS_VOORZIENING_VOORZIENING_ID=_text(),
        LEVERINGSVORM_287_ENUM_ID=_text(),
        OMVANG=_INT,
        REDENEINDE=_DATE,
        STATUS=_text(50),
        TOEGEWEZEN_PRODUCT_TOEWIJZING_ID=_text(),
        WET_ENUM_ID=_text(),
    ),
    primary_key=("BESCHIKTE_VOORZIENING_ID",),
    references=(Reference(("WET_ENUM_ID",), "WET_ENUM", ("WET_ENUM_ID",)),),
)
CLIENT = TableContract(
    "CLIENT",
    _schema(
        RECHTSPERSOON_ID=_text(),
        CODE=_text(80),
        GEZAGSDRAGERGEKEND_ENUM_ID=_text(),
        JURIDISCHESTATUS=_text(80),
        WETTELIJKEVERTEGENWOORDIGING=_text(80),
    ),
    primary_key=("RECHTSPERSOON_ID",),
)
DECLARATIEREGEL = TableContract(
    "DECLARATIEREGEL",
    _schema(
        DECLARATIEREGEL_ID=_text(),
        BEDRAG=T.DecimalType(10, 2),
        BETREFT_CLIENT_ID=_text(),
        CODE=_text(20),
        DATUMEINDE=_DATE,
        DATUMSTART=_DATE,
        IS_VOOR_BESCHIKKING_ID=_text(),
        VALT_BINNEN_DECLARATIE_ID=_text(),
    ),
    primary_key=("DECLARATIEREGEL_ID",),
    references=(
        Reference(("BETREFT_CLIENT_ID",), "CLIENT", ("RECHTSPERSOON_ID",)),
        Reference(("IS_VOOR_BESCHIKKING_ID",), "BESCHIKKING", ("BESCHIKKING_ID",)),
    ),
)
MEDEWERKER = TableContract(
    "MEDEWERKER",
    _schema(
        MEDEWERKER_ID=_text(),
        ACHTERNAAM=_text(200),
        DATUMINDIENST=_DATE,
        DATUMUITDIENST=_DATE,
        EMAILADRES=_text(),
        EXTERN=_text(),
        FUNCTIE=_text(50),
        GESLACHTSAANDUIDING=_text(),
        MEDEWERKERIDENTIFICATIE=_text(),
        MEDEWERKERTOELICHTING=_text(),
        ROEPNAAM=_text(),
        TELEFOONNUMMER=_text(20),
        VOORLETTERS=_text(20),
        VOORVOEGSELACHTERNAAM=_text(),
    ),
    primary_key=("MEDEWERKER_ID",),
)
WET_ENUM = TableContract(
    "WET_ENUM",
    _schema(WET_ENUM_ID=_text(), VALUE=_text()),
    primary_key=("WET_ENUM_ID",),
    seed=(
        ("1", "ANDERE_WET"),
        ("2", "BIJZONDERE_BIJSTAND"),
        ("3", "I_O_A_W_I_O_A_Z_"),
        ("4", "JEUGDWET"),
        ("5", "LEEG"),
        ("6", "NIET_VAN_TOEPASSING"),
        ("7", "ONBEKEND"),
        ("8", "PARTICIPATIEWET_PW_I"),
        ("9", "WMO"),
    ),
)
# The civil-registry tables take the columns their mappings deliver.
ENUM_GEZINSRELATIE = TableContract(
    "ENUM_GEZINSRELATIE", _schema(ID=_text(), Waarde=_text()), primary_key=("ID",)
)
NATUURLIJKPERSOON = TableContract(
    "NATUURLIJKPERSOON",
    _schema(
        NatuurlijkPersoonId=_LONG,
        BSN=_text(9),
        datumgeboren=_INT,
        datumoverlijden=_INT,
        Enum_GeslachtID=_text(),
        Voornamen=_text(200),
        Voorletters=_text(20),
        Voorvoegselgeslachtsnaam=_text(80),
        Geslachtsnaam=_text(200),
        DWH_IDENTIFICATIE=_text(),
    ),
    primary_key=("NatuurlijkPersoonId",),
)
INGESCHREVENPERSOON = TableContract(
    "INGESCHREVENPERSOON",
    _schema(
        IngeschrevenPersoonId=_LONG,
        A_nummer=_LONG,
        BegindatumVerblijf=_DATE,
        dwon_bgn=_INT,
        EinddatumVerblijf=_DATE,
        dd_opschort_bijhouding=_text(),
        datumvertrekuitnederland=_text(),
        NummeraanduidingID=_text(),
        RedenEindeBewoning=_text(200),
        gezinstrelatieid=_INT,
        gezinsrelatie=_text(),
        locatiebeschrijving=_STRING,
        Reden_Opschort_bijhouding=_text(),
        Hoofdbewoner=_text(3),
        DWH_IDENTIFICATIE=_text(),
    ),
    primary_key=("IngeschrevenPersoonId", "dwon_bgn"),
    references=(
        Reference(("IngeschrevenPersoonId",), "NATUURLIJKPERSOON", ("NatuurlijkPersoonId",)),
    ),
)
VERBLIJFSADRES = TableContract(
    "VERBLIJFSADRESINGESCHREVENPERSOON",
    _schema(
        AdresHerkomst=_text(),
        datumBegin=_DATE,
        datumEinde=_DATE,
        BAGID_adresseerbaarobject=_text(),
        RedenEindeBewoning=_text(200),
        beschrijvingLocatie=_STRING,
        huisnummer=_INT,
        huisletter=_text(10),
        huisnummertoevoeging=_text(10),
        huisnummeraanduiding=_text(50),
        postcode=_text(20),
        straatnaam=_text(),
        plaats=_text(),
        IngeschrevenPersoonId=_text(),
        VerblijfsAdresIngeschrevenPersoonId=_text(),
        DWH_IDENTIFICATIE=_text(),
        DWH_BRON=_text(20),
        DWH_ACTUEEL=_INT,
    ),
    primary_key=("VerblijfsAdresIngeschrevenPersoonId",),
)
HUWELIJK = TableContract(
    "HUWELIJK",
    _schema(
        VolgnummerVerbintenis=_INT,
        rsys_prs=_LONG,
        DatumVerbintenis=_DATE,
        kbst=_text(),
        dovl_gba=_INT,
        DatumOntbinding=_DATE,
        Aktenummer=_text(),
        RedenOntbinding=_text(),
        SoortVerbintenis=_text(),
        Datumgeldigvanaf=_DATE,
        DatumOpname=_DATE,
        IngeschrevenPersoonId_partner=_text(),
        IngeschrevenPersoonId=_text(),
        HuwelijkId=_text(),
        DWH_IDENTIFICATIE=_text(),
    ),
    primary_key=("DWH_IDENTIFICATIE",),
)

CONTRACTS: dict[str, TableContract] = {
    contract.name: contract
    for contract in (
        BESCHIKKING,
        BESCHIKTE_VOORZIENING,
        CLIENT,
        DECLARATIEREGEL,
        MEDEWERKER,
        WET_ENUM,
        ENUM_GEZINSRELATIE,
        NATUURLIJKPERSOON,
        INGESCHREVENPERSOON,
        VERBLIJFSADRES,
        HUWELIJK,
    )
}
