"""Civil-registry mappings against plain SQL on awkward random registers.

One person holds a third of the address history, rows occur several times, some
persons have no name or two, dates are partial, unknown or equal, and two lists
share a person number.
"""

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zilverspoor.checks import mappings as sql
from zilverspoor.checks.compare import compare
from zilverspoor.checks.core import portable
from zilverspoor.plans import Bronze, build

I, S = pa.int32(), pa.string()
COLUMNS = {
    "gba_tbwnhis": {"rsys_prs": I, "rsys_adr": I, "dwon_bgn": I, "dwon_end": I, "kwon_end": S, "rvlg": I},
    "gba_tvbpakt": {"rsys_prs": I, "rsys_adr": I, "dadrh": I, "kigs_gzr": I, "kadrf": S},
    "gba_tprsgeg": {"rsys_prs": I, "ireg": S, "rsys_nam": I, "kgsl": S},
    "gba_tarcgeg": {"rsys_prs": I, "ireg": S, "rsys_nam": I, "kgsl": S},
    "gba_tnamreg": {
        "rsys_nam": I, "radm": I, "rsofi": I, "nvoor": S, "nvlr_gba": S, "nvgsl": S, "ngsl": S, "dgeb_gba": I,
    },
    "gba_tinsgeg": {"rsys_prs": I, "kops": S, "dops": S, "kbst": S, "dtoe_gba": I},
    "gba_tovlakt": {"rsys_prs": I, "dovl_gba": I},
    "gba_tgbaadr": {
        "rsys_adr": I, "nid_nad": I, "nid_vbo": I, "nstr": S, "rhs": I, "nhsr_lt": S, "khsr_tv": S,
        "khsr_ad": S, "kpst_num": I, "kpst_alf": S, "nwpl_nm": S,
    },
    "gba_tselbst": {"rsys_prs": I, "khfd_bew": I},
    "gba_tdomein": {"kode": S, "kveld": S, "oms": S},
    "gba_thuwhis": {
        "rsys_prs": I, "rvlg_hw": I, "rsys_nam": I, "dhw": I, "dhwo": I, "kakt": S, "khwo": S, "ksrt_vrb": S,
        "dgld": I, "dopn": I, "ionj": S,
    },
    "gba_thuwakt": {
        "rsys_prs": I, "rvlg_hw": I, "rsys_nam": I, "dhw": I, "dhwo": I, "kakt": S, "khwo": S, "ksrt_vrb": S,
        "dgld": I, "dopn": I,
    },
}
DAYS = [20200101, 20200102, 20200201, 20200215, 20200301, 20210000, 20210100, 0, 202, None, 19990101]
PARTIAL = [20200000, 20200100, 20200115, 20200015, 20200230, 0, -1, None, 20100505]


def register(seed):
    rnd = random.Random(seed)
    pick = rnd.choice
    persons = range(1, 25)
    stays = [
        (
            7 if rnd.random() < 0.34 else pick([*persons, 99, None]),
            pick([1, 2, 3, 50]),
            pick(DAYS),
            pick([20200101, 20200102, 20200201, 20200301, 20210301, 19990101, None]),
            pick(["W", "V", "F", "Q", None]),
            pick([0, 1, 2, None]),
        )
        for _ in range(300)
    ]
    stays += [pick(stays) for _ in range(60)]  # exact copies

    def marriages(n, with_flag):
        return [
            (
                pick([*persons, 99, None]), pick([0, 1, 2, 10, None]), pick([*range(1, 30), 900]),
                pick(PARTIAL), pick(PARTIAL), pick(["1AH0", "1AB0", "2", None]), pick(["S", "X", None]),
                pick(["H", "P"]), pick([20190101, 20200101, 20200100, None]), pick([20190101, 20200303, 20200300]),
                *([pick([None, None, "J"])] if with_flag else []),
            )
            for _ in range(n)
        ]

    return {
        "gba_tbwnhis": stays,
        "gba_tvbpakt": [
            (p, pick([1, 2, 3]), pick(DAYS), pick([1, 8, 9, None]), pick(["A", "Z", None]))
            for p in persons if p % 5
        ],
        "gba_tprsgeg": [(p, pick("AAB"), p, "M") for p in persons if p % 3]
        + [(p, "A", p + 100, None) for p in (4, 7)],
        "gba_tarcgeg": [(p, pick("AAB"), p, "V") for p in persons if p % 4 == 0],
        "gba_tnamreg": [
            (k, 1000 + k // 2, k * 37, f"n{k}", "n.", None, "x", 19500101) for k in persons if k % 6
        ]
        + [(k, 5000 + k, k, "other", None, "van", "y", None) for k in (2, 5, 104, 107)],
        "gba_tinsgeg": [(p, pick(["E", "M", "F", ".", "R", None]), pick(["20200505", None]), "k", 20010203) for p in persons],
        "gba_tovlakt": [(p, 20200110 + p) for p in persons if p % 4 == 1],
        "gba_tgbaadr": [
            (a, pick([None, a]), pick([None, a]), "Kade", a, pick([None, "A"]), pick([None, "bis"]), None,
             pick([7500, None]), pick(["AB", None]), pick(["Stad", None]))
            for a in (1, 2, 3)
        ],
        "gba_tselbst": [(p, pick([0, 1, None])) for p in persons if p % 2],
        "gba_tdomein": [
            ("A", "KADRF", "aangifte"), ("W", "KWON_END", "wijziging"), ("S", "KHWO", "scheiding"),
            ("OVL", "KHWO", "overlijden"), ("H", "KSRT_VRB", "huwelijk"),
        ],
        "gba_thuwhis": marriages(150, True),
        "gba_thuwakt": marriages(60, False),
    }


@pytest.fixture(scope="module", params=[1, 2, 3])
def registers(request, spark):
    connection, tables = duckdb.connect(), {}
    for name, data in register(request.param).items():
        kinds = COLUMNS[name]
        columns = list(zip(*data))
        arrow = pa.table({c: pa.array(v, k) for (c, k), v in zip(kinds.items(), columns)})
        connection.register(name, arrow)
        tables[name] = spark.createDataFrame(arrow)
    return connection, Bronze(tables, as_of=F.lit(sql.AS_OF))


@pytest.mark.parametrize(
    "target, oracle",
    [
        ("NATUURLIJKPERSOON", sql.PERSONS_SQL),
        ("INGESCHREVENPERSOON", sql.REGISTRATIONS_SQL),
        ("VERBLIJFSADRESINGESCHREVENPERSOON", sql.RESIDENCES_SQL),
        ("HUWELIJK", sql.MARRIAGES_SQL),
    ],
)
def test_mapping(registers, target, oracle):
    connection, bronze = registers
    assert compare(portable(build(target, bronze)), connection, oracle) is None


SIDES = [
    "gba_tgbaadr", "gba_tdomein", "gba_tselbst", "gba_tovlakt", "gba_tinsgeg", "gba_tnamreg",
    "gba_tprsgeg", "gba_tvbpakt", "gba_thuwakt",
]


@pytest.mark.parametrize("side", SIDES)
def test_side_tables_that_are_not_unique(spark, side):
    """Rows of a side table come twice, and once more with other values."""
    tables, connection, frames = register(5), duckdb.connect(), {}
    rows = tables[side] * 2
    if side in ("gba_tgbaadr", "gba_tdomein", "gba_tselbst"):
        rows += [tuple(v if i < 2 and side != "gba_tselbst" or i == 0 else None for i, v in enumerate(r)) for r in tables[side]]
    tables[side] = rows
    for name, data in tables.items():
        kinds = COLUMNS[name]
        arrow = pa.table({c: pa.array(v, k) for (c, k), v in zip(kinds.items(), zip(*data))})
        connection.register(name, arrow)
        frames[name] = spark.createDataFrame(arrow)
    bronze = Bronze(frames, as_of=F.lit(sql.AS_OF))
    for target, oracle in (
        ("INGESCHREVENPERSOON", sql.REGISTRATIONS_SQL),
        ("VERBLIJFSADRESINGESCHREVENPERSOON", sql.RESIDENCES_SQL),
        ("HUWELIJK", sql.MARRIAGES_SQL),
    ):
        assert compare(portable(build(target, bronze)), connection, oracle) is None, target


def test_many_occupants_of_one_person(spark):
    """A person with many occupant rows, and one without a number, in no single window."""
    tables = register(2)
    tables["gba_tselbst"] = [(7, i % 2) for i in range(400)] + tables["gba_tselbst"] + [(None, 1)]
    connection, frames = duckdb.connect(), {}
    for name, data in tables.items():
        arrow = pa.table({c: pa.array(v, k) for (c, k), v in zip(COLUMNS[name].items(), zip(*data))})
        connection.register(name, arrow)
        frames[name] = spark.createDataFrame(arrow)
    bronze = Bronze(frames, as_of=F.lit(sql.AS_OF))
    found = build("INGESCHREVENPERSOON", bronze)
    assert compare(portable(found), connection, sql.REGISTRATIONS_SQL) is None
