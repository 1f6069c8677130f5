import threading
import time
import uuid
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from zilverspoor.contracts import BESCHIKKING, CLIENT, WET_ENUM
from zilverspoor.plans import MAPPINGS, Bronze, build, plan_all
from zilverspoor.plans.registry import source_bytes
from zilverspoor import session
from zilverspoor.session import CLEANED_SHUFFLES, HASHED_PARTITIONS
from zilverspoor.sinks.load import create_silver, key_report, load_silver, reference_report
from zilverspoor.sinks import load, tables
from zilverspoor.sinks.tables import LoadError, TableStore
from zilverspoor.sinks.versions import Version, VersionLog


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"t{uuid.uuid4().hex[:8]}", str(tmp_path))


def people(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id int, name string")


def test_staging_modes(spark, store, rows):
    old = people(spark, (100, "x"), (101, "y"))
    new = people(spark, (1, "a"), (2, "b"), (3, "c"))
    for mode, expected in (("replace", 3), ("append", 5), ("truncate", 3)):
        store.replace(old, mode)
        store.load_staging(new, mode, mode)
        assert store.read(mode).count() == expected
    store.load_staging(new, "fresh", "append")
    assert rows(store.read("fresh")) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(LoadError):
        store.load_staging(new, "fresh", "upsert")


def test_overwrite_may_read_its_own_table(spark, store, rows):
    store.replace(people(spark, (1, "a")), "t")
    store.write(store.read("t").withColumn("id", F.col("id") + 1), "t", "overwrite")
    assert rows(store.read("t")) == [(2, "a")]


def test_upsert(spark, store, rows):
    store.replace(people(spark, (1, "a"), (2, "b")), "t")
    store.write(people(spark, (2, None), (3, "c")), "t", "upsert", key=["id"])
    assert rows(store.read("t")) == [(1, "a"), (2, None), (3, "c")]
    store.write(people(spark), "t", "upsert", key=["id"])
    assert store.read("t").count() == 3


@pytest.mark.parametrize(
    "pairs, key, reason",
    [
        ([(1, "a"), (1, "b")], ["id"], "twice"),
        ([(None, "a")], ["id"], "NULL"),
        ([(1, "a")], [], "primary key"),
    ],
)
def test_upsert_refuses(spark, store, pairs, key, reason):
    store.replace(people(spark, (1, "a")), "t")
    with pytest.raises(LoadError, match=reason):
        store.write(people(spark, *pairs), "t", "upsert", key=key)
    assert store.read("t").count() == 1


def test_insert_by_name(spark, store, rows):
    store.create(CLIENT)
    wrong_case = spark.createDataFrame([("2", "1")], "code string, rechtspersoon_id string")
    store.append(wrong_case, "CLIENT")
    assert rows(store.read("CLIENT").select("RECHTSPERSOON_ID", "CODE", "JURIDISCHESTATUS")) == [
        ("1", "2", None)
    ]
    with pytest.raises(LoadError, match="no column code"):
        store.append(wrong_case, "CLIENT", matching="strict")
    with pytest.raises(LoadError, match="no column other"):
        store.append(spark.range(1).select(F.lit("1").alias("other")), "CLIENT")


def test_lengths_are_checked(spark, store):
    store.create(BESCHIKKING)
    long_code = spark.createDataFrame([("1", "c" * 21)], "BESCHIKKING_ID string, CODE string")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        store.write(long_code, "BESCHIKKING", "overwrite")
    assert store.read("BESCHIKKING").count() == 0


def test_create_seeds_once_and_reset_drops(spark, store):
    create_silver(store, [WET_ENUM])
    create_silver(store, [WET_ENUM])
    assert store.read("WET_ENUM").count() == 9
    create_silver(store, [CLIENT], reset=True)
    assert not store.exists("WET_ENUM") and store.exists("CLIENT")


def bronze(spark, **extra):
    tables = {
        "WVBESL": spark.createDataFrame([(1, 7), (2, 8)], "BESLUITNR int, CLIENTNR int"),
        "szclient": spark.createDataFrame([(7, 1), (9, 0)], "clientnr int, ind_gezag int"),
    }
    return Bronze(tables | extra)


def test_load_skips_what_is_missing(spark, store):
    create_silver(store)
    report = load_silver(bronze(spark), store, ["BESCHIKKING", "CLIENT", "MEDEWERKER"])
    got = {r["target"]: (r["status"], r["reason"]) for r in report.collect()}
    assert got["BESCHIKKING"] == ("loaded", None)
    assert got["MEDEWERKER"] == ("skipped", "table szwerker not found")
    assert store.read("CLIENT").count() == 2
    references = {
        (r["table_name"], r["rule"]): r["bad_rows"]
        for r in reference_report(store, [BESCHIKKING, CLIENT]).collect()
    }
    assert references == {("BESCHIKKING", "CLIENT"): 1}
    keys = key_report(store, [BESCHIKKING, CLIENT]).collect()
    assert [r["bad_values"] for r in keys] == [0, 0]


def test_load_is_all_or_nothing(spark, store):
    create_silver(store)
    load_silver(bronze(spark), store, ["BESCHIKKING", "CLIENT"])
    twice = spark.createDataFrame([(7, 1), (7, 0)], "clientnr int, ind_gezag int")
    decisions = spark.createDataFrame([(3, 7)], "besluitnr int, clientnr int")
    broken = bronze(spark, szclient=twice, wvbesl=decisions)
    with pytest.raises(LoadError, match="CLIENT"):
        load_silver(broken, store, ["BESCHIKKING", "CLIENT"], check_keys=True)
    assert store.read("BESCHIKKING").count() == 2
    assert store.read("CLIENT").count() == 2


def test_publish_goes_back_when_a_table_is_gone(spark, store, rows):
    store.replace(people(spark, (1, "a")), "one")
    store.replace(people(spark, (1, "a")), "two")
    staged = [store.stage(people(spark, (2, "b")), t) for t in ("one", "two")]
    spark.sql(f"DROP TABLE {store.name('two')}")
    with pytest.raises(Exception):
        store.publish(staged)
    assert rows(store.read("one")) == [(1, "a")]


def test_write_modes_per_table(spark, store):
    create_silver(store)
    for _ in range(2):
        load_silver(
            bronze(spark), store, ["BESCHIKKING", "CLIENT"], {"beschikking": "append", "client": "upsert"}
        )
    assert store.read("BESCHIKKING").count() == 4
    assert store.read("CLIENT").count() == 2


def test_plan_all_stops_on_other_errors(spark, monkeypatch):
    spec = MAPPINGS["CLIENT"]
    broken = type(spec)(spec.target, spec.requires, lambda src: src.szclient.select("nope"))
    monkeypatch.setitem(MAPPINGS, "CLIENT", broken)
    with pytest.raises(Exception, match="nope"):
        plan_all(bronze(spark), ["CLIENT"])


def test_row_limit_and_label_case(spark):
    frame = build("CLIENT", bronze(spark), row_limit=1, label_case="lower")
    assert frame.columns[0] == "rechtspersoon_id" and frame.count() == 1


def test_a_failing_step_undoes_all_others(spark, store, rows, monkeypatch):
    """Whatever mode comes before it: appended rows go, replaced tables come back."""
    for table in ("a", "b", "c"):
        store.replace(people(spark, (1, "old")), table)
    new = people(spark, (2, "new"))
    staged = [
        store.stage(new, "a", "append"),
        store.stage(new, "b", "overwrite"),
        store.stage(new, "c", "upsert", ["id"]),
    ]
    point = store._point

    def broken(table, path):
        if table == "c":
            raise RuntimeError("no")
        point(table, path)

    monkeypatch.setattr(store, "_point", broken)
    with pytest.raises(RuntimeError):
        store.publish(staged)
    for table in ("a", "b", "c"):
        assert rows(store.read(table)) == [(1, "old")]
    monkeypatch.setattr(store, "_point", point)
    store.publish(staged)
    assert rows(store.read("a")) == [(1, "old"), (2, "new")]
    assert rows(store.read("b")) == [(2, "new")]
    assert rows(store.read("c")) == [(1, "old"), (2, "new")]


def test_two_upserts_from_one_version(spark, store, rows):
    store.replace(people(spark, (1, "a")), "t")
    one = store.stage(people(spark, (2, "b")), "t", "upsert", ["id"])
    two = store.stage(people(spark, (3, "c")), "t", "upsert", ["id"])
    store.publish([one])
    with pytest.raises(LoadError, match="changed"):
        store.publish([two])
    assert rows(store.read("t")) == [(1, "a"), (2, "b")]


def test_replace_never_leaves_the_table_out(spark, store, rows, monkeypatch):
    store.replace(people(spark, (1, "a")), "t")
    dropped = []
    sql = spark.sql
    monkeypatch.setattr(spark, "sql", lambda q, *a: dropped.append(q) or sql(q, *a))
    store.replace(people(spark, (2, "b")), "t")
    assert not any(q.startswith("DROP") for q in dropped)
    store.replace(spark.createDataFrame([(5,)], "other long"), "t")
    assert rows(store.read("t")) == [(5,)]


def test_a_column_named_location(spark, store):
    store.replace(spark.createDataFrame([("x",)], "Location string"), "t")
    assert "/t/" in store.location("t")
    store.write(spark.createDataFrame([("y",)], "Location string"), "t", "append")
    assert store.read("t").count() == 2


def test_rows_that_do_not_fit(spark, store):
    create_silver(store)
    rows = [("1", "fits"), ("2", "x" * 300), (None, "no key")]
    laws = spark.createDataFrame(rows, "kode_regeling string, omschryving string")
    source = bronze(spark, szregel=laws)
    with pytest.raises(LoadError, match="length:VALUE"):
        load_silver(source, store, ["WET_ENUM", "CLIENT"], strict=True)
    assert store.read("CLIENT").count() == 0 and not store.exists("REJECTED")
    for runs in (1, 2):
        load_silver(source, store, ["WET_ENUM", "CLIENT"])
        good = sorted(str(r["WET_ENUM_ID"]) for r in store.read("WET_ENUM").collect())
        assert good == ["1", "None"]  # keys are checked elsewhere
        assert store.read("CLIENT").count() == 2
        bad = store.read("REJECTED").collect()
        assert len(bad) == runs and {r["target"] for r in bad} == {"WET_ENUM"}
        assert {p for r in bad for p in r["problems"]} == {"length:VALUE"}


def files_of(store, table):
    """The files that make up a table, by its folders in the log."""
    version = store.version(table)
    return {
        name: sorted(f for f in store.read(table).inputFiles() if f"/{name}/" in f)
        for name in version.names()
    }


def numbers(spark, ids, name="x"):
    return spark.createDataFrame([(i, name) for i in ids], "id int, name string")


def test_upsert_leaves_other_buckets_alone(spark, store, rows):
    store.replace(numbers(spark, range(500)), "t")
    store.write(numbers(spark, [0], "first"), "t", "upsert", key=["id"])  # deals the table out
    before, old = files_of(store, "t"), store.version("t")
    assert old.buckets == 16 and len(old.folders) == 16 and not old.loose
    staged = store.stage(numbers(spark, [7, 1000], "new"), "t", "upsert", ["id"])
    store.publish([staged])
    after, now = files_of(store, "t"), store.version("t")
    touched = {b for b in now.folders if now.folders[b] != old.folders[b]}
    assert touched == set(staged.folders) and 1 <= len(touched) <= 2
    for bucket, (name, size) in old.folders.items():
        assert size > 0 and (bucket in touched or after[name] == before[name] != [])
    assert staged.read_rows < 150
    got = dict(rows(store.read("t")))
    assert len(got) == 501 and got[7] == got[1000] == "new" and got[0] == "first" and got[8] == "x"


def test_two_writers_of_different_buckets(spark, store, rows):
    store.replace(numbers(spark, range(100)), "t")
    store.write(numbers(spark, [0], "a"), "t", "upsert", key=["id"])
    stage = lambda i, name: store.stage(numbers(spark, [i], name), "t", "upsert", ["id"])
    one = stage(1, "one")
    bucket = lambda item: set(item.folders)
    two = next(s for i in range(2, 100) if bucket(s := stage(i, "two")) != bucket(one))
    same = next(s for i in range(1, 100) if bucket(s := stage(i, "no")) == bucket(one))
    store.publish([one])
    store.publish([two])  # made from the same version, but of other buckets
    with pytest.raises(LoadError, match="changed"):
        store.publish([same])
    names = [n for _, n in rows(store.read("t"))]
    assert len(names) == 100 and {"one", "two"} <= set(names) and "no" not in names


def test_appends_between_upserts(spark, store, rows):
    """Appended rows stay in folders of their own until an upsert deals them out."""
    store.replace(numbers(spark, range(50)), "t")
    store.write(numbers(spark, [1], "one"), "t", "upsert", key=["id"])
    staged = store.stage(numbers(spark, [2], "two"), "t", "upsert", ["id"])
    store.append(numbers(spark, [60], "later"), "t")
    assert len(store.version("t").loose) == 1
    store.publish([staged])  # was staged before the append, which stays
    assert len(store.version("t").loose) == 1 and store.read("t").count() == 51
    store.write(numbers(spark, [60, 61], "sixty"), "t", "upsert", key=["id"])
    assert not store.version("t").loose
    got = dict(rows(store.read("t")))
    assert len(got) == 52 and got[60] == got[61] == "sixty" and got[1] == "one" and got[2] == "two"
    store.write(numbers(spark, [5]), "t", "overwrite")
    assert store.version("t").buckets == 0 and rows(store.read("t")) == [(5, "x")]


def test_another_key_and_a_grown_table_are_dealt_anew(spark, store, rows, monkeypatch):
    store.replace(numbers(spark, range(40)), "t")
    store.write(numbers(spark, [1], "one"), "t", "upsert", key=["id"])
    store.write(spark.createDataFrame([(1, "one"), (99, "x")], "id int, name string"), "t", "upsert", key=["name", "id"])
    assert store.version("t").key == ["name", "id"] and store.read("t").count() == 41
    monkeypatch.setattr(tables, "BUCKET_BYTES", 64)
    staged = store.stage(numbers(spark, [70]), "t", "upsert", ["name", "id"])
    assert staged.buckets > 16 and staged.read_rows == 41
    store.publish([staged])
    assert store.version("t").buckets == staged.buckets and store.read("t").count() == 42


def test_many_appends_are_folded(spark, store, monkeypatch):
    monkeypatch.setattr(tables, "LOOSE_FOLDERS", 4)
    store.replace(numbers(spark, range(3)), "t")
    for i in range(12):
        store.append(numbers(spark, [100 + i]), "t")
    assert len(store.version("t").loose) <= 4
    assert store.read("t").count() == 15 == store.read("t").distinct().count()


def test_repeated_stored_rows_stay(spark, store, rows):
    """An upsert replaces rows of its keys; what else was appended twice stays twice."""
    store.replace(numbers(spark, [1, 1, 2, 2]), "t")
    store.write(numbers(spark, [2], "two"), "t", "upsert", key=["id"])
    assert rows(store.read("t")) == [(1, "x"), (1, "x"), (2, "two")]


class Ended(BaseException):
    """The driver goes away: nothing after this runs, no undo either."""


def loaded(spark, store):
    for table in ("a", "b", "c"):
        store.replace(people(spark, (1, "old")), table)
    store.write(people(spark, (1, "old")), "c", "upsert", key=["id"])
    new = people(spark, (2, "new"))
    return [
        store.stage(new, "a", "append"),
        store.stage(new, "b", "overwrite"),
        store.stage(new, "c", "upsert", ["id"]),
    ]


OLD = {"a": [(1, "old")], "b": [(1, "old")], "c": [(1, "old")]}
NEW = {"a": [(1, "old"), (2, "new")], "b": [(2, "new")], "c": [(1, "old"), (2, "new")]}


@pytest.mark.parametrize("step", ["draft", "claimed", "a", "b", "c", "pointed c"])
def test_a_publish_that_ends_anywhere_is_all_or_nothing(spark, store, rows, monkeypatch, step):
    staged = loaded(spark, store)
    claim, point = store.log._claim, store._point

    def ends_at_claim(draft, target):
        if step == "draft":
            raise Ended
        claim(draft, target)
        raise Ended

    def ends_at_point(table, path):
        if table == step:
            raise Ended
        point(table, path)
        if f"pointed {table}" == step:
            raise Ended

    if step in ("draft", "claimed"):
        monkeypatch.setattr(store.log, "_claim", ends_at_claim)
    monkeypatch.setattr(store, "_point", ends_at_point)
    with pytest.raises(Ended):
        store.publish(staged)
    again = TableStore(spark, store.database, store.root)  # the next run
    want = OLD if step == "draft" else NEW
    assert {t: rows(again.read(t)) for t in want} == want
    assert again.recover() == []
    # and the next load goes on from there
    again.append(people(spark, (9, "next")), "a")
    assert rows(again.read("a")) == [*want["a"], (9, "next")]


@pytest.mark.parametrize("step", ["CREATE TABLE", "RENAME TO `{}`.`t__old", "RENAME TO `{}`.`t`", "DROP TABLE"])
@pytest.mark.parametrize("done", [False, True])
def test_a_replace_with_other_columns_that_ends(spark, store, rows, monkeypatch, step, done):
    store.replace(people(spark, (1, "a")), "t")
    sql, step = spark.sql, step.format(store.database)

    def ends(query, *more):
        if step in query:
            if done:
                sql(query, *more)
            raise Ended
        return sql(query, *more)

    monkeypatch.setattr(spark, "sql", ends)
    with pytest.raises(Ended):
        store.replace(spark.createDataFrame([(5,)], "other long"), "t")
    monkeypatch.setattr(spark, "sql", sql)
    again = TableStore(spark, store.database, store.root)
    assert rows(again.read("t")) == [(5,)]
    again.replace(people(spark, (2, "b")), "t")
    assert rows(again.read("t")) == [(2, "b")]


def test_a_dropped_table_stays_out(spark, store):
    store.replace(people(spark, (1, "a")), "t")
    spark.sql(f"DROP TABLE {store.name('t')}")
    assert TableStore(spark, store.database, store.root).recover() == [] and not store.exists("t")


def test_two_publishes_at_once(spark, store, rows):
    """Both want the same number; the second sees the first one's table and takes the next."""
    store.replace(people(spark, (1, "a")), "t")
    store.replace(people(spark, (1, "a")), "u")
    other = TableStore(spark, store.database, store.root)
    one, two = (s.stage(people(spark, (2, "b")), t, "append") for s, t in ((store, "t"), (other, "u")))
    three = other.stage(people(spark, (3, "c")), "t", "append")
    add, raced = store.log.add, []

    def late(number, versions):
        if not raced:
            raced.append(number)
            other.publish([two, three])
        return add(number, versions)

    store.log.add = late
    store.publish([one])
    assert rows(other.read("t")) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(other.read("u")) == [(1, "a"), (2, "b")]


def test_the_log_gives_a_number_once(spark, tmp_path):
    for kind in ("_link", "_rename"):
        log = VersionLog(spark, str(tmp_path / kind))
        log._claim = getattr(log, kind)
        one, two = (Version(c, {"x": 1}, ["id"], 2, {"0": ["y", 5]}) for c in ("a int", "b int"))
        assert log.read() == (0, {})
        assert log.add(1, {"t": one}) and not log.add(1, {"t": two}) and log.add(2, {"t": two})
        assert log.read() == (2, {"t": two})


def test_a_table_from_before_the_log(spark, store, rows):
    path = store._folder("t", "first")
    people(spark, (1, "a")).write.parquet(path)
    store._define("t", "id int, name string", path)
    store.write(people(spark, (2, "b")), "t", "append")
    store.write(people(spark, (1, "c")), "t", "upsert", key=["id"])
    assert rows(store.read("t")) == [(1, "c"), (2, "b")]


def test_a_load_hashes_small_partitions_of_shuffled_sides(spark, store, monkeypatch):
    key, small = HASHED_PARTITIONS[0], "spark.sql.autoBroadcastJoinThreshold"
    before, seen = {k: spark.conf.get(k) for k in (key, small)}, []

    def planned(*args):
        left = spark.range(3000).selectExpr("id", "id % 7 as a")
        joined = left.join(spark.range(3000).selectExpr("id", "id % 5 as b"), "id", "left")
        assert joined.where("b = a").count() == 430
        joined.collect()
        seen.append(joined._jdf.queryExecution().executedPlan().toString())
        return plan_all(*args)

    monkeypatch.setattr(load, "plan_all", planned)
    create_silver(store)
    spark.conf.set(small, "-1")
    try:
        load_silver(bronze(spark), store, ["CLIENT"])
        assert "ShuffledHashJoin" in seen[0].split("Initial Plan")[0]
        monkeypatch.setattr(load, "plan_all", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_silver(bronze(spark), store, ["CLIENT"])
        assert spark.conf.get(key) == before[key]  # after an error too
    finally:
        spark.conf.set(small, before[small])


def test_a_load_leaves_no_shuffle_files(spark, store):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    create_silver(store)
    source = spark.createDataFrame([(i, i % 7, "x") for i in range(500)], "besluitnr int, volgnr_ind int, kode_reden_einde_voorz string")
    tables = {
        "wvind_b": source.selectExpr("*", "1 as clientnr"),
        "wvdos": source.selectExpr("*", "besluitnr as uniek").repartition(4),
        "szukhis": source.selectExpr("besluitnr as uniekwvdos", "1.5 as bedrag", "2 as verslagnr").repartition(4),
    }
    before, seen = shuffled(), spark.conf.get(CLEANED_SHUFFLES[0])
    load_silver(Bronze(tables), store, ["DECLARATIEREGEL"])
    for _ in range(50):  # they go without being waited for
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert spark.conf.get(CLEANED_SHUFFLES[0]) == seen
    assert store.read("DECLARATIEREGEL").count() == 500


def test_only_small_actions_run_beside_a_large_one(spark, monkeypatch):
    monkeypatch.setattr(session, "small_bytes", lambda spark: 10)
    lock, now, beside, order = threading.Lock(), set(), {}, []

    def action(i):
        with lock:
            now.add(i)
            order.append(i)
            for j in now:
                beside[j] = beside.get(j, set()) | now - {j}
        time.sleep(0.3)
        with lock:
            now.remove(i)
        return i * i

    weights = [3, 100, 4, 80, 5]
    actions = [partial(action, i) for i in range(5)]
    assert session.together(spark, actions, 4, weights) == [0, 1, 4, 9, 16]
    assert order[0] == 1 and 3 not in beside[1]
    assert beside[1] and sum(weights[i] for i in beside[1]) <= 12  # some side by side, some later
    order.clear()
    assert session.together(spark, actions, 2) == [0, 1, 4, 9, 16]
    assert sorted(order[:2]) == [0, 1]

    def broken():
        raise ValueError("broken")

    order.clear()
    with pytest.raises(ValueError, match="broken"):
        session.together(spark, [broken, *actions], 1)
    assert order == []


def test_the_weight_of_a_mapping_is_what_it_reads(spark, tmp_path):
    frame = spark.range(1000).selectExpr("id as besluitnr", "id as clientnr", "uuid() as other")
    frame.write.parquet(f"{tmp_path}/one")
    size = sum(f.stat().st_size for f in tmp_path.glob("one/*.parquet"))
    source = Bronze({"wvbesl": spark.read.parquet(f"{tmp_path}/one")})
    assert 0 < source_bytes("BESCHIKKING", source) < size
    assert source_bytes("CLIENT", source) == 0  # will be skipped


def test_a_load_drops_its_working_folders(spark, store):
    create_silver(store)
    shared = Path(session.shared_dir(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    tables = {
        "wvind_b": spark.sql("select '1' as besluitnr, '01' as volgnr_ind, cast(null as timestamp_ntz) as dd_begin, cast(null as timestamp_ntz) as dd_eind, 1 as volume, repeat('x', id * 60) as status_indicatie, 4 as kode_regeling from range(2)"),
        "szregel": spark.sql("select 4 as kode_regeling, 'WMO' as omschryving"),
        "wvbesl": spark.sql("select '1' as besluitnr"),
        "wvdos": spark.sql("select '1' as besluitnr, '01' as volgnr_ind, 'x' as kode_reden_einde_voorz from range(3)"),
        "abc_refcod": spark.sql("select 'x' as code, 'WVRTEIND' as domein"),
    }
    load_silver(Bronze(tables), store, ["BESCHIKTE_VOORZIENING"])
    assert store.read("BESCHIKTE_VOORZIENING").count() == 3
    assert store.read(load.REJECTED).count() == 3  # the text that is too long, read once more
    assert set(shared.iterdir()) == before


def test_files_of_tables_take_little_room(spark, store, tmp_path):
    store.replace(people(spark, (1, "a"), (2, "b")), "t")
    store.write(people(spark, (3, "c")), "t", "append")
    store.write(people(spark, (2, "x"), (4, "d")), "t", "upsert", key=["id"])
    store.create(CLIENT)
    store.write(spark.createDataFrame([("7",)], "RECHTSPERSOON_ID string"), "CLIENT", "overwrite")
    written = [f.name for f in tmp_path.rglob("part-*.parquet")]
    assert len(written) > 3 and all(f.endswith(".zstd.parquet") for f in written)
