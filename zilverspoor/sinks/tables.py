"""Tables as sets of folders: a write fills new folders, then one step makes them the table's.

A Parquet table cannot be merged into, and overwriting what a query reads is refused. So a write
first fills a folder through a table of its own with the target's definition, which lets Spark check
lengths and types. Which folders make up the tables stands in a log (``versions``), and a publish of
any number of tables is the creation of its next file. After that the catalog's tables are pointed
to their folders, by one ALTER TABLE each; a location may name several folders. A run that ends in
between leaves that to the next one, which brings the catalog up to the log when it starts. So all
tables of a load change, or none does.

An upsert deals the table into buckets by a hash of its key, at first all of it. From then on it
reads and writes only buckets that get rows; the others keep their folders, and writers of different
buckets don't disturb each other. Appended rows stand in folders of their own until an upsert deals
them out. Tables must be written through a store: other writers don't know about its log.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.contracts import TableContract
from zilverspoor.operators.columns import typed_null
from zilverspoor.operators.history import latest_rows
from zilverspoor.session import COMPRESSION
from zilverspoor.sinks.versions import Version, VersionLog

MODES = ("append", "overwrite", "truncate", "upsert")
#: A bucket is meant to have this many bytes, a file of it this many.
BUCKET_BYTES, FILE_BYTES = 256 << 20, 128 << 20
#: The names of all folders stand in the table's location, which some catalogs keep short.
LEAST_BUCKETS, MOST_BUCKETS = 16, 256
#: From this many folders of appended rows on, an append takes the smaller half into its own.
LOOSE_FOLDERS = 32


class LoadError(ValueError):
    """The rows cannot be written to the table as asked."""


@dataclass(frozen=True)
class Staged:
    """Rows that are written but not yet visible in their table."""

    table: str
    mode: str
    path: str  # the rows that came in
    base: Version  # the table when the rows were made
    loose: dict[str, int] = field(default_factory=dict)
    gone: list[str] = field(default_factory=list)  # loose folders whose rows were taken over
    key: list[str] = field(default_factory=list)
    buckets: int = 0
    folders: dict[str, list] = field(default_factory=dict)
    read_rows: int = 0  # of the table, to write its buckets anew

    def on(self, now: Version) -> Version:
        """The table with these rows, if what they were made from is still there."""
        if self.mode in ("overwrite", "truncate"):
            return Version(now.columns, self.loose)
        fits = all(name in now.loose for name in self.gone)
        if self.mode == "append":
            after = now.with_loose(self.loose, self.gone)
        elif (self.key, self.buckets) == (self.base.key, self.base.buckets):
            fits &= (now.key, now.buckets) == (self.key, self.buckets)
            fits &= all(now.folders.get(b) == self.base.folders.get(b) for b in self.folders)
            folders = now.folders | self.folders
            after = replace(now.with_loose({}, self.gone), folders=folders)
        else:  # dealt anew
            fits &= now.folders == self.base.folders and now.buckets == self.base.buckets
            fits &= self.base.size > 0 or now.size == 0
            after = replace(
                now.with_loose({}, self.gone), key=self.key, buckets=self.buckets, folders=self.folders
            )
        if not fits:
            raise LoadError(f"{self.table} has changed since its rows were staged")
        return after if after.names() else replace(after, loose=now.loose)


class TableStore:
    """Parquet tables of one database under one root folder."""

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark = spark
        self.database = database
        self.root = root.rstrip("/")
        self.log = VersionLog(spark, f"{self.root}/_log")
        self._create_database()
        self.recover()

    def _create_database(self) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}/database'"
        )

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def location(self, table: str) -> str:
        found = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)} AS JSON").first()[0]
        return json.loads(found)["location"]

    def _folder(self, table: str, name: str) -> str:
        return f"{self.root}/{table.lower()}/{name}"

    # -- versions -----------------------------------------------------------------

    def version(self, table: str) -> Version:
        """The folders that make up a table."""
        return self._version(self.log.read()[1], table)

    def _version(self, versions: dict[str, Version], table: str) -> Version:
        if table.lower() in versions:
            return versions[table.lower()]
        # a table from before there was a log is the folder that it points to
        inside = self.log.qualified(self._folder(table, "")) + "/"
        at = self.log.qualified(self.location(table))
        if not at.startswith(inside):
            raise LoadError(f"{table} stands in {at}, outside of the store")
        return Version(_columns(self.read(table)), {at.removeprefix(inside): self.log.size(at)})

    def _change(
        self, change: Callable[[dict[str, Version]], dict[str, Version]]
    ) -> tuple[dict[str, Version], dict[str, Version]]:
        """Add the tables as ``change`` makes them to the log; gives them before and after.

        If somebody else has changed any table meanwhile, ``change`` is asked again.
        """
        while True:
            number, before = self.log.read()
            after = change(before)
            if self.log.add(number + 1, after):
                return before, after

    def _target(self, table: str, version: Version) -> str:
        names = version.names()
        return self._folder(table, names[0] if len(names) == 1 else "{" + ",".join(names) + "}")

    def _show(self, table: str, version: Version) -> None:
        """Let the catalog's table have a version's columns and folders."""
        target = self._target(table, version)
        if not self.exists(table):
            self._define(table, version.columns, target)
        elif _plain(version.columns) != _columns(self.read(table)):
            self._redefine(table, version.columns, target)
        else:
            self._point(table, target)

    def recover(self) -> list[str]:
        """Bring the catalog up to the log, and give the tables that were behind.

        A table that is not in the catalog stays out of it, as it may have been dropped, unless its
        definition was just being exchanged: then it stands there under other names.
        """
        behind = []
        for table, version in self.log.read()[1].items():
            if not self.exists(table):
                if others := self._exchanged(table):
                    self._show(table, version)
                    behind.append(table)
                for other in others:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.name(other)}")
                continue
            shown = self.log.qualified(self.location(table))
            if shown != self.log.qualified(self._target(table, version)) or _plain(
                version.columns
            ) != _columns(self.read(table)):
                self._show(table, version)
                behind.append(table)
        return behind

    def reset(self) -> None:
        """Drop the database with its table definitions and create it empty."""
        self._change(lambda versions: {})
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
        self._create_database()

    def create(self, contract: TableContract) -> None:
        """Create a contract's table when missing, with its seed rows."""
        if self.exists(contract.name):
            return
        empty = Version(contract.ddl_columns(), {_new_name(): 0})
        self._change(lambda versions: versions | {contract.name.lower(): empty})
        self._define(contract.name, empty.columns, self._target(contract.name, empty))
        if contract.seed:
            names = [f.name for f in contract.schema]
            self.append(self.spark.createDataFrame(list(contract.seed), names), contract.name)

    def _define(self, table: str, columns: str, path: str) -> None:
        self.spark.sql(
            f"CREATE TABLE {self.name(table)} ({columns}) USING parquet "
            f"OPTIONS (recursiveFileLookup 'true', compression '{COMPRESSION}') LOCATION '{path}'"
        )

    def _redefine(self, table: str, columns: str, path: str) -> None:
        """The new definition takes the old one's name, and the old one comes back if it cannot."""
        twin, old = f"{table}__new_{_new_name()}", f"{table}__old_{_new_name()}"
        self._define(twin, columns, path)
        self.spark.sql(f"ALTER TABLE {self.name(table)} RENAME TO {self.name(old)}")
        try:
            self.spark.sql(f"ALTER TABLE {self.name(twin)} RENAME TO {self.name(table)}")
        except Exception:
            self.spark.sql(f"ALTER TABLE {self.name(old)} RENAME TO {self.name(table)}")
            raise
        self.spark.sql(f"DROP TABLE {self.name(old)}")

    def _exchanged(self, table: str) -> list[str]:
        """The names that a table has while its definition is exchanged."""
        found = self.spark.sql(f"SHOW TABLES IN `{self.database}`").select("tableName").collect()
        return [r[0] for r in found if re.fullmatch(rf"{re.escape(table)}__(new|old)_\w+", r[0])]

    def _point(self, table: str, path: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(self.name(table))

    def align(self, df: DataFrame, table: str, matching: str = "auto") -> DataFrame:
        """Columns in the table's order, matched by name; unlisted ones are NULL.

        A label is matched exactly, or in any case unless ``matching`` is
        ``strict``. A label the table does not have is an error.
        """
        target = self.read(table).schema
        columns = {f.name: f for f in target}
        any_case = {f.name.lower(): f for f in target}
        source = {}
        for label in df.columns:
            found = columns.get(label)
            if found is None and matching != "strict":
                found = any_case.get(label.lower())
            if found is None:
                raise LoadError(f"{table} has no column {label}; it has {sorted(columns)}")
            if found.name in source:
                raise LoadError(f"two columns for {table}.{found.name}")
            source[found.name] = label
        return df.select(
            *[
                F.col(f"`{source[f.name]}`").alias(f.name)
                if f.name in source
                else typed_null(f.dataType.simpleString()).alias(f.name)
                for f in target
            ]
        )

    # -- replace: the definition follows the rows ---------------------------------

    def replace(self, df: DataFrame, table: str) -> None:
        """The table with the columns and rows of the incoming frame.

        With the same columns as before the table only points to another folder.
        """
        name = _new_name()
        df.write.option("compression", COMPRESSION).parquet(self._folder(table, name))
        columns = _columns(df)
        if self.exists(table) and _columns(self.read(table)) == columns:
            columns = self.version(table).columns  # lengths stay
        version = Version(columns, {name: self.log.size(self._folder(table, name))})
        self._change(lambda versions: versions | {table.lower(): version})
        self._show(table, version)

    def load_staging(self, df: DataFrame, table: str, mode: str) -> None:
        """Staging write modes: replace, truncate or append; all create a missing table."""
        if mode not in ("replace", "truncate", "append"):
            raise LoadError(f"unsupported staging write mode {mode}")
        if mode == "replace" or not self.exists(table):
            self.replace(df, table)
        else:
            self.write(df, table, mode)

    # -- the definition stays -----------------------------------------------------

    def append(self, df: DataFrame, table: str, matching: str = "auto") -> None:
        self.publish([self.stage(df, table, "append", matching=matching)])

    def stage(
        self,
        df: DataFrame,
        table: str,
        mode: str = "overwrite",
        key: Sequence[str] = (),
        matching: str = "auto",
        newest_by: str | None = None,
    ) -> Staged:
        """Write the rows aside; ``publish`` makes them visible.

        An upsert with ``newest_by`` lets a stored row stay that has a later version.
        """
        if mode not in MODES:
            raise LoadError(f"unsupported write mode {mode}")
        if mode == "upsert" and not key:
            raise LoadError(f"upsert into {table} needs a primary key")
        rows = self.align(df, table, matching)
        base, gone = self.version(table), []
        if mode == "append" and len(base.loose) >= LOOSE_FOLDERS:
            gone = sorted(base.loose, key=base.loose.__getitem__)[: LOOSE_FOLDERS // 2]
            rows = rows.unionByName(self._rows(table, gone))
        name = _new_name()
        path = self._folder(table, name)
        self._insert(rows, table, path)
        if mode == "upsert":
            return self._upsert(table, path, base, list(key), newest_by)
        return Staged(table, mode, path, base, {name: self.log.size(path)}, gone)

    def _insert(self, rows: DataFrame, table: str, path: str) -> None:
        """Write rows as the table would take them: lengths and types are checked."""
        twin = f"{table}__{_new_name()}"
        self.spark.sql(f"CREATE TABLE {self.name(twin)} LIKE {self.name(table)} LOCATION '{path}'")
        try:
            rows.write.insertInto(self.name(twin))
        finally:
            self.spark.sql(f"DROP TABLE {self.name(twin)}")

    def _rows(self, table: str, names: Sequence[str]) -> DataFrame:
        """The rows of some of a table's folders."""
        found = self.spark.read.schema(self.read(table).schema).option("recursiveFileLookup", "true")
        return found.parquet(*[self._folder(table, n) for n in names])

    def _upsert(
        self, table: str, path: str, base: Version, key: list[str], newest_by: str | None
    ) -> Staged:
        """Write anew the buckets that get rows: theirs without those that come in, and these."""
        rows = self.spark.read.schema(self.read(table).schema).parquet(path)
        some_null = reduce(Column.__or__, [F.col(k).isNull() for k in key])
        counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        found = counted.agg(F.max("n").alias("n"), F.max(some_null).alias("null")).first()
        if found["null"]:
            raise LoadError(f"upsert into {table}: a key is NULL")
        if (found["n"] or 0) > 1:
            raise LoadError(f"upsert into {table}: a key comes in twice")
        buckets, anew = base.buckets, base.key != key
        wanted = _bucket_count(base.size)
        if anew or wanted >= 4 * buckets:
            buckets, anew = wanted, True
        bucket = _free("bucket", rows.columns)
        number = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
        loose = [name for name, size in base.loose.items() if size]
        coming = rows.unionByName(self._rows(table, loose)) if loose else rows
        touched = [str(r[0]) for r in coming.select(number).distinct().collect()]
        old = [n for b, (n, _) in base.folders.items() if anew or b in touched]
        staged = Staged(table, "upsert", path, base, {}, loose, key, buckets)
        if not (touched or old):
            return staged
        written, seen = rows, Observation()
        if old or loose:
            stored = self._rows(table, [*old, *loose]).observe(seen, F.count(F.lit(1)).alias("n"))
            if newest_by:
                written = latest_rows(stored.unionByName(rows), key, newest_by)
            else:
                written = stored.join(rows.select(*key), key, "left_anti").select(*rows.columns)
                written = written.unionByName(rows)
        largest = max((s for b, (_, s) in base.folders.items() if b in touched), default=0)
        slots = 1 + max(largest, base.size // buckets if anew else 0) // FILE_BYTES
        slot = F.pmod(F.xxhash64(F.lit("slot"), *key), F.lit(slots))
        name = _new_name()
        out = self._folder(table, name)
        written = written.withColumn(bucket, number).repartition(F.col(bucket), slot)
        written.write.option("compression", COMPRESSION).partitionBy(bucket).parquet(out)
        parts = {b: f"{name}/{bucket}={b}" for b in map(str, range(buckets))}
        sizes = {b: self.log.size(self._folder(table, part)) for b, part in parts.items()}
        folders = {b: [parts[b], size] for b, size in sizes.items() if size}
        read_rows = seen.get["n"] if old or loose else 0
        return replace(staged, folders=folders, read_rows=read_rows)

    def publish(self, staged: Sequence[Staged]) -> None:
        """Make staged rows visible in all their tables by one entry in the log.

        Rows made from what is no longer in their table are refused, and no table changes. If the
        catalog then fails, another entry brings all of the tables back.
        """
        for item in staged:
            if not self.exists(item.table):
                raise LoadError(f"{item.table} is gone")

        def with_staged(versions: dict[str, Version]) -> dict[str, Version]:
            after = dict(versions)
            for item in staged:
                after[item.table.lower()] = item.on(self._version(after, item.table))
            return after

        tables = list(dict.fromkeys(item.table.lower() for item in staged))
        first = {item.table.lower(): item.base for item in staged}  # where the log has no entry yet
        before, after = self._change(with_staged)
        try:
            for table in tables:  # definitions stay
                self._point(table, self._target(table, after[table]))
        except Exception as error:
            self._take_back(tables, first | before, after, error)
            raise
        for item in staged:
            if item.mode == "upsert":  # its rows stand in the buckets now
                self.log.remove(item.path)

    def _take_back(
        self,
        tables: Sequence[str],
        before: dict[str, Version],
        after: dict[str, Version],
        error: Exception,
    ) -> None:
        """Tables as they were, unless somebody else has changed them since."""

        def undone(versions: dict[str, Version]) -> dict[str, Version]:
            same = [t for t in tables if versions.get(t) == after[t]]
            return versions | {t: before[t] for t in same}

        _, now = self._change(undone)
        for table in tables:
            try:
                self._show(table, now[table])
            except Exception as other:  # the other tables go back all the same
                error.add_note(f"while undoing: {other}")

    def write(
        self,
        df: DataFrame,
        table: str,
        mode: str = "overwrite",
        key: Sequence[str] = (),
        matching: str = "auto",
        newest_by: str | None = None,
    ) -> None:
        """One table, one write mode; the table's definition is kept."""
        self.publish([self.stage(df, table, mode, key, matching, newest_by)])


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _plain(columns: str) -> str:
    """Column definitions as a table that is read shows them: texts of any length are strings."""
    texts = (T.CharType, T.VarcharType)
    return ", ".join(
        f"`{f.name}` {'string' if isinstance(f.dataType, texts) else f.dataType.simpleString()}"
        for f in T.StructType.fromDDL(columns)
    )


def _new_name() -> str:
    return uuid.uuid4().hex[:10]


def _free(stem: str, columns: Sequence[str]) -> str:
    taken = {c.lower() for c in columns}
    while stem in taken:
        stem += "_"
    return stem


def _bucket_count(size: int) -> int:
    """A power of two, so that a bucket has about the bytes it is meant to have."""
    wanted = 1 << (size // BUCKET_BYTES).bit_length()
    return min(max(wanted, LEAST_BUCKETS), MOST_BUCKETS)
