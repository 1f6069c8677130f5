"""Which folders make up the tables of a store: a log of numbered files, the last one counts.

A publish of any number of tables is the creation of the next file, which either succeeds as a whole
or finds that somebody else has taken the number. So it is the single step at which all tables of a
load change, and a writer that lost the race sees what the other one did before it tries again.

The folder needs a file system whose rename refuses an existing target in one step, as HDFS does; on
a mounted folder a hard link stands in for it.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Version:
    """The folders of a table, below the folder of that name, with their bytes.

    A bucketed table has a folder for each bucket of its key, and rows that were appended since in
    loose folders; any other table has loose folders only.
    """

    columns: str
    loose: dict[str, int]
    key: list[str] = field(default_factory=list)
    buckets: int = 0
    folders: dict[str, list] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return sum(self.loose.values()) + sum(size for _, size in self.folders.values())

    def names(self) -> list[str]:
        return sorted([*self.loose, *[name for name, _ in self.folders.values()]])

    def with_loose(self, added: dict[str, int], gone: list[str]) -> Version:
        """Loose folders added, and others taken out; one that never got a row goes as well."""
        kept = {n: size for n, size in self.loose.items() if n not in gone and size}
        return replace(self, loose=kept | added)


class VersionLog:
    """Numbered files in one folder, each with the versions of all tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.folder = self._path(folder)
        self.store = self.folder.getFileSystem(self._conf)

    def _path(self, *parts: object):
        return self._jvm.org.apache.hadoop.fs.Path(*parts)

    def qualified(self, path: str) -> str:
        """A path as the file system itself writes it, to compare it with another one."""
        return self.store.makeQualified(self._path(path)).toString()

    def read(self) -> tuple[int, dict[str, Version]]:
        """The last number, 0 if there is none, and the tables' versions."""
        if not self.store.exists(self.folder):
            return 0, {}
        names = [f.getPath().getName() for f in self.store.listStatus(self.folder)]
        last = max((int(n) for n in names if n.isdigit()), default=0)
        if not last:
            return 0, {}
        stream = self.store.open(self._path(self.folder, f"{last:012d}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return last, {table: Version(**found) for table, found in json.loads(text).items()}

    def add(self, number: int, tables: dict[str, Version]) -> bool:
        """Write the file of a number; False if the number is taken."""
        text = json.dumps({table: asdict(version) for table, version in tables.items()})
        draft = self._path(self.folder, f"_{uuid.uuid4().hex}")
        stream = self.store.create(draft, True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        try:
            return self._claim(draft, self._path(self.folder, f"{number:012d}"))
        finally:
            self.store.delete(draft, False)

    def _claim(self, draft, target) -> bool:
        """Give a finished file its name, unless somebody else has given it to another file."""
        return (self._link if self.store.getScheme() == "file" else self._rename)(draft, target)

    def _link(self, draft, target) -> bool:
        try:
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        except OSError:  # a mount without hard links
            return self._rename(draft, target)
        return True

    def _rename(self, draft, target) -> bool:
        hadoop = self._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(self.store.getUri(), self._conf)
        plain = self._gateway.new_array(hadoop.Options.Rename, 0)  # none of the options: no overwriting
        try:
            context.rename(draft, target, plain)
        except Exception:
            if self.store.exists(target):
                return False
            raise
        return True

    def size(self, folder: str) -> int:
        """Bytes of all files below a folder; none if it is not there."""
        path = self._path(folder)
        if not self.store.exists(path):
            return 0
        return self.store.getContentSummary(path).getLength()

    def remove(self, folder: str) -> None:
        self.store.delete(self._path(folder), True)
