"""Mapping registry and name-tolerant access to bronze."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession

from zilverspoor.operators.columns import (
    MissingSource,
    coerce_labels,
    resolve_columns,
    resolve_table,
)
from zilverspoor.session import read_bytes, together


@dataclass(frozen=True)
class SilverMapping:
    target: str
    requires: Mapping[str, Sequence[str]]
    builder: Callable[[SimpleNamespace], DataFrame]


MAPPINGS: dict[str, SilverMapping] = {}


def mapping(target: str, **requires: Sequence[str]):
    """Register a function that builds ``target`` from the bronze columns it names.

    The function gets the required tables as attributes of one object, cut to
    the declared columns in lower case, and ``as_of``, the day of the run.
    """

    def register(builder: Callable[[SimpleNamespace], DataFrame]):
        if target in MAPPINGS:
            raise ValueError(f"two mappings for {target}")
        MAPPINGS[target] = SilverMapping(target, requires, builder)
        return builder

    return register


@dataclass(frozen=True)
class Bronze:
    """Bronze tables by name, and how tolerant looking them up is.

    ``matching`` is ``auto`` (any case) or ``strict``; ``table_case`` and
    ``column_case`` say which spelling wins when several exist.
    """

    tables: Mapping[str, DataFrame]
    matching: str = "auto"
    table_case: str | None = None
    column_case: str | None = None
    as_of: Column | None = field(default=None)

    @classmethod
    def from_database(cls, spark: SparkSession, database: str, **options) -> Bronze:
        """All tables of a catalog database."""
        names = [t.name for t in spark.catalog.listTables(database)]
        return cls({n: spark.table(f"`{database}`.`{n}`") for n in names}, **options)

    def table(self, name: str, columns: Sequence[str]) -> DataFrame:
        found = resolve_table(self.tables, name, columns, self.matching, self.table_case)
        return resolve_columns(found, columns, self.matching, self.column_case)


def sources(target: str, bronze: Bronze) -> dict[str, DataFrame]:
    """The tables of a mapping, cut to the columns that it needs."""
    return {name: bronze.table(name, columns) for name, columns in MAPPINGS[target].requires.items()}


def build(
    target: str, bronze: Bronze, row_limit: int = 0, label_case: str = "none"
) -> DataFrame:
    """The frame of one mapping. A ``row_limit`` above zero is for development runs."""
    tables = sources(target, bronze)
    frame = MAPPINGS[target].builder(SimpleNamespace(as_of=bronze.as_of, **tables))
    frame = coerce_labels(frame, label_case)
    return frame.limit(row_limit) if row_limit > 0 else frame


def source_bytes(target: str, bronze: Bronze) -> int:
    """Bytes that a mapping reads, none if it has to be skipped."""
    try:
        return sum(read_bytes(df) for df in sources(target, bronze).values())
    except MissingSource:
        return 0


@dataclass(frozen=True)
class Planned:
    """Mappings that can run, and for the others what they miss."""

    frames: dict[str, DataFrame]
    skipped: dict[str, str]


def plan_all(
    bronze: Bronze, targets: Iterable[str] | None = None, row_limit: int = 0, width: int = 4
) -> Planned:
    """Build every mapping whose tables and columns are there, up to ``width`` side by side, as
    some write their joined rows while they are built.

    Only a missing table or column skips a mapping; any other error stops the run.
    """
    names = list(targets if targets is not None else MAPPINGS)

    def one(target: str) -> DataFrame | str:
        try:
            return build(target, bronze, row_limit)
        except MissingSource as error:
            return str(error)

    sessions = [df.sparkSession for df in bronze.tables.values()]
    actions = [partial(one, name) for name in names]
    if sessions:
        weights = [source_bytes(name, bronze) for name in names] if len(names) > 1 else None
        made = together(sessions[0], actions, width, weights)
    else:
        made = [action() for action in actions]
    found = dict(zip(names, made))
    frames = {t: f for t, f in found.items() if not isinstance(f, str)}
    return Planned(frames, {t: f for t, f in found.items() if isinstance(f, str)})
