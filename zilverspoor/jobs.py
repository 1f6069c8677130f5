"""The runs: tables, landed files and services to staging, staging to silver."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.operators.conform import to_bronze
from zilverspoor.plans import Bronze
from zilverspoor.session import together
from zilverspoor.sinks.load import create_silver, load_silver
from zilverspoor.sinks.tables import TableStore
from zilverspoor.sources.files import read_csv_folder, read_manifest_tables, read_part_folder
from zilverspoor.sources.odata import entity_types, parse_metadata
from zilverspoor.sources.odata_service import PAGE_ROWS, Transport, count_rows, read_service

log = logging.getLogger(__name__)

_REPORT = "table_name string, source_rows bigint, loaded_rows bigint, matches boolean"


def _counted(label: str, count: Callable[[], int | None]) -> int | None:
    """A count is information only: a source that cannot count does not stop the run."""
    try:
        return count()
    except Exception as error:
        log.warning("no row count for %s: %s", label, error)
        return None


def _load_one(
    store: TableStore,
    table: str,
    df: DataFrame,
    mode: str,
    source_rows: Callable[[], int | None] | None,
) -> tuple[str, int | None, int, bool | None]:
    """Load a table; the rows are counted while they are written."""
    expected = _counted(table, source_rows) if source_rows else None
    seen = Observation()
    store.load_staging(df.observe(seen, F.count(F.lit(1)).alias("n")), table, mode)
    loaded = seen.get["n"]
    return table, expected, loaded, None if expected is None else expected == loaded


def tables_to_staging(
    frames: Mapping[str, DataFrame],
    store: TableStore,
    mode: str = "replace",
    counters: Mapping[str, Callable[[], int | None]] | None = None,
    one_digit_is_boolean: bool = False,
    width: int = 4,
) -> DataFrame:
    """Load source tables into staging as bronze and compare their row counts.

    Reading and writing one table is one job over all its partitions; ``width``
    tables run side by side. ``counters`` ask the sources for their counts, for
    example with ``jdbc.count_rows``; a table without one is loaded unchecked.
    """
    counters = counters or {}
    actions = [
        partial(
            _load_one,
            store,
            name,
            to_bronze(df, one_digit_is_boolean),
            mode,
            counters.get(name),
        )
        for name, df in frames.items()
    ]
    return store.spark.createDataFrame(together(store.spark, actions, width), _REPORT)


def files_to_staging(
    path: str,
    store: TableStore,
    mode: str = "replace",
    kind: str = "parts",
    schemas: Mapping[str, T.StructType] | None = None,
    widen_decimals: bool = False,
    width: int = 4,
) -> DataFrame:
    """Load landed files into staging: ``parts`` and ``csv`` are folders, ``manifest`` is the list
    of one run, which names exactly the files to read."""
    if kind == "parts":
        frames = read_part_folder(store.spark, path, widen_decimals)
    elif kind == "manifest":
        frames = read_manifest_tables(store.spark, path)
    elif kind == "csv":
        frames = read_csv_folder(store.spark, path, schemas)
    else:
        raise ValueError(f"unknown kind of files {kind}")
    return tables_to_staging(frames, store, mode, width=width)


@dataclass(frozen=True)
class EntityOptions:
    """What to ask of one entity set, as the service understands it."""

    select: str | None = None
    filter: str | None = None
    expand: str | None = None


def service_to_staging(
    fetch: Transport,
    store: TableStore,
    entity_sets: Iterable[str] = ("*",),
    options: Mapping[str, EntityOptions] | None = None,
    mode: str = "replace",
    version: str = "v4",
    page_rows: int = PAGE_ROWS,
    row_limit: int = 0,
    links_only: bool = False,
    width: int = 4,
) -> DataFrame:
    """Load entity sets of a service into staging, one table per set, ``width`` side by side.

    ``*`` means all sets of the service. Names are matched in any case; a name
    the service does not have is an error before anything is fetched.
    """
    types, sets = parse_metadata(store.spark, fetch("$metadata"))
    type_of = {row["entity_set"]: row["entity_type"] for row in sets.collect()}
    any_case = {name.lower(): name for name in type_of}
    wanted = list(entity_sets)
    if wanted == ["*"]:
        wanted = list(type_of)
    unknown = sorted(n for n in wanted if n.lower() not in any_case)
    if unknown:
        raise ValueError(f"entity sets {unknown} are not in the service; it has {sorted(type_of)}")
    asked_of = {name.lower(): asked for name, asked in (options or {}).items()}

    contracts = entity_types(types)
    actions = []
    for name in (any_case[n.lower()] for n in wanted):
        asked = asked_of.get(name.lower(), EntityOptions())
        rows = read_service(
            store.spark,
            fetch,
            name,
            contracts[type_of[name].lower()],
            version,
            asked.select,
            asked.expand,
            asked.filter,
            row_limit,
            page_rows,
            links_only=links_only,
        )
        table = name.replace("[", "").replace("]", "").replace(".", "_").lower()
        counter = None if row_limit else partial(count_rows, fetch, name, asked.filter)
        lowered = rows.toDF(*[c.lower() for c in rows.columns])
        actions.append(partial(_load_one, store, table, lowered, mode, counter))
    return store.spark.createDataFrame(together(store.spark, actions, width), _REPORT)


def staging_to_silver(
    staging: str,
    store: TableStore,
    targets: Iterable[str] | None = None,
    modes: Mapping[str, str] | None = None,
    as_of: Column | None = None,
    reset: bool = False,
    **options,
) -> DataFrame:
    """Create what is missing in silver and run the mappings on a staging database."""
    create_silver(store, reset=reset)
    bronze = Bronze.from_database(store.spark, staging, as_of=as_of)
    return load_silver(bronze, store, targets, modes, **options)
