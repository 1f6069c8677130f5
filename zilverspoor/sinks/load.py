"""Loading several silver tables as one step."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zilverspoor.contracts import CONTRACTS, TableContract
from zilverspoor.operators.conform import Conformed, conform
from zilverspoor.operators.quality import fk_orphans, pk_violations
from zilverspoor.plans.registry import MAPPINGS, Bronze, plan_all, source_bytes
from zilverspoor.session import (
    cleaned_shuffles,
    drop_folders,
    hashed_joins,
    together,
    working_folders,
)
from zilverspoor.sinks.tables import LoadError, Staged, TableStore

_REPORT = "target string, status string, reason string"
#: The table of rows that did not fit.
REJECTED = "REJECTED"


def create_silver(
    store: TableStore, contracts: Iterable[TableContract] | None = None, reset: bool = False
) -> None:
    """Create the canonical tables that are missing; ``reset`` starts from nothing."""
    if reset:
        store.reset()
    for contract in contracts if contracts is not None else CONTRACTS.values():
        store.create(contract)


def load_silver(
    bronze: Bronze,
    store: TableStore,
    targets: Iterable[str] | None = None,
    modes: Mapping[str, str] | None = None,
    check_keys: bool = False,
    row_limit: int = 0,
    width: int = 4,
    strict: bool = False,
) -> DataFrame:
    """Run the mappings and show their rows in all tables at once.

    Every mapping is written aside first, up to ``width`` of them at a time, but large ones one
    after another: what a mapping shuffles and keeps on the way is gone when the next begins. Rows that
    do not fit their table's contract go to the table ``REJECTED`` with the
    reasons; ``strict`` makes them an error. If a mapping fails, or ``check_keys``
    finds a duplicate key, no table changes. A mapping whose source is missing is
    skipped; the result lists what was loaded and what was skipped and why.
    """
    modes = {name.lower(): mode.lower() for name, mode in (modes or {}).items()}

    def stage(target: str, frame: DataFrame) -> tuple[Staged, DataFrame | None]:
        key = CONTRACTS[target].primary_key if target in CONTRACTS else ()
        mode = modes.get(target.lower(), "overwrite")
        if target not in CONTRACTS:
            return store.stage(frame, target, mode, key), None
        # keys are the business of check_keys and the key report
        fitted = conform(frame, CONTRACTS[target], null_keys=True)
        # counted while the good rows are written; the bad ones are made only if there are any
        seen = Observation()
        bad = F.count_if(F.size(fitted.reasons) > 0).alias("bad")
        watched = Conformed(fitted.checked.observe(seen, bad), fitted.reasons)
        item = store.stage(watched.accepted, target, mode, key)
        found = rejected_lines(target, fitted.rejected) if seen.get["bad"] else None
        if found is not None and strict:
            reasons = found.select(F.explode("problems").alias("p")).distinct().limit(10).collect()
            raise LoadError(f"{target}: rows do not fit: {sorted(r['p'] for r in reasons)}")
        if check_keys and key:
            schema = store.read(target).schema
            rows = store.spark.read.schema(schema).parquet(item.path)
            if not pk_violations(rows, key).isEmpty():
                raise LoadError(f"{target}: key {list(key)} is not unique or incomplete")
        return item, found

    kept: list[str] = []  # what rows that do not fit are read from once more

    def load(target: str) -> tuple[Staged, DataFrame | None] | str:
        with working_folders() as folders:
            planned = plan_all(bronze, [target], row_limit, width)
            if target in planned.skipped:
                return planned.skipped[target]
            item, found = stage(target, planned.frames[target])
        if found is None:
            drop_folders(store.spark, folders)
        else:
            kept.extend(folders)
        return item, found

    names = list(dict.fromkeys(targets if targets is not None else MAPPINGS))
    with cleaned_shuffles(store.spark):
        with hashed_joins(store.spark):
            weights = [source_bytes(name, bronze) for name in names]
            results = together(store.spark, [partial(load, name) for name in names], width, weights)
        skipped = {name: r for name, r in zip(names, results) if isinstance(r, str)}
        done = [r for r in results if not isinstance(r, str)]
        staged = [item for item, _ in done]
        bad = [rows for _, rows in done if rows is not None]
        if bad:
            if not store.exists(REJECTED):
                store.replace(bad[0].limit(0), REJECTED)
            rows = reduce(DataFrame.unionByName, bad)
            staged.append(store.stage(rows, REJECTED, "append"))
            drop_folders(store.spark, kept)
    store.publish(staged)
    staged = [item for item in staged if item.table != REJECTED]
    return load_report(store.spark, [i.table for i in staged], skipped)


def rejected_lines(target: str, rows: DataFrame) -> DataFrame:
    """Rejected rows of any table in one form: table, reasons, and the row as JSON."""
    values = [c for c in rows.columns if c != "problems"]
    return rows.select(
        F.lit(target).alias("target"), "problems", F.to_json(F.struct(*values)).alias("row")
    )


def load_report(
    spark: SparkSession, loaded: Iterable[str], skipped: Mapping[str, str]
) -> DataFrame:
    """One row per mapping: loaded, or skipped with the reason."""
    rows = [(t, "loaded", None) for t in loaded]
    rows += [(t, "skipped", reason) for t, reason in skipped.items()]
    return spark.createDataFrame(rows, _REPORT)


def key_report(store: TableStore, contracts: Iterable[TableContract]) -> DataFrame:
    """Per table the key values that are incomplete or repeated, and their rows."""
    lines = [
        _violation_line(
            pk_violations(store.read(c.name), c.primary_key), c.name, c.primary_key, "key"
        )
        for c in contracts
        if c.primary_key
    ]
    return reduce(DataFrame.unionByName, lines)


def reference_report(store: TableStore, contracts: Iterable[TableContract]) -> DataFrame:
    """Per reference between the given tables the values without a parent, and their rows."""
    by_name = {c.name: c for c in contracts}
    lines = [
        _violation_line(
            fk_orphans(store.read(c.name), ref.columns, store.read(ref.table), ref.key),
            c.name,
            ref.columns,
            ref.table,
        )
        for c in by_name.values()
        for ref in c.references
        if ref.table in by_name
    ]
    return reduce(DataFrame.unionByName, lines)


def _violation_line(
    found: DataFrame, table: str, columns: Sequence[str], rule: str
) -> DataFrame:
    return found.agg(
        F.count(F.lit(1)).alias("bad_values"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("bad_rows"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(columns)).alias("columns"),
        F.lit(rule).alias("rule"),
        "bad_values",
        "bad_rows",
    )
