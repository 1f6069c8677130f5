"""What Parquet files say about themselves, read in tasks: rows, bytes, schema and column bounds.

A footer is a few kilobytes at the end of a file. Reading those of many files is one Spark job over
the list of files; nothing else of a file is read.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Files whose footers one task reads, about.
FILES_A_TASK = 64
#: Where Spark's own writer leaves the schema that it wrote.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

FOOTER = (
    "file string, rows bigint, bytes bigint, schema string, "
    "bounds map<string, struct<low: string, high: string, nulls: bigint>>"
)
_ARROW_BOUNDS = pa.map_(
    pa.string(),
    pa.struct([("low", pa.string()), ("high", pa.string()), ("nulls", pa.int64())]),
)


def read_footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row for each file, as :data:`FOOTER` says; a file that cannot be read is an error.

    ``schema`` is that of Spark, as JSON, or NULL if only Spark itself can tell. ``bounds`` has the
    smallest and largest value and the number of NULLs of every plain column that the file knows
    these of; floating-point columns have none, as NaN is outside of all bounds.
    """
    tasks = max(1, -(-len(paths) // FILES_A_TASK))
    files = spark.createDataFrame([(p,) for p in paths], "file string").repartition(tasks)
    return files.mapInArrow(_footers, FOOTER)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_footer(path) for path in batch.column("file").to_pylist()]
        columns = list(zip(*found)) if found else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.string(), _ARROW_BOUNDS]
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            names=["file", "rows", "bytes", "schema", "bounds"],
        )


def _footer(path: str) -> tuple:
    from pyarrow import fs, parquet

    if "://" in path:
        store, inside = fs.FileSystem.from_uri(path)
    else:  # a path of this machine, or file:/…
        store = fs.LocalFileSystem()
        inside = unquote(path.removeprefix("file:")) if path.startswith("file:") else path
    with store.open_input_file(inside) as source:
        size = source.size()
        footer = parquet.read_metadata(source)
    return footer.num_rows, size, _spark_schema(footer), list(_bounds(footer).items())


def _spark_schema(footer) -> str | None:
    own = (footer.metadata or {}).get(_SPARK_SCHEMA)
    if own:
        return own.decode()
    from pyspark.sql.pandas.types import from_arrow_schema

    arrow = footer.schema.to_arrow_schema()
    plain = {c.path: c.physical_type for c in (footer.schema.column(i) for i in range(len(footer.schema)))}
    if "INT96" in plain.values():  # moments in the old form; Spark reads them in its own way
        return None
    try:
        return from_arrow_schema(arrow).json()
    except Exception:  # a type that Arrow has and Spark maps by itself
        return None


def _bounds(footer) -> dict[str, dict]:
    """Bounds of the columns that all row groups know them of."""
    found: dict[str, dict] = {}
    unknown = set()
    for group in range(footer.num_row_groups):
        for i in range(footer.num_columns):
            chunk = footer.row_group(group).column(i)
            known, name = chunk.statistics, chunk.path_in_schema
            empty = known is not None and known.null_count == chunk.num_values
            if chunk.physical_type in ("FLOAT", "DOUBLE", "INT96") or known is None or not (
                empty or known.has_min_max
            ):
                unknown.add(name)
                continue
            low, high = (None, None) if empty else (known.min, known.max)
            before = found.get(name)
            nulls = known.null_count or 0
            if before:
                low = min((x for x in (low, before["low"]) if x is not None), default=None)
                high = max((x for x in (high, before["high"]) if x is not None), default=None)
                nulls += before["nulls"]
            found[name] = {"low": low, "high": high, "nulls": nulls}
    return {
        name: {"low": _text(b["low"]), "high": _text(b["high"]), "nulls": b["nulls"]}
        for name, b in found.items()
        if name not in unknown and _text(b["low"], True) is not None
    }


def _text(value, test: bool = False) -> str | None:
    """A bound as Spark casts it back from text; with ``test``, whether there is a form for it."""
    if value is None:
        return "" if test else None
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, str, decimal.Decimal, datetime.date, datetime.datetime)):
        return str(value)
    return None


def schema_of(text: str) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(text))


def may_hold(column: str, kind: T.DataType, low=None, high=None):
    """Whether a file can have rows with a column from ``low`` to ``high``, by its bounds.

    A file that doesn't know its bounds may; one that has only NULLs in the column cannot.
    """
    bound = F.element_at("bounds", F.lit(column))
    inside = F.lit(True)
    if low is not None:
        inside = inside & (bound["high"].cast(kind) >= F.lit(low).cast(kind))
    if high is not None:
        inside = inside & (bound["low"].cast(kind) <= F.lit(high).cast(kind))
    return bound.isNull() | F.coalesce(inside, F.lit(False))
