"""Helpers shared by the operators: reading, shared files, bounded Arrow slices and byte-level words."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zilverspoor.session import run_dir, tune

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Bytes of text that one numpy step looks at; a single longer text is a step of its own.
SLICE_BYTES = 2 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Runtime settings, and the package's folder on the path of Python workers."""
    known = spark.sparkContext.environment
    parts = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in parts:
        known["PYTHONPATH"] = os.pathsep.join([*parts, ROOT])
    return tune(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key and the text, NULL as empty, under names that can't clash."""
    return df.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that the frame doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def settled(column: Column) -> Column:
    """The same values, computed where they stand: the optimiser moves no condition on them below,
    which would put the whole expression in the place of each mention."""
    return F.when(F.monotonically_increasing_id() >= 0, column)


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Files in the shared folder


def filesystem(uri: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_once(uri: str, name: str, chunks: Iterator[bytes]) -> str:
    """Write under a name of this attempt only; whoever lists the name has a whole file.

    A retried or speculative task writes another file. Readers go by the names that finished
    tasks returned, never by listing the folder.
    """
    store, folder = filesystem(uri)
    store.create_dir(folder, recursive=True)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(path) as out:
        for chunk in chunks:
            out.write(chunk)
    return os.path.basename(path)


def file_bytes(uri: str, name: str) -> np.ndarray:
    """A file as bytes: mapped into memory where the folder is mounted, read elsewhere."""
    from pyarrow import fs

    store, folder = filesystem(uri)
    path = f"{folder}/{name}"
    if isinstance(store, fs.LocalFileSystem):
        if os.path.getsize(path) == 0:
            return np.empty(0, np.uint8)
        return np.memmap(path, np.uint8, "r")
    with store.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), np.uint8)


# Arrow batches


def give_back() -> None:
    """Return freed memory to the machine: workers live on after a task, next to each other."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def _text_bytes(batch: pa.RecordBatch) -> pa.Array:
    return pc.binary_length(batch.column("text"))


def slices(
    batches: Iterator[pa.RecordBatch],
    limit: int = SLICE_BYTES,
    sizes_of: Callable[[pa.RecordBatch], pa.Array] = _text_bytes,
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose ``text`` holds at most ``limit`` bytes, or one row.

    When the batches end, memory that was freed goes back to the machine.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(sizes_of(batch), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        first, base = 0, 0
        while first < batch.num_rows:
            last = int(np.searchsorted(ends, base + limit, side="right"))
            last = max(last, first + 1)
            yield batch.slice(first, last - first)
            first, base = last, int(ends[last - 1])
    give_back()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (one more: the end)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts that stand next to each other in ``data``, without a copy of it."""
    offsets = np.ascontiguousarray(offsets, np.int64)
    parts = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, parts)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of many ranges, one range after another."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


# Words of bytes

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word bytes where words are letters, digits and whatever is beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Word bytes where words are what stands between ASCII white space.
SOLID = np.ones(256, bool)
SOLID[[32, 9, 10, 11, 12, 13]] = False


def word_spans(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and for each text the number of words before it (one more: all)."""
    inside = kind[data]
    change = np.empty(len(data) + 1, bool)
    if len(data):
        change[0], change[-1] = inside[0], inside[-1]
        np.not_equal(inside[1:], inside[:-1], out=change[1:-1])
    else:
        change[0] = False
    begins = np.zeros(len(data) + 1, bool)
    begins[:-1] = change[:-1] & inside
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = change[1:] & inside
    # a text's end also ends its last word
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    begins[cuts] = True
    ends[cuts] = True
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(ends), np.searchsorted(first, offsets)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, factor in (("up", _BASE), ("down", _INVERSE)):
            column = np.full(size, factor, np.uint64)
            column[0] = 1
            _powers[name] = np.cumprod(column, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of a public generator, splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch of bytes follows."""
    up, _ = _power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes."""
    _, down = _power_table(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n hashes that stand next to each other."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    last = len(hashes) - n + 1
    out = hashes[:last].copy()
    for k in range(1, n):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + last])
    return out
