"""Token ids as length-delimited binary records with an index of their own.

A record file holds, one after another and in ascending key order,

    length   8 bytes, little endian: bytes of the payload
    check    4 bytes: masked crc32 of the 8 bytes before
    payload  1 byte (1: there is a key), 8 bytes key, then the ids, 2 or 4 bytes each
    check    4 bytes: masked crc32 of the payload

and its index file the offset of every record (and the file's size) as 8-byte numbers, then their
masked crc32, so that a shuffled reader can go to any record. A checksum is masked (rotated and
moved by a constant) because a checksum over data that holds checksums is weak.

Files get a name of the attempt that writes them; the manifest, written by Spark, names those of
tasks that succeeded. So a lost executor leaves at most files that nobody reads.

Defined cases: NULL and empty texts give the end id only; a NULL key sorts first and is read back as
NULL; rows with equal keys are all kept, ordered by text; keys are whole numbers, and a text that is
none is an error; other columns of the input are left out; an empty table gives a manifest without
files, and reading gives no rows.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zilverspoor.llm.common import buffers, file_bytes, filesystem, slices, texts
from zilverspoor.llm.memo import Encoded, Memo

BATCH_BYTES = 12 << 20
#: A file is closed when it has reached this size; the next record opens another one.
FILE_BYTES = 256 << 20
#: Records that a reading task takes from a file at a time.
READ_RECORDS = 4096
#: Bytes of a record that are not ids.
FRAME = 8 + 4 + 1 + 8 + 4

MANIFEST = (
    "shard long, data string, index string, width int, n_records long, n_tokens long, "
    "n_bytes long, first_key long, last_key long"
)


def masked(data: bytes) -> int:
    """crc32, rotated by 15 bits and moved by the constant that public record formats use."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def record(key: int | None, ids: bytes) -> bytes:
    payload = struct.pack("<Bq", key is not None, key or 0) + ids
    head = struct.pack("<Q", len(payload))
    return b"".join(
        (head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload)))
    )


def open_record(data: np.ndarray, start: int, end: int) -> tuple[int | None, bytes]:
    """The key and the ids of the record between two offsets, checksums compared."""
    raw = data[start:end].tobytes()
    (length,) = struct.unpack_from("<Q", raw)
    if length != len(raw) - 16 or masked(raw[:8]) != struct.unpack_from("<I", raw, 8)[0]:
        raise ValueError(f"damaged length at offset {start}")
    payload = raw[12:-4]
    if masked(payload) != struct.unpack_from("<I", raw, len(raw) - 4)[0]:
        raise ValueError(f"damaged record at offset {start}")
    known, key = struct.unpack_from("<Bq", payload)
    return (key if known else None), payload[9:]


def read_index(data: np.ndarray) -> np.ndarray:
    raw = data.tobytes()
    if masked(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
        raise ValueError("damaged index")
    return np.frombuffer(raw[:-4], "<u8").astype(np.int64)


class FileWriter:
    """One record file and its index, under names of this attempt."""

    def __init__(self, folder: str, width: int):
        self.store, self.path = filesystem(folder)
        self.store.create_dir(self.path, recursive=True)
        self.name, self.width = f"ids-{uuid.uuid4().hex}", width
        self.out = self.store.open_output_stream(f"{self.path}/{self.name}.rec")
        self.offsets, self.at, self.tokens = [0], 0, 0
        self.first = self.last = None

    def add(self, key: int | None, ids: np.ndarray) -> None:
        raw = record(key, ids.astype(f"<u{self.width}").tobytes())
        self.out.write(raw)
        self.at += len(raw)
        self.offsets.append(self.at)
        self.tokens += len(ids)
        if self.first is None:
            self.first = key
        self.last = key

    def close(self) -> dict:
        self.out.close()
        raw = np.array(self.offsets, "<u8").tobytes()
        with self.store.open_output_stream(f"{self.path}/{self.name}.idx") as out:
            out.write(raw + struct.pack("<I", masked(raw)))
        return {
            "data": f"{self.name}.rec", "index": f"{self.name}.idx", "width": self.width,
            "n_records": len(self.offsets) - 1, "n_tokens": self.tokens, "n_bytes": self.at,
            "first_key": self.first, "last_key": self.last,
        }


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_ASCII_MARK = np.zeros(256, bool)
_ASCII_MARK[33:127] = True
_ASCII_MARK[48:58] = _ASCII_MARK[65:91] = _ASCII_MARK[97:123] = False
_ASCII_MARK[ord("'")] = False
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts can be cut without a change of their ids, for tokenizers that drop white space
    and keep letters and marks apart: after runs of ASCII white space, and between an ASCII letter
    and a mark."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        space = _ASCII_SPACE[data]
        cut[1:-1] = space[:-1] & ~space[1:]
        cut[1:-1] |= _ASCII_LETTER[data[:-1]] & _ASCII_MARK[data[1:]]
    cut[offsets] = True
    return np.flatnonzero(cut)


_memos: dict[str, Memo] = {}


def memo(path: str) -> Memo:
    if path not in _memos:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

        def encode(pieces: list[str]) -> Encoded:
            each = [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            counts = np.fromiter(map(len, each), np.int64, len(each))
            return np.fromiter(chain.from_iterable(each), np.int32, int(counts.sum())), counts

        _memos[path] = Memo(encode)
    return _memos[path]


def write(
    df: DataFrame,
    folder: str,
    path: str,
    end_id: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    width: int = 2,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Encode texts with a tokenizer file and write them in ascending key order; the manifest.

    ``folder`` must be reachable from all executors. Ids must fit into ``width`` bytes. Texts are
    dealt by ranges of the key, so each task holds a stretch of the order; a task streams its rows
    and holds one slice of them.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = (
        texts(df, key, text)
        .withColumn("key", F.col("key").cast("long"))
        .repartitionByRange(n, "key")
        .sortWithinPartitions("key", "text")
        .withColumn("part", F.spark_partition_id().cast("long"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, writer, shard = memo(path), None, 0

        def closed() -> pa.RecordBatch:
            nonlocal shard
            row = {"shard": (part << 32) + shard, **writer.close()}
            shard += 1
            return pa.RecordBatch.from_pylist([row], schema=manifest_schema)

        for batch in slices(batches, BATCH_BYTES):
            data, offsets = buffers(batch.column("text"))
            small = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
            cuts = word_cuts(small, offsets)
            ids, counts = words.gather(small, cuts, np.searchsorted(cuts, offsets))
            if len(ids) and int(ids.max()) >= 1 << 8 * width:
                raise ValueError(f"ids do not fit into {width} bytes")
            ends = np.cumsum(counts)
            part = batch.column("part")[0].as_py()
            tail = [] if end_id is None else [end_id]
            for k, begin, end in zip(batch.column("key").to_pylist(), ends - counts, ends):
                if writer is None:
                    writer = FileWriter(folder, width)
                writer.add(k, np.concatenate([ids[begin:end], np.array(tail, np.int32)]))
                if writer.at >= file_bytes:
                    yield closed()
                    writer = None
        if writer is not None:
            yield closed()

    manifest_schema = pa.schema([
        ("shard", pa.int64()), ("data", pa.string()), ("index", pa.string()), ("width", pa.int32()),
        ("n_records", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()),
        ("first_key", pa.int64()), ("last_key", pa.int64()),
    ])
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str, records: int = READ_RECORDS) -> DataFrame:
    """All records: key, start (ids before it in key order), n_tokens, ids as little-endian
    unsigned 32-bit numbers.

    The running sum goes over files (one row each, hundreds of megabytes of ids apart), not over
    records; inside a file a record's offset says how many ids stand before it.
    """
    files = manifest(spark, folder).withColumn(
        "base", F.coalesce(F.sum("n_tokens").over(
            Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    pieces = files.select(
        "data", "index", "width", "base", "n_records",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_records") - 1, F.lit(records).cast("long"))).alias("first"),
    ).repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "data", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chain.from_iterable(b.to_pylist() for b in batches):
            data = file_bytes(folder, row["data"])
            offsets = read_index(file_bytes(folder, row["index"]))
            first, width = row["first"], row["width"]
            last = min(first + records, row["n_records"])
            keys, out, sizes, held = [], [], [], 0
            begin = first
            for i in range(first, last):
                key, ids = open_record(data, int(offsets[i]), int(offsets[i + 1]))
                keys.append(key)
                out.append(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())
                sizes.append(len(ids) // width)
                held += len(out[-1])
                if held >= BATCH_BYTES or i + 1 == last:
                    before = offsets[begin : i + 1] - np.arange(begin, i + 1) * FRAME
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(row["base"] + before // width, pa.int64()),
                         pa.array(sizes, pa.int64()), pa.array(out, pa.binary())],
                        names=["key", "start", "n_tokens", "ids"],
                    )
                    keys, out, sizes, held, begin = [], [], [], 0, i + 1

    return pieces.mapInArrow(run, "key long, start long, n_tokens long, ids binary")
