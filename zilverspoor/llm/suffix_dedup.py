"""Removal of long repeated strings, judged on a Burrows-Wheeler transform by interval expansion.

A byte goes if a string of ``LENGTH`` bytes over it also starts anywhere else. All windows of that
length are dealt out so that equal ones meet: a window belongs to its least k-mer, and together with
neighbours of the same k-mer and about the same offset to the bytes that all of them have, their
core. Stretches of windows whose core occurs once are done. Equal stretches are repeats as a whole.
What is left, different stretches around an equal core, is laid out as one text for a few cores at a
time. Its suffixes are sorted as far as the length asks, and a breadth-first search extends strings
to the left on the transform: an interval that is new after ``l`` steps marks a common prefix of
``l`` bytes. The search ends at the length; neighbours that are unmarked then begin alike for that
many bytes or more.

Where a core has more than ``CROWD`` different stretches (a common passage in ever new surroundings)
its windows are dealt once more, each by its own digest. The stretches of one core, one from each
block of texts that has it, are numbers of a few bytes that meet in one task before they are counted.

Documents are known by a digest of key and text. Texts go through two shuffles (to cut the stretches
that are compared, and to cut the result), everything else is numbers.

Defined cases: NULL texts are empty; texts below the length lose nothing; repeated rows are repeats
of one another; a repeat may overlap itself; keys may be NULL or equal; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zilverspoor.llm.common import (
    buffers,
    kept,
    mix,
    prefix_sums,
    ranges,
    slices,
    span_hashes,
    texts,
)
from zilverspoor.llm.elias_fano import pack, unpack

LENGTH = 400
#: Bytes of a k-mer, and offsets of windows that share a core.
KMER, STEP = 16, 100
#: Different stretches of a core from which on its windows are dealt one by one.
CROWD = 1000
#: Bytes of a step, of what a task sends off at once, and of a transform.
SLICE, FLUSH, BLOCK = 2 << 20, 16 << 20, 1 << 20

U = np.uint64
SEPARATOR = 255  # never a byte of UTF-8
_OTHER = np.random.default_rng(11).permutation(256).astype(np.uint8)


# Windows and their cores


def _loads(data: np.ndarray) -> np.ndarray:
    padded = np.concatenate([data, np.zeros(KMER, np.uint8)])
    return np.ndarray((len(data) + KMER - 8,), "<u8", buffer=padded, strides=(1,))


def least_kmers(data: np.ndarray, length: int) -> np.ndarray:
    """For each window that starts at a byte, where its least k-mer (the first of these) starts."""
    loads = _loads(data)
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.int64)
    first, second = loads[: len(data)], loads[8 : len(data) + 8]
    hashes = (first * U(0x9E3779B97F4A7C15)) ^ (second * U(0xC2B2AE3D27D4EB4F))
    hashes = hashes ^ (hashes >> U(29))
    hashes = (hashes * U(0xBF58476D1CE4E5B9)) & U(0xFFFFFFFF00000000)
    low = hashes | np.arange(len(hashes), dtype=np.uint64)
    width, reach = length - KMER + 1, 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    return (low[:n] & U(0xFFFFFFFF)).astype(np.int64)


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Runs of windows of one core: first and last window, text, core and digest of the run."""
    sizes = np.diff(offsets)
    n = np.maximum(0, sizes - length + 1)
    owner = np.repeat(np.arange(len(n)), n)
    at = ranges(offsets[:-1], n)
    if not len(at):
        none = np.empty(0, np.int64)
        return {"text": none, "first": none, "last": none, "core": none.astype(np.uint64),
                "same": none.astype(np.uint64)}
    kmer = least_kmers(data, length)[at]
    part = (kmer - at) // STEP
    heads = np.concatenate(
        [[True], (kmer[1:] != kmer[:-1]) | (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])]
    )
    start = np.flatnonzero(heads)
    stop = np.append(start[1:], len(at)) - 1
    first, last, text = at[start], at[stop], owner[start]
    kmer, part = kmer[start], part[start]
    sums = prefix_sums(data)
    begin = kmer - part * STEP
    end = np.minimum(begin - STEP + 1 + length, len(data))
    core = mix(span_hashes(sums, begin, end) + part.astype(np.uint64))
    whole = span_hashes(sums, first, last + length)
    shape = (kmer - first).astype(np.uint64) * U(1 << 20) + (kmer - last).astype(np.uint64)
    same = mix(mix(core + shape) + whole)
    base = offsets[text]
    return {"text": text, "first": first - base, "last": last - base, "core": core, "same": same}


def merged(text: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows united where one follows the other."""
    order = np.lexsort((first, text))
    text, first, last = text[order], first[order], last[order]
    if not len(text):
        return text, first, last
    # within a text, ends as far as any run before reaches
    far = np.maximum.accumulate(last + text * (1 << 40)) - text * (1 << 40)
    heads = np.concatenate([[True], (text[1:] != text[:-1]) | (first[1:] > far[:-1] + 1)])
    start = np.flatnonzero(heads)
    stop = np.append(start[1:], len(text)) - 1
    return text[start], first[start], far[stop]


def _shards(values: np.ndarray, shards: int) -> np.ndarray:
    return ((values >> U(32)) * U(shards) >> U(32)).astype(np.int64)


def _send(parts: dict[str, np.ndarray], shard: np.ndarray, names: list[bytes], shards: int):
    """Blocks by shard; each brings the digests of its documents along."""
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    digests = np.frombuffer(b"".join(names), "V16")
    filled = np.flatnonzero(np.diff(cuts))
    out = []
    for s in filled:
        at = order[cuts[s] : cuts[s + 1]]
        used, place = np.unique(parts["text"][at], return_inverse=True)
        arrays = {k: v[at] for k, v in parts.items() if k != "text"}
        arrays["names"] = digests[used].view(np.uint8)
        out.append(pack(arrays | {"text": place.astype(np.uint32)}))
    return pa.RecordBatch.from_arrays(
        [pa.array(filled.astype(np.int32)), pa.array(out, pa.binary())], names=["shard", "block"]
    )


def _gather(blocks: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    each = [unpack(np.frombuffer(b, np.uint8)) for b in blocks]
    names = np.concatenate([e.pop("names") for e in each]).view("V16")
    base, shifted = 0, []
    for e, block in zip(each, blocks):
        top = int(e["text"].max()) + 1 if len(e["text"]) else 0
        shifted.append(e["text"].astype(np.int64) + base)
        base += top
    parts = {k: np.concatenate([e[k] for e in each]) for k in each[0] if k != "text"}
    return parts | {"text": np.concatenate(shifted)}, names


def _cut(docs: DataFrame, shards: int, length: int) -> DataFrame:
    """Blocks of stretches; those that a task has several of are known as repeats already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        names: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            every = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
            order = np.argsort(every["same"], kind="stable")
            every = {k: v[order] for k, v in every.items()}
            same = every["same"]
            heads = np.concatenate([[True], same[1:] != same[:-1]])[: len(same)]
            start = np.flatnonzero(heads)
            count = np.diff(np.append(start, len(same)))
            again = np.repeat(count > 1, count)
            text, first, last = merged(*(every[k][again] for k in ("text", "first", "last")))
            done = {"text": text, "first": first, "last": last,
                    "core": np.zeros(len(text), U), "same": np.zeros(len(text), U),
                    "kind": np.ones(len(text), np.uint8)}
            one = {k: v[start] for k, v in every.items()}
            one["kind"] = np.where(count > 1, 2, 0).astype(np.uint8)
            both = {k: np.concatenate([done[k], one[k]]) for k in done}
            where = np.concatenate([mix(text.astype(U) + U(5)), one["core"]])
            for k in ("first", "last"):
                both[k] = both[k].astype(np.uint32 if both[k].max(initial=0) < 1 << 32 else np.int64)
            return _send(both, _shards(where, shards), names, shards)

        for batch in slices(batches, SLICE):
            data, offsets = buffers(batch.column("text"))
            found = stretches(data, offsets, length)
            found["text"] = found["text"] + len(names)
            names.extend(batch.column("digest").to_pylist())
            held.append(found)
            size += len(data)
            if size >= FLUSH:
                yield flush()
                held, names, size = [], [], 0
        if held:
            yield flush()

    return docs.select("digest", "text").mapInArrow(run, "shard int, block binary")


FOUND = "digest binary, kind int, core long, first long, last long"


def _rows(names, text, kind, core, first, last) -> pa.RecordBatch:
    digests = pa.array(list(map(bytes, names[text])), pa.binary())
    n = len(text)
    return pa.RecordBatch.from_arrays(
        [digests, pa.array(np.broadcast_to(np.int32(kind), n)), pa.array(core.view(np.int64)),
         pa.array(first.astype(np.int64)), pa.array(last.astype(np.int64))],
        names=["digest", "kind", "core", "first", "last"],
    )


def _by_shard(blocks: DataFrame, shards: int, work, schema: str) -> DataFrame:
    """Run ``work`` on all blocks of each shard, one shard after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for shard, block in zip(batch.column("shard").to_pylist(), batch.column("block")):
                if shard != current and held:
                    yield from work(held)
                    held = []
                current = shard
                held.append(block.as_py())
        if held:
            yield from work(held)

    dealt = blocks.repartitionById(shards, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, schema)


def _compare(blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Repeats (kind 1), and stretches to compare byte by byte (2) or window by window (3)."""
    every, names = _gather(blocks)
    done = every["kind"] == 1
    text, first, last = (every[k][done] for k in ("text", "first", "last"))
    yield _rows(names, text, 1, np.zeros(len(text), U), first, last)
    every = {k: v[~done] for k, v in every.items()}
    order = np.lexsort((every["same"], every["core"]))
    every = {k: v[order] for k, v in every.items()}
    core, same = every["core"], every["same"]
    if not len(core):
        return
    new_core = np.concatenate([[True], core[1:] != core[:-1]])
    new_same = new_core | np.concatenate([[True], same[1:] != same[:-1]])
    start = np.flatnonzero(new_same)
    count = np.diff(np.append(start, len(core)))
    again = np.repeat(count > 1, count)
    text, first, last = merged(*(every[k][again].astype(np.int64) for k in ("text", "first", "last")))
    yield _rows(names, text, 1, np.zeros(len(text), U), first, last)
    # one of each different stretch, where a core has several
    group = np.cumsum(new_core)[start]
    different = np.bincount(group)[group]
    for kind, chosen in ((2, (different > 1) & (different <= CROWD)), (3, different > CROWD)):
        at = start[chosen]
        yield _rows(names, every["text"][at], kind, core[at], every["first"][at], every["last"][at])


# Comparison


def _fetch(
    needs: DataFrame, docs: DataFrame, shards: int, length: int
) -> DataFrame:
    """Blocks of the bytes of stretches by core, or of the digests of their windows."""
    listed = needs.groupBy("digest").agg(
        F.collect_list(F.struct("kind", "core", "first", "last")).alias("needs")
    )  # as many as the document has stretches
    both = docs.join(listed, "digest").select("digest", "text", "needs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            data, offsets = buffers(batch.column("text"))
            names = batch.column("digest").to_pylist()
            column = batch.column("needs")
            text = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy(zero_copy_only=False))
            flat = column.flatten()
            kind, core, first, last = (
                flat.field(i).to_numpy(zero_copy_only=False) for i in range(4)
            )
            core = core.view(np.uint64)
            near = np.flatnonzero(kind == 2)
            if len(near):
                begin = offsets[text[near]] + first[near]
                size = last[near] - first[near] + length
                yield from _send_bytes(data, begin, size, text[near], first[near], core[near], names, shards)
            crowd = np.flatnonzero(kind == 3)
            if len(crowd):
                each = last[crowd] - first[crowd] + 1
                place = ranges(first[crowd], each)
                owner = np.repeat(text[crowd], each)
                begin = place + offsets[owner]
                one = span_hashes(prefix_sums(data), begin, begin + length)
                two = span_hashes(prefix_sums(_OTHER[data]), begin, begin + length)
                parts = {"text": owner, "first": place, "one": one, "two": two,
                         "kind": np.full(len(one), 3, np.uint8)}
                yield _send(parts, _shards(mix(one + U(9)), shards), names, shards)

    return both.mapInArrow(run, "shard int, block binary")


def _send_bytes(data, begin, size, text, first, core, names, shards):
    shard = _shards(core, shards)
    for s in np.unique(shard):
        at = np.flatnonzero(shard == s)
        parts = {"text": text[at], "first": first[at], "core": core[at], "size": size[at],
                 "kind": np.full(len(at), 2, np.uint8)}
        used, place = np.unique(text[at], return_inverse=True)
        digests = np.frombuffer(b"".join(names), "V16")[used].view(np.uint8)
        parts |= {"names": digests, "text": place.astype(np.uint32),
                  "bytes": data[ranges(begin[at], size[at])]}
        yield pa.RecordBatch.from_arrays(
            [pa.array([s], pa.int32()), pa.array([pack(parts)], pa.binary())],
            names=["shard", "block"],
        )


def suffixes(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in order, as far as their first ``depth`` bytes tell.

    Sorted by eight bytes, then by twice as many each time; only suffixes that are still alike are
    sorted again.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((n,), ">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    order = np.argsort(words, kind="stable")
    ranked = words[order]
    heads = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    reach = 8
    while reach < depth:
        alone = heads & np.append(heads[1:], True)
        left = np.flatnonzero(~alone)  # places in the order
        if not len(left):
            break
        at = order[left]
        key = rank[at] * (n + 2) + rank[np.minimum(at + reach, n)] + 1
        again = np.argsort(key, kind="stable")
        order[left] = at[again]
        key = key[again]
        heads[left] = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[left]] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))[left]
        reach *= 2
    return order


def alike(data: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes have the first ``length`` bytes of another one.

    Breadth-first backward extension on the transform. An interval of suffixes with the same first
    ``l`` bytes is extended to the left by each byte that stands before one of them; if the place
    behind the new interval has no common prefix yet, that is ``l``, and the interval is new.
    """
    n = len(data)
    order = suffixes(data, length + 1)
    before = data[order - 1].astype(np.int64)  # the transform; the text counts as a ring
    # bounds of left extensions: places of each byte in the transform, byte by byte
    ranked = np.argsort(before, kind="stable")
    places = before[ranked] * (n + 1) + ranked
    differs = np.zeros(n + 1, bool)
    differs[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        size = high - low
        interval = np.repeat(np.arange(len(low)), size)
        letter = before[ranges(low, size)]
        pair = np.sort(interval * 256 + letter)
        pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])]
        interval, letter = pair >> 8, pair & 255
        begin = np.searchsorted(places, letter * (n + 1) + low[interval])
        end = np.searchsorted(places, letter * (n + 1) + high[interval])
        new = ~differs[end]
        differs[end[new]] = True
        low, high = begin[new], end[new]
        if not len(low):
            break
    out = np.zeros(n, bool)
    same = ~differs  # with the suffix before
    out[order] = same[:n] | same[1:]
    return out


def _judge(length: int):
    """Repeated windows among the stretches of a shard's cores."""

    def work(blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        near, crowd = [], []
        for block in blocks:
            kind = unpack(np.frombuffer(block, np.uint8))["kind"][0]
            (near if kind == 2 else crowd).append(block)
        if crowd:
            every, names = _gather(crowd)
            order = np.lexsort((every["two"], every["one"]))
            one, two = every["one"][order], every["two"][order]
            same = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
            again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            at = order[again]
            found = merged(every["text"][at], every["first"][at], every["first"][at])
            yield _rows(names, found[0], 1, np.zeros(len(found[0]), U), *found[1:])
        if near:
            every, names = _gather(near)
            size = every["size"]
            starts = np.cumsum(size) - size
            order = np.argsort(every["core"], kind="stable")
            core = every["core"][order]
            heads = np.flatnonzero(np.concatenate([[True], core[1:] != core[:-1]]))
            ends = np.append(heads[1:], len(core))
            total = np.concatenate([[0], np.cumsum(size[order])])
            begin = 0
            while begin < len(heads):  # as many cores as a transform takes
                limit = total[heads[begin]] + BLOCK
                stop = max(begin + 1, int(np.searchsorted(total[ends], limit, side="right")))
                at = order[heads[begin] : ends[stop - 1]]
                yield _transform(every, names, at, starts, length)
                begin = stop

    return work


def _transform(every, names, at, starts, length) -> pa.RecordBatch:
    size = every["size"][at]
    data = np.full(int(size.sum()) + len(at) + 1, SEPARATOR, np.uint8)
    where = np.cumsum(size + 1) - (size + 1)
    data[ranges(where, size)] = every["bytes"][ranges(starts[at], size)]
    repeated = alike(data, length)
    n = size - length + 1
    windows = ranges(where, n)
    owner = np.repeat(np.arange(len(at)), n)
    hit = repeated[windows]
    place = (windows - where[owner] + every["first"][at][owner])[hit]
    found = merged(every["text"][at][owner[hit]], place, place)
    return _rows(names, found[0], 1, np.zeros(len(found[0]), U), *found[1:])


# The operator


def remove_repeats(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    shards: int | None = None,
) -> DataFrame:
    """Key, bytes, removed bytes, removed spans (start and end) and what is kept of each text."""
    spark = df.sparkSession
    shards = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    source = texts(df, key, text)
    name = F.concat_ws("\0", F.coalesce(F.col("key").cast("string"), F.lit("\1")), "text")
    docs = source.select("key", "text", F.unhex(F.md5(name)).alias("digest"))
    found = _by_shard(_cut(docs, shards, length), shards, _compare, FOUND)
    found = kept(found, "repeats")
    needs = found.filter("kind > 1")
    judged = _by_shard(_fetch(needs, docs, shards, length), shards, _judge(length), FOUND)
    repeats = found.filter("kind = 1").union(judged).select("digest", "first", "last")
    listed = repeats.groupBy("digest").agg(
        F.collect_set(F.struct("first", "last")).alias("repeats")
    )
    both = docs.join(listed, "digest", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            data, offsets = buffers(batch.column("text"))
            column = batch.column("repeats")
            each = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = column.flatten()
            owner = np.repeat(np.arange(batch.num_rows), each)
            first, last = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            owner, first, last = merged(owner, first, last + length - 1)
            gone = ranges(offsets[owner] + first, last - first + 1)
            stay = np.ones(len(data), bool)
            stay[gone] = False
            total = np.concatenate([[0], np.cumsum(stay)])[offsets]
            kept_bytes = pa.Array.from_buffers(
                pa.large_binary(), batch.num_rows,
                [None, pa.py_buffer(total.astype(np.int64)), pa.py_buffer(data[stay])],
            ).cast(pa.binary())
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            spans = pa.StructArray.from_arrays(
                [pa.array(first), pa.array(last + 1)], names=["start", "end"]
            )
            size = np.diff(offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(size), pa.array(size - np.diff(total)),
                 pa.ListArray.from_arrays(pa.array(cuts), spans), kept_bytes],
                names=["key", "n_bytes", "n_removed", "spans", "kept"],
            )

    kind = source.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, n_bytes long, n_removed long, "
        "spans array<struct<start: long, end: long>>, kept binary"
    )
    out = both.select("key", "text", "repeats").mapInArrow(run, schema)
    return out.withColumnRenamed("key", key)
