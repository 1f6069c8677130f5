"""Benchmark decontamination by Wu-Manber search of word windows.

Texts are brought to one form (lower case, words apart by one blank, a blank at both ends), and so
are the windows of the benchmark. A search looks at the block of bytes that ends where a window of
the shortest length would end. The shift table says how far the search may jump, as no window has
that block nearer to its end; where it says zero, the bucket of the block's suffix hash names the
windows to compare directly. Many texts are searched side by side: one numpy step moves the cursors
of all stretches of a slice.

Windows of very different lengths get searches of their own, as the shortest one bounds every jump.
A benchmark is searched in parts of a bounded size, so what a task holds does not grow with it; each
part is one pass over the texts, and a text's hits are united afterwards.

Defined cases: NULL and empty texts have no words and are clean; items without words have no window,
and items without an id or a text are left out; ids of items are whole numbers, and a text that is
none is an error;
repeated rows are judged one by one; equal windows of several items count for each; an empty
benchmark leaves all texts clean; other columns don't matter and pass through ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.llm.common import (
    ALNUM,
    LOWER,
    buffers,
    kept,
    ranges,
    slices,
    word_spans,
)

WINDOW = 13
#: Bytes of benchmark text that one pass searches for.
PART_BYTES = 1 << 20
#: Bytes of a block; windows too short for it take shorter blocks.
BLOCK = 8
#: Bytes of a stretch that has a cursor of its own.
STRETCH = 1024
#: A text is contaminated if hit words times this are as many as its words.
SHARE = 20


def normal_form(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as lower-case words, each with a blank behind it, and a blank before the first one.

    Gives the bytes, where each text begins in them (one more: the end), and the number of words
    before each text. Between two texts stand two blanks, which no window has.
    """
    data, offsets = buffers(pc.binary_join_element_wise("", texts, "", " "))
    inside = ALNUM[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    keep[offsets[:-1]] = True
    form = np.where(inside, LOWER[data], np.uint8(32))[keep]
    bounds = np.concatenate([[0], np.cumsum(keep)])[offsets]
    blanks = np.concatenate([[0], np.cumsum(form == 32)])[bounds]
    return form, bounds, blanks - np.arange(len(blanks))


def windows_of(texts: list[str | None], keys: list) -> dict[bytes, set]:
    """The windows of items, each with the items that have it."""
    found: dict[bytes, set] = {}
    if not texts:
        return found
    data, offsets = buffers(pa.array(texts, pa.string()))
    begins, ends, before = word_spans(data, offsets, ALNUM)
    low = LOWER[data].tobytes()
    for key, first, last in zip(keys, before[:-1], before[1:]):
        words = [low[b:e] for b, e in zip(begins[first:last], ends[first:last])]
        for i in range(max(1, len(words) - WINDOW + 1) if words else 0):
            found.setdefault(b" " + b" ".join(words[i : i + WINDOW]) + b" ", set()).add(key)
    return found


def _loads(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", buffer=data, strides=(1,))


class Search:
    """Shift table and suffix buckets of windows whose lengths are alike."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.shortest = min(map(len, patterns))
        block = BLOCK if self.shortest >= 2 * BLOCK else min(3, self.shortest)
        self.mask = np.uint64((1 << 8 * block) - 1)
        self.steps = self.shortest - block + 1  # places of a block in the shortest window
        lengths = np.array([len(p) for p in patterns], np.int64)
        self.lengths, starts = lengths, np.cumsum(lengths) - lengths
        loads = _loads(np.frombuffer(b"".join(patterns) + bytes(8), np.uint8))
        bits = min(26, max(12, (8 * len(patterns) * self.steps).bit_length()))
        self.drop = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, min(self.steps, 32767), np.int16)
        for step in range(self.steps):
            far = np.int16(min(self.steps - 1 - step, 32767))
            np.minimum.at(self.shift, self._address(loads[starts + step]), far)
        last = loads[starts + self.steps - 1] & self.mask
        self.order = np.argsort(last, kind="stable")
        self.suffixes = last[self.order]
        self.heads = loads[starts]

    def _address(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks & self.mask) * np.uint64(0x9E3779B97F4A7C15)) >> self.drop

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``data`` and the windows that begin there."""
        n = len(data)
        loads = _loads(np.concatenate([data, np.zeros(self.steps + 8, np.uint8)]))
        cursors = np.arange(0, n, STRETCH, dtype=np.int64)
        stops = np.minimum(cursors + STRETCH, n)
        spots = [np.empty(0, np.int64)]
        while len(cursors):
            move = self.shift[self._address(loads[cursors + self.steps - 1])]
            spots.append(cursors[move == 0])
            cursors = cursors + np.maximum(move, 1)
            on = cursors < stops
            if not on.all():
                cursors, stops = cursors[on], stops[on]
        at = np.concatenate(spots)
        block = loads[at + self.steps - 1] & self.mask
        low = np.searchsorted(self.suffixes, block, side="left")
        each = np.searchsorted(self.suffixes, block, side="right") - low
        window = self.order[ranges(low, each)]
        at = np.repeat(at, each)
        # direct comparison: the first bytes of all at once, then each whole window
        head = np.uint64((1 << 8 * min(8, self.shortest)) - 1)
        alike = ((loads[at] ^ self.heads[window]) & head) == 0
        at, window = at[alike], window[alike]
        raw = data.tobytes() if len(at) else b""
        same = np.fromiter(
            (raw.startswith(self.patterns[w], p) for p, w in zip(at.tolist(), window.tolist())),
            bool, len(at),
        )
        return at[same], window[same]


class Searches:
    """All windows of a part of the benchmark, in classes of alike lengths."""

    def __init__(self, items: list[tuple[int, str | None]]):
        found = windows_of([t for _, t in items], [k for k, _ in items])
        classes: dict[int, list[bytes]] = {}
        for window in found:
            classes.setdefault(len(window).bit_length(), []).append(window)
        self.classes = [
            (Search(sorted(ws)), [sorted(found[w]) for w in sorted(ws)],
             np.array([w.count(b" ") - 1 for w in sorted(ws)], np.int64))
            for _, ws in sorted(classes.items())
        ]


def _scan(batch: pa.RecordBatch, searches: Searches) -> pa.RecordBatch:
    form, bounds, before = normal_form(batch.column("text"))
    blanks = np.cumsum(form == 32)
    begins, ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    items: list[set] = [set() for _ in range(batch.num_rows)]
    for search, owners, sizes in searches.classes:
        at, window = search.find(form)
        text = np.searchsorted(bounds, at, side="right") - 1
        first = blanks[at] - 1 - text
        begins.append(first)
        ends.append(first + sizes[window])
        for t, w in set(zip(text.tolist(), window.tolist())):
            items[t].update(owners[w])
    n = int(before[-1])
    cover = np.bincount(np.concatenate(begins), minlength=n + 1)
    cover -= np.bincount(np.concatenate(ends), minlength=n + 1)
    hit = np.zeros(n + 2, bool)
    hit[1:-1] = np.cumsum(cover)[:n] > 0
    # a run of hit words begins after a word that is not hit, or with its text
    opens, closes = hit[1:-1] & ~hit[:-2], hit[1:-1] & ~hit[2:]
    cuts = before[(before > 0) & (before < n)]
    opens[cuts] = hit[1:-1][cuts]
    closes[cuts - 1] = hit[1:-1][cuts - 1]
    starts, stops = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    runs = np.searchsorted(starts, before)
    owner = np.repeat(np.arange(batch.num_rows), np.diff(runs))
    spans = pa.StructArray.from_arrays(
        [pa.array(starts - before[owner]), pa.array(stops - before[owner])], names=["start", "end"]
    )
    return pa.RecordBatch.from_arrays(
        [
            batch.column("row"),
            pa.array(np.diff(before)),
            pa.ListArray.from_arrays(pa.array(runs.astype(np.int32)), spans),
            pa.array([sorted(x) for x in items], pa.list_(pa.int64())),
        ],
        names=["row", "n_words", "spans", "items"],
    )


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)


def _search(source: DataFrame, items: list) -> DataFrame:
    """One pass over all texts with the items of one part."""
    held = source.sparkSession.sparkContext.broadcast(items)  # bounded by the size of a part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = Searches(held.value)
        for batch in slices(batches):
            yield _scan(batch, searches)

    return source.mapInArrow(run, T.StructType([source.schema["row"], *FOUND]))


def hits(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Each row (as ``row``) with its number of words, its spans of hit words and the items hit."""
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    items = benchmark.select(
        F.col(f"`{item}`").cast("long").alias("item"), F.col(f"`{item_text}`").alias("text")
    ).filter("item IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size <= part_bytes:
        return _search(rows, [tuple(r) for r in items.collect()])
    # several passes; rows get a number that stays, as the frame is written once
    numbered = kept(rows.withColumn("at", F.monotonically_increasing_id()), "decontaminate")
    tagged = numbered.select(F.struct("row", "at").alias("row"), "text")
    slots = -(-3 * int(size) // (2 * part_bytes))  # hashing fills some slots above the mean
    slot = F.pmod(F.xxhash64("item", "text"), F.lit(slots))
    united = None
    for k in range(slots):
        part = [tuple(r) for r in items.filter(slot == k).collect()]
        found = _search(tagged, part).filter("size(items) > 0")
        found = kept(found.select("row.at", "spans", "items"), "decontaminate-part")
        united = found if united is None else united.unionAll(found)
    united = united.groupBy("at").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    counted = _search(tagged, []).select("row.row", "row.at", "n_words")
    return counted.join(united, "at", "left").select(
        "row",
        "n_words",
        *[F.coalesce(c, F.array().cast(FOUND[c].dataType)).alias(c) for c in ("spans", "items")],
    )


def hit_words(spans: str = "spans") -> Column:
    """Words that at least one of the spans covers, spans being sorted by their start."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(s["end"], a["end"]).alias("end"),
        ),
    )["n"]


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (SHARE * n_hit >= n_words)


def drop_contaminated(df: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows that are not contaminated, with the columns they came with."""
    found = hits(df, benchmark, **names).filter(~contaminated(hit_words(), F.col("n_words")))
    return found.select([F.col("row").getField(c).alias(c) for c in df.columns])
