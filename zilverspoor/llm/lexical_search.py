"""The best documents for each query, by integer term scores, found interval by interval.

A first pass reads every text once and keeps, for each document, its length and how often it holds
the queries' terms. Counts over all documents follow from that table. A second pass takes it shard
by shard: a shard has a posting list for each term, its documents in key order, and over each list a
sparse table that gives the largest impact between any two places. The sum of these over a query's
terms bounds every score in an interval of documents. The interval with the greatest bound is split
at the document of largest impact, which is scored; its two sides get bounds of their own. Once no
bound reaches the score in last place, the rest of the shard need not be looked at. Many intervals
are split in one numpy step, the greatest bounds first, and a task carries its best documents from
shard to shard.

Queries are taken in parts of a bounded size, so neither the driver nor a task holds more of them;
each part is one pass over the texts. Shards are bounded in documents and in postings.

Defined cases: NULL and empty texts have no terms and are no documents of the statistics; a query
without terms, or whose terms no document holds, has no rows; repeated rows of documents are ranked
each, repeated queries are answered each; a NULL key comes last among equal scores; keys may be of
any type that can be sorted; empty tables give no rows; other columns don't matter.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.llm.common import (
    ALNUM,
    LOWER,
    buffers,
    give_back,
    kept,
    prefix_sums,
    ranges,
    slices,
    span_hashes,
    word_spans,
)

#: Bytes of query text that one pass over the documents answers.
PART_BYTES = 4 << 20
#: A shard has at most this many documents and about this many postings.
SHARD_DOCS, SHARD_POSTINGS = 4096, 1 << 19
#: Intervals times query terms that one numpy step splits.
STEP = 1 << 12
#: Matched words whose bytes are compared at once.
COMPARED = 1 << 16
#: First merges of the tasks' best documents, for each query.
MERGES = 64
#: Length normalisation: shares of a hundred.
LEVEL, SLOPE = 75, 25

COUNTED = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("tfs", T.ArrayType(T.IntegerType())),
    ]
)


def terms_of(texts: pa.Array) -> list[list[bytes]]:
    """The terms of each text, lower-case, in their order."""
    data, offsets = buffers(texts)
    begins, ends, before = word_spans(data, offsets, ALNUM)
    low = LOWER[data].tobytes()
    words = [low[b:e] for b, e in zip(begins.tolist(), ends.tolist())]
    return [words[a:b] for a, b in zip(before[:-1].tolist(), before[1:].tolist())]


class Vocabulary:
    """The terms of some queries, found in texts by hash and then by their bytes."""

    def __init__(self, terms: Sequence[bytes]):
        self.terms = sorted(terms)
        self.lengths = np.array([len(t) for t in self.terms], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(self.terms), np.uint8)
        hashes = span_hashes(prefix_sums(self.data), self.starts, self.starts + self.lengths)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        _, alike = np.unique(self.hashes, return_counts=True)
        self.alike = int(alike.max(initial=0))  # terms that share a hash: one, but for rare chance

    def find(self, low: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        """Which words are terms, and which terms."""
        hashes = span_hashes(prefix_sums(low), begins, ends)
        first = np.searchsorted(self.hashes, hashes)
        words, terms = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k in range(self.alike):
            at = np.flatnonzero(first + k < len(self.hashes))
            at = at[self.hashes[first[at] + k] == hashes[at]]
            term = self.order[first[at] + k]
            same = self._same(low, begins[at], ends[at] - begins[at], term)
            words.append(at[same])
            terms.append(term[same])
        return np.concatenate(words), np.concatenate(terms)

    def _same(self, low, begins, lengths, terms) -> np.ndarray:
        same = lengths == self.lengths[terms]
        for i in range(0, len(same), COMPARED):
            at = i + np.flatnonzero(same[i : i + COMPARED])
            if len(at):
                long = lengths[at]
                alike = low[ranges(begins[at], long)] == self.data[ranges(self.starts[terms[at]], long)]
                same[at] = np.logical_and.reduceat(alike, np.cumsum(long) - long)
        return same


def _counted(batch: pa.RecordBatch, known: Vocabulary) -> pa.RecordBatch:
    """For each text its number of terms, and which of the known ones it has how often."""
    data, offsets = buffers(batch.column("text"))
    begins, ends, before = word_spans(data, offsets, ALNUM)
    words, terms = known.find(LOWER[data], begins, ends)
    size = max(1, len(known.terms))
    owner = np.searchsorted(before, words, side="right") - 1
    pairs, tfs = np.unique(owner * size + terms, return_counts=True)
    bounds = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * size).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("key"),
            pa.array(np.diff(before)),
            pa.ListArray.from_arrays(bounds, pa.array((pairs % size).astype(np.int32))),
            pa.ListArray.from_arrays(bounds, pa.array(tfs.astype(np.int32))),
        ],
        names=["key", "n", "terms", "tfs"],
    )


def count_terms(docs: DataFrame, known: Sequence[bytes]) -> DataFrame:
    """``key``, ``n`` and the known terms with their counts, of all texts that have a term."""
    held = docs.sparkSession.sparkContext.broadcast(list(known))  # bounded by the size of a part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(held.value)
        for batch in slices(batches):
            yield _counted(batch, vocabulary)

    schema = T.StructType([docs.schema["key"], *COUNTED])
    return docs.mapInArrow(run, schema).filter("n > 0")


@dataclass(frozen=True)
class Ranking:
    """Queries as numbers of terms, and what all documents together say about the terms."""

    n_docs: int
    n_terms: int
    weights: np.ndarray
    #: For each query its number, its different terms and how often it has them.
    queries: list[tuple[int, np.ndarray, np.ndarray]]
    k: int

    def impacts(self, tfs: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A term's share of a score, without its weight."""
        if SLOPE * int(n.max(initial=0)) * self.n_docs < 1 << 63:
            longer = SLOPE * n * self.n_docs // self.n_terms
        else:
            longer = np.array([SLOPE * int(x) * self.n_docs // self.n_terms for x in n], np.int64)
        return 1_000_000_000 * tfs // (1000 * tfs + 12 * (LEVEL + longer))


def weight(n_docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))


class Best:
    """The best documents so far for one query."""

    def __init__(self, k: int):
        self.k = k
        self.found: list[tuple] = []

    def floor(self) -> int:
        """A score that a document must reach to come in."""
        return -self.found[-1][0] if len(self.found) == self.k else 0

    def ties_before(self, keys: list) -> int:
        """So many of a shard's documents come before the last one if their scores are equal."""
        if len(self.found) < self.k:
            return 0
        _, null, key = self.found[-1]
        return len(keys) if null else bisect_left(keys, key)

    def add(self, scores: list[int], keys: list) -> None:
        new = [(-s, key is None, key) for s, key in zip(scores, keys)]
        self.found = sorted([*self.found, *new], key=lambda x: (x[:2], () if x[1] else (x[2],)))
        del self.found[self.k :]


class Shard:
    """Posting lists of some documents, each with a sparse table of largest impacts."""

    def __init__(self, table: pa.Table, ranking: Ranking):
        table = table.take(pc.sort_indices(table, [("key", "ascending")], null_placement="at_end"))
        self.ranking = ranking
        self.keys = table.column("key").to_pylist()
        self.known = self.keys[: len(self.keys) - table.column("key").null_count]
        n = table.column("n").to_numpy()
        terms, tfs = (table.column(c).combine_chunks() for c in ("terms", "tfs"))
        doc = np.repeat(np.arange(len(n)), pc.list_value_length(terms).to_numpy())
        term = terms.flatten().to_numpy().astype(np.int64)
        impact = ranking.impacts(tfs.flatten().to_numpy().astype(np.int64), n[doc])
        use = np.flatnonzero(ranking.weights[term] > 0)
        use = use[np.argsort(term[use], kind="stable")]
        self.doc, self.size = doc[use], len(n)
        self.places = term[use] * self.size + self.doc
        self.impact = impact[use]
        lists = np.arange(len(ranking.weights) + 1) * self.size
        self.bounds = np.searchsorted(self.places, lists)
        self.table = self._sparse_table(int(np.diff(self.bounds).max(initial=0)))
        self.log = np.frexp(np.arange(self.size + 1))[1] - 1

    def _sparse_table(self, longest: int) -> np.ndarray:
        """Row j at place i: the largest impact at the 2**j places from i on, and where it is.

        Rows run over all lists on end; a look-up stays within one list.
        """
        rows = np.empty((max(1, longest.bit_length()), len(self.doc)), np.int64)
        rows[0] = self.impact << 32 | np.arange(len(self.doc))
        for j in range(1, len(rows)):
            half = 1 << j - 1
            rows[j] = rows[j - 1]
            np.maximum(rows[j - 1, :-half], rows[j - 1, half:], out=rows[j, :-half])
        return rows

    def _bounds(self, low: np.ndarray, high: np.ndarray, factors: np.ndarray):
        """Bounds of intervals, given by places in each term's list, and the documents to split at."""
        length = high - low
        j = self.log[length]
        some = length > 0
        j[~some] = 0
        left = np.minimum(low, len(self.doc) - 1)
        right = np.maximum(high - (1 << j), 0)
        top = np.where(some, np.maximum(self.table[j, left], self.table[j, right]), 0)
        parts = (top >> 32) * factors
        best = np.argmax(parts, axis=1)
        where = top[np.arange(len(top)), best] & 0xFFFFFFFF
        return parts.sum(axis=1), self.doc[where]

    def search(self, terms: np.ndarray, times: np.ndarray, best: Best) -> int:
        """Put the shard's documents that belong there among the best; gives how many were scored."""
        here = (self.bounds[terms + 1] > self.bounds[terms]) if len(self.doc) else np.zeros(len(terms), bool)
        terms, times = terms[here], times[here]
        if not len(terms):
            return 0
        factors = self.ranking.weights[terms] * times
        lists = terms * self.size
        low, high = self.bounds[terms][None, :], self.bounds[terms + 1][None, :]
        bound, split = self._bounds(low, high, factors)
        start = np.zeros(1, np.int64)
        width, scored = max(1, STEP // len(terms)), 0
        while True:
            least, ties = best.floor(), best.ties_before(self.known)
            on = (bound > least) | ((bound == least) & (start < ties))
            if not on.all():
                start, split, bound, low, high = (x[on] for x in (start, split, bound, low, high))
            if not len(bound):
                return scored
            if len(bound) > width:
                order = np.argpartition(-bound, width)
                now, later = order[:width], order[width:]
            else:
                now, later = np.arange(len(bound)), np.empty(0, np.int64)
            at, first, last = split[now], low[now], high[now]
            middle = np.searchsorted(self.places, lists + at[:, None])
            there = np.minimum(middle, len(self.doc) - 1)
            has = (middle < last) & (self.doc[there] == at[:, None])
            scores = (self.impact[there] * has * factors).sum(axis=1)
            scored += len(now)
            good = np.flatnonzero(scores >= max(1, least))
            if len(good):
                best.add(scores[good].tolist(), [self.keys[i] for i in at[good].tolist()])
            # to the left and to the right of each split document
            side_low, side_high = np.concatenate([first, middle + has]), np.concatenate([middle, last])
            side_bound, side_split = self._bounds(side_low, side_high, factors)
            start = np.concatenate([start[later], start[now], at + 1])
            split = np.concatenate([split[later], side_split])
            bound = np.concatenate([bound[later], side_bound])
            low = np.concatenate([low[later], side_low])
            high = np.concatenate([high[later], side_high])


def shards(batches: Iterator[pa.RecordBatch], ranking: Ranking) -> Iterator[Shard]:
    """Batches put together, or cut, into shards of bounded size."""
    longest = max((len(t) for _, t, _ in ranking.queries), default=1)
    most = max(1, min(SHARD_DOCS, (1 << 23) // max(1, longest)))
    held, docs, postings = [], 0, 0
    for batch in slices(batches, SHARD_POSTINGS, lambda b: pc.list_value_length(b.column("terms"))):
        for i in range(0, batch.num_rows, most):
            piece = batch.slice(i, most)
            size = len(piece.column("terms").flatten())
            if held and (docs + piece.num_rows > most or postings + size > SHARD_POSTINGS):
                yield Shard(pa.Table.from_batches(held), ranking)
                held, docs, postings = [], 0, 0
            held.append(piece)
            docs, postings = docs + piece.num_rows, postings + size
    if held:
        yield Shard(pa.Table.from_batches(held), ranking)


def rank(counted: DataFrame, ranking: Ranking) -> DataFrame:
    """``query`` (its number), ``key`` and ``score`` of every query's best documents, in each task."""
    held = counted.sparkSession.sparkContext.broadcast(ranking)  # bounded by the size of a part
    key_type = counted.schema["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking = held.value
        best = [Best(ranking.k) for _ in ranking.queries]
        kind = None
        for shard in shards(_typed(batches, kinds := []), ranking):
            kind = kinds[0]
            for (_, terms, times), found in zip(ranking.queries, best):
                shard.search(terms, times, found)
        give_back()
        rows = [
            (query, -score, key)
            for (query, _, _), found in zip(ranking.queries, best)
            for score, _, key in found.found
        ]
        if rows:
            query, score, key = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), pa.array(key, kind), pa.array(score, pa.int64())],
                names=["query", "key", "score"],
            )

    schema = T.StructType(
        [T.StructField("query", T.LongType()), key_type, T.StructField("score", T.LongType())]
    )
    return counted.filter(F.size("terms") > 0).mapInArrow(run, schema)


def _typed(batches: Iterator[pa.RecordBatch], kinds: list) -> Iterator[pa.RecordBatch]:
    """The same batches; the type of their key is noted."""
    for batch in batches:
        kinds[:] = [batch.schema.field("key").type]
        yield batch


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best of all tasks, ranked: some merges side by side for each query, then one of these."""
    order = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    first = Window.partitionBy("query", "merge").orderBy(*order)
    last = Window.partitionBy("query").orderBy(*order)
    found = found.withColumn("merge", F.pmod(F.spark_partition_id(), F.lit(MERGES)))
    for window in (first, last):
        found = found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return found.drop("merge")


def _parts(asked: DataFrame, part_bytes: int) -> Iterator[list]:
    """The queries, as many at a time as a pass may hold."""
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slots = 1 if size <= part_bytes else -(-3 * int(size) // (2 * part_bytes))
    slot = F.pmod(F.xxhash64("query", "text"), F.lit(slots))  # some slots are above the mean
    for k in range(slots):
        yield asked.filter(slot == k).select("query", "text").collect()


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``item``, ``rank``, ``key`` and ``score`` of the best documents of every query."""
    source = docs.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    asked = items.select(
        F.monotonically_increasing_id().alias("query"),
        F.col(f"`{item}`").alias("item"),
        F.col(f"`{item_text}`").alias("text"),
    )
    # queries go by a number that stays, as their frame is written once
    asked = kept(asked.filter(F.col("text").isNotNull()), "lexical-queries")
    answers = [_answers(source, queries, k) for queries in _parts(asked, part_bytes)]
    best = _merged(reduce(DataFrame.unionByName, answers), k)
    return best.join(asked.drop("text"), "query").select("item", "rank", "key", "score")


def _answers(source: DataFrame, asked: list, k: int) -> DataFrame:
    """One pass over the texts for the queries of a part."""
    words = terms_of(pa.array([q["text"] for q in asked], pa.string()))
    known = sorted({w for ws in words for w in ws})
    number = {w: i for i, w in enumerate(known)}
    counted = kept(count_terms(source, known), "lexical-search")
    total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holders = counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    weights = np.zeros(len(known), np.int64)
    for t, n in holders:  # one for each term of the part
        weights[t] = weight(total[0], n)
    queries = []
    for q, ws in zip(asked, words):
        terms, times = np.unique(np.array([number[w] for w in ws], np.int64), return_counts=True)
        use = weights[terms] > 0
        queries.append((q["query"], terms[use], times[use]))
    return rank(counted, Ranking(total[0], max(1, int(total[1])), weights, queries, k))
