"""Language-model scoring with an Elias-Fano n-gram trie.

Level 1 holds the distinct words (as 64-bit hashes) with their counts, level k all n-grams of k
words, also those that occur once, as successors of their contexts on level k - 1. Each level is cut into as many shards as shuffles have partitions. A shard is a file that readers map into
memory: Elias-Fano sequences of contexts, of pointers to each context's successors, and of these
successors, made monotone over all contexts; quantised probabilities; Elias-Fano sums of counts. A
look-up finds the context, then the successor relative to it.

A context's successors are in one shard, but a context that holds more than a quarter of a shard's
share of all tokens (there are few of them by this rule) has them dealt over all shards.

The probability of a word interpolates: the discounted share of its n-gram, if known, plus the share
the context has left over, times the probability after the context without its first word; at the
bottom stands add-one smoothing. Shares are rounded down to 255 steps of their logarithm, so the
probabilities of all words never add up to more than one.

Counting is one pass over the texts for each level: tasks count what a few million tokens hold and
send each shard one block of sorted numbers; a shard merges its blocks.

Defined cases: NULL and empty texts are their end token; without training texts every token is
unknown; repeated rows count and are scored again; an empty table gives no rows; other columns are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zilverspoor.llm.common import (
    LOWER,
    SOLID,
    buffers,
    file_bytes,
    mix,
    prefix_sums,
    slices,
    span_hashes,
    texts,
    word_spans,
    write_once,
)
from zilverspoor.llm.elias_fano import EliasFano, pack, unpack
from zilverspoor.session import run_dir

ORDER = 3
#: Least count of an n-gram (nothing is left out), and what is taken off a count.
LEAST, DISCOUNT = 1, 0.5
#: Tokens that a task counts before it sends blocks off.
TOKENS = 2_000_000
#: Bytes of text that are looked up at once: the more, the more look-ups a shard gets together.
SLICE = 8 << 20
#: Bytes of text that are hashed at once.
NEAR = 1 << 18
#: A context with fewer tokens is never dealt over all shards.
LEAST_HOT = 1000
#: Hash of the end token; that of a word takes another value but for one chance in 2^64.
END = np.uint64(0x5851F42D4C957F2D)
#: Steps of quantised logarithms, and the lowest logarithm.
STEPS, LOWEST = 255, -8.0

U = np.uint64


def quantised(share: np.ndarray) -> np.ndarray:
    """Steps of log10, rounded down; 0 stands for nothing."""
    with np.errstate(divide="ignore"):
        step = np.floor((np.log10(share) - LOWEST) / -LOWEST * (STEPS - 1)) + 1
    return np.clip(np.nan_to_num(step, neginf=0), 0, STEPS).astype(np.uint8)


SHARES = np.concatenate([[0.0], 10 ** (LOWEST - LOWEST / (STEPS - 1) * np.arange(STEPS))])


@dataclass
class Level:
    """What the driver knows of a level: files and first node of each shard, and hot contexts."""

    folder: str
    files: list[str | None]
    bases: list[int]
    hot: list[int]  # nodes whose successors are dealt over all shards
    hot_sums: dict[int, float]  # kept shares of contexts that were dealt over this level's shards
    tokens: int


_open: dict[tuple[str, str], dict] = {}


def shard_arrays(folder: str, name: str) -> dict:
    if (folder, name) not in _open:
        arrays = unpack(file_bytes(folder, name))
        names = {n.partition(".")[0] for n in arrays if "." in n}
        _open[folder, name] = {n: EliasFano.of(arrays, n) for n in names} | {
            n: a for n, a in arrays.items() if "." not in n
        }
    return _open[folder, name]


def deal(parents: np.ndarray, words: np.ndarray, shards: int, hot: np.ndarray) -> np.ndarray:
    """The shard of each successor: by its context, or by both if the context is hot."""
    where = mix(parents.astype(np.uint64))
    if len(hot):
        at = np.minimum(np.searchsorted(hot, parents), len(hot) - 1)
        spread = np.flatnonzero(hot[at] == parents)
        where[spread] = mix(where[spread] + words[spread].astype(np.uint64))
    return (where >> U(32)) * U(shards) >> U(32)


class Trie:
    """The levels built so far, read from their files."""

    def __init__(self, levels: list[Level]):
        self.levels = levels
        self.shards = len(levels[0].files)
        self.hot = [np.array(level.hot, np.int64) for level in levels]
        self.words = levels[0].bases[-1]
        # what hot contexts leave over, their successors being in many shards
        self.dealt = [np.array(sorted(level.hot_sums), np.int64) for level in levels]
        self.dealt_left = [
            SHARES[quantised(np.array([max(0.0, 1 - level.hot_sums[n]) for n in nodes.tolist()]))]
            for level, nodes in zip(levels, self.dealt)
        ]

    def _groups(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(shard.astype(np.uint16 if self.shards < 65536 else np.int64), kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            yield int(s), order[cuts[s] : cuts[s + 1]]

    def vocabulary(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node (or -1) and count (or 0) of sorted different words."""
        level = self.levels[0]
        nodes, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for s, at in self._groups((hashes >> U(32)) * U(self.shards) >> U(32)):
            if level.files[s] is None:
                continue
            held = shard_arrays(level.folder, level.files[s])
            found = held["words"].find(hashes[at])
            good = found >= 0
            nodes[at[good]] = found[good] + level.bases[s]
            counts[at[good]] = _differences(held["sums"], found[good])
        return nodes, counts

    def counts(self, k: int, nodes: np.ndarray) -> np.ndarray:
        """Counts of nodes of level k."""
        level, out = self.levels[k - 1], np.zeros(len(nodes), np.int64)
        bases = np.array(level.bases)
        for s, at in self._groups(np.searchsorted(bases, nodes, side="right") - 1):
            held = shard_arrays(level.folder, level.files[s])
            out[at] = _differences(held["sums"], nodes[at] - level.bases[s])
        return out

    def successors(
        self, k: int, parents: np.ndarray, words: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes of level k (or -1) below nodes of level k - 1; the share each has, and the share
        its context leaves over.

        Equal pairs are looked up once, and in order, so that a shard is read from front to back.
        """
        order, heads = _in_order(parents, words, self.words)
        first = order[heads]
        found = self._in_shards(k, parents[first], words[first])
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(heads) - 1
        return tuple(x[which] for x in found)

    def _in_shards(
        self, k: int, parents: np.ndarray, words: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        level = self.levels[k - 1]
        nodes = np.full(len(parents), -1, np.int64)
        share, left = np.zeros(len(parents)), np.ones(len(parents))
        hot = self.hot[k - 2]
        for s, at in self._groups(deal(parents, words, self.shards, hot)):
            if level.files[s] is None:
                continue
            held = shard_arrays(level.folder, level.files[s])
            context, each = runs(parents[at])
            inverse = np.repeat(np.arange(len(context)), each)
            place = held["contexts"].find(context)
            known = place >= 0
            first, last = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            first[known] = held["pointers"].get(place[known])
            last[known] = held["pointers"].get(place[known] + 1)
            over = np.ones(len(place))
            over[known] = SHARES[held["left"][place[known]]]
            left[at] = over[inverse]
            own = np.flatnonzero(known[inverse])
            which = inverse[own]
            wanted = place[which] * self.words + words[at[own]]
            found = held["successors"].find(wanted, first[which], last[which])
            good = found >= 0
            target = at[own[good]]
            nodes[target] = found[good] + level.bases[s]
            share[target] = SHARES[held["shares"][found[good]]]
        if len(dealt := self.dealt[k - 1]):
            at = np.minimum(np.searchsorted(dealt, parents), len(dealt) - 1)
            left = np.where(dealt[at] == parents, self.dealt_left[k - 1][at], left)
        return nodes, share, left


def _in_order(
    parents: np.ndarray, words: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """The order of pairs whose words are below ``size``, and where in it a new pair begins."""
    if not len(parents):
        return np.empty(0, np.int64), np.empty(0, bool)
    if (int(parents.max()) + 1) * size < 1 << 63:  # a pair fits into one number
        pair = parents * size + words
        order = np.argsort(pair)
        pair = pair[order]
        new = pair[1:] != pair[:-1]
    else:
        order = np.lexsort((words, parents))
        new = (np.diff(parents[order]) != 0) | (np.diff(words[order]) != 0)
    return order, np.concatenate([[True], new])


def _differences(sums: EliasFano, i: np.ndarray) -> np.ndarray:
    return (sums.get(i + 1) - sums.get(i)).astype(np.int64)


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens and the number of tokens before each text."""
    data, offsets = buffers(column)
    parts, counts = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)]
    first = 0
    while first < len(column):  # a few texts at a time, so sums stay in the processor's cache
        last = int(np.searchsorted(offsets, offsets[first] + NEAR, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        near = LOWER[data[offsets[first] : offsets[last]]]
        begins, ends, before = word_spans(near, offsets[first : last + 1] - offsets[first], SOLID)
        parts.append(span_hashes(prefix_sums(near), begins, ends))
        counts.append(np.diff(before))
        first = last
    hashes, before = np.concatenate(parts), np.cumsum(np.concatenate(counts))
    bounds = before + np.arange(len(before))
    out = np.full(len(hashes) + len(before) - 1, END, np.uint64)
    is_word = np.ones(len(out), bool)
    is_word[bounds[1:] - 1] = False
    out[is_word] = hashes
    return out, bounds


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different values, and where each value is among them."""
    coded = pa.array(values).dictionary_encode()
    found = coded.dictionary.to_numpy(zero_copy_only=False)
    order = np.argsort(found)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return found[order], rank[coded.indices.to_numpy(zero_copy_only=False)]


def runs(ranked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of a sorted array, and how often each occurs."""
    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])[: len(ranked)])
    return ranked[heads], np.diff(np.append(heads, len(ranked)))


class Path:
    """For each token the nodes of the n-grams that end in it, level by level."""

    def __init__(self, trie: Trie, hashes: np.ndarray, bounds: np.ndarray):
        different, inverse = distinct(hashes)
        nodes, counts = trie.vocabulary(different)
        self.trie, self.word, self.count = trie, nodes[inverse], counts[inverse]
        self.place = np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))
        self.node = self.word  # of the n-gram of the level reached that ends in each token
        self.level = 1

    def candidates(self) -> np.ndarray:
        """Tokens at which an n-gram one word longer than the level reached ends."""
        at = np.flatnonzero(self.place >= self.level)
        return at[(self.node[at] >= 0) & (self.node[at - 1] >= 0)]

    def climb(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Reach the next level: tokens with a known context, the share of each and what is left."""
        k = self.level
        at = np.flatnonzero(self.place >= k)
        at = at[self.node[at - 1] >= 0]
        word = np.where(self.word[at] >= 0, self.word[at], 0)
        nodes, share, left = self.trie.successors(k + 1, self.node[at - 1], word)
        unknown = self.word[at] < 0
        nodes[unknown], share[unknown] = -1, 0.0
        node = np.full(len(self.word), -1, np.int64)
        node[at] = nodes
        self.node, self.level = node, k + 1
        return at, share, left


# Building


def _counted(
    parents: np.ndarray, words: np.ndarray, counts: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs in order with the sums of their counts (None: one each)."""
    if not len(parents):
        return parents, words, np.empty(0, np.int64)
    size = int(words.max()) + 1 if words.dtype != np.uint64 else 1 << 64
    if (int(parents.max()) + 1) * size < 1 << 63:  # a pair fits into one number
        pair = parents * size + words
        if counts is None:
            pair, counts = runs(np.sort(pair))
        else:
            order = np.argsort(pair)
            pair = pair[order]
            heads = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            pair, counts = pair[heads], np.add.reduceat(counts[order], heads)
        return pair // size, pair % size, counts
    order = np.lexsort((words, parents))
    parents, words = parents[order], words[order]
    heads = np.flatnonzero(
        np.concatenate([[True], (parents[1:] != parents[:-1]) | (words[1:] != words[:-1])])
    )
    if counts is None:
        counts = np.diff(np.append(heads, len(order)))
    else:
        counts = np.add.reduceat(counts[order], heads)
    return parents[heads], words[heads], counts


def _blocks(
    parents: np.ndarray, words: np.ndarray, counts: np.ndarray, shard: np.ndarray, shards: int
) -> pa.RecordBatch:
    """One block for each shard; pairs come in order and stay so."""
    order = np.argsort(shard.astype(np.uint16 if shards < 65536 else np.int64), kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    filled = np.flatnonzero(np.diff(cuts))
    out = []
    for s in filled:
        at = order[cuts[s] : cuts[s + 1]]
        w, c = words[at], counts[at]
        # contexts once, as steps from one to the next, with the number of their successors
        p, each = runs(parents[at])
        steps = np.diff(p, prepend=0)
        columns = {"steps": steps, "each": each, "words": w, "counts": c}
        out.append(pack({name: _narrow(x) for name, x in columns.items()}))
    return pa.RecordBatch.from_arrays(
        [pa.array(filled.astype(np.int32)), pa.array(out, pa.binary())], names=["shard", "block"]
    )


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Numbers from zero on in the fewest bytes that hold all of them."""
    most = int(numbers.max(initial=0))
    return numbers.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def _merge(blocks: list[bytes], kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    each = [unpack(np.frombuffer(b, np.uint8)) for b in blocks]
    contexts = [np.cumsum(e["steps"].astype(np.int64)) for e in each]
    parents = np.concatenate([np.repeat(c, e["each"].astype(np.int64)) for c, e in zip(contexts, each)])
    counts = np.concatenate([e["counts"].astype(np.int64) for e in each])
    words = np.concatenate([e["words"].astype(kind) for e in each])
    return _counted(parents, words, counts)


def _count(docs: DataFrame, levels: list[Level], shards: int) -> DataFrame:
    """Blocks of the n-grams one word longer than the levels go, by shard."""
    trie_of = docs.sparkSession.sparkContext.broadcast(levels)  # file names and hot contexts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trie_of.value
        trie = Trie(known) if known else None
        held: list = []
        size = 0

        def flush() -> pa.RecordBatch:
            if trie is None:
                words, counts = runs(np.sort(np.concatenate(held)))
                parents = np.zeros(len(words), np.int64)
                shard = (words >> U(32)) * U(shards) >> U(32)
            else:
                both = [np.concatenate(x) for x in zip(*held)]
                parents, words, counts = _counted(*both, None)
                shard = deal(parents, words, shards, trie.hot[len(known) - 1])
            return _blocks(parents, words, counts, shard, shards)

        for batch in slices(batches, SLICE):
            hashes, bounds = tokens_of(batch.column("text"))
            if trie is None:
                held.append(hashes)
                size += len(hashes)
            else:
                path = Path(trie, hashes, bounds)
                while path.level < len(known):
                    path.climb()
                at = path.candidates()
                held.append((path.node[at - 1], path.word[at]))
                size += len(at)
            if size >= TOKENS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return docs.select("text").mapInArrow(run, "shard int, block binary")


def _build(docs: DataFrame, levels: list[Level], shards: int, folder: str) -> Level:
    spark = docs.sparkSession
    order = len(levels) + 1
    trie_of = spark.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trie_of.value
        trie = Trie(known) if known else None
        held: list[bytes] = []
        current = None

        def close() -> pa.RecordBatch:
            row = _shard(folder, current, held, trie, order, known, shards)
            return pa.RecordBatch.from_pylist([row], schema=described)

        for batch in batches:
            for shard, block in zip(batch.column("shard").to_pylist(), batch.column("block")):
                if shard != current and held:
                    yield close()
                    held = []
                current = shard
                held.append(block.as_py())
        if held:
            yield close()

    described = pa.schema([
        ("shard", pa.int32()), ("file", pa.string()), ("n", pa.int64()), ("tokens", pa.int64()),
        ("hot", pa.list_(pa.int64())), ("hot_counts", pa.list_(pa.int64())),
        ("dealt", pa.list_(pa.int64())), ("dealt_sums", pa.list_(pa.float64())),
    ])
    rows = (
        _count(docs, levels, shards)
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(
            run,
            "shard int, file string, n long, tokens long, hot array<long>, "
            "hot_counts array<long>, dealt array<long>, dealt_sums array<double>",
        )
        .collect()  # a row for each shard
    )
    files: list[str | None] = [None] * shards
    sizes = [0] * shards
    for r in rows:
        files[r["shard"]], sizes[r["shard"]] = r["file"], r["n"]
    bases = [0, *np.cumsum(sizes).tolist()]
    tokens = sum(r["tokens"] for r in rows)
    total = levels[0].tokens if levels else tokens
    limit = max(LEAST_HOT, total // (4 * shards))
    hot = sorted(
        bases[r["shard"]] + node
        for r in rows
        for node, count in zip(r["hot"], r["hot_counts"])
        if count >= limit
    )
    sums: dict[int, float] = {}
    for r in rows:
        for node, part in zip(r["dealt"], r["dealt_sums"]):
            sums[node] = sums.get(node, 0.0) + part
    return Level(folder, files, bases, hot, sums, tokens)


def _shard(folder, shard, blocks, trie, order, known, shards) -> dict:
    """Merge a shard's blocks, write its file and say what it holds."""
    parents, words, counts = _merge(blocks, np.uint64 if order == 1 else np.int64)
    tokens = int(counts.sum())
    dealt, dealt_sums = [], []
    if order == 1:
        arrays = EliasFano.build(words, 1 << 64).arrays("words")
    else:
        context, each = runs(parents)
        inverse = np.repeat(np.arange(len(context)), each)
        share = (counts - DISCOUNT) / trie.counts(order - 1, context)[inverse]
        kept_share = np.bincount(inverse, share, minlength=len(context))
        hot = np.isin(context, trie.hot[order - 2])
        dealt, dealt_sums = context[hot].tolist(), kept_share[hot].tolist()
        pointers = np.concatenate([[0], np.cumsum(each)])
        moved = inverse * trie.words + words
        arrays = (
            EliasFano.build(context, max(1, known[-1].bases[-1])).arrays("contexts")
            | EliasFano.build(pointers, len(words) + 1).arrays("pointers")
            | EliasFano.build(moved, max(1, len(context) * trie.words)).arrays("successors")
            | {"shares": quantised(share), "left": quantised(np.maximum(0.0, 1 - kept_share))}
        )
    sums = np.concatenate([[0], np.cumsum(counts)])
    arrays |= EliasFano.build(sums, int(sums[-1]) + 1).arrays("sums")
    name = write_once(folder, f"level{order}-{shard}", iter([pack(arrays)]))
    # on level 1 the number of all tokens is not known yet: the driver compares with it
    top = np.flatnonzero(counts >= max(LEAST_HOT, known[0].tokens // (4 * shards) if known else 0))
    return {
        "shard": shard, "file": name, "n": len(counts), "tokens": tokens,
        "hot": top.tolist(), "hot_counts": counts[top].tolist(),
        "dealt": dealt, "dealt_sums": dealt_sums,
    }


def train(
    docs: DataFrame, text: str = "text", order: int = ORDER, shards: int | None = None
) -> list[Level]:
    """Build the trie of all texts, level by level, in the shared folder."""
    spark = docs.sparkSession
    shards = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    folder = run_dir(spark, "ngram-trie")
    source = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    levels: list[Level] = []
    while len(levels) < order:
        levels.append(_build(source, levels, shards, folder))
    return levels


SCORED = (
    "n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score(
    docs: DataFrame, levels: list[Level], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Key, tokens, known tokens, the add-one unigram score and the model's score of each text."""
    source = texts(docs, key, text)
    model = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = model.value
        trie = Trie(levels)
        total = levels[0].tokens
        for batch in slices(batches, SLICE):
            hashes, bounds = tokens_of(batch.column("text"))
            path = Path(trie, hashes, bounds)
            base = (path.count + 1) / (total + trie.words + 1)
            probability = base.copy()
            while path.level < len(levels):
                at, share, left = path.climb()
                probability[at] = share + left * probability[at]
            known = np.concatenate([[0], np.cumsum(path.count > 0)])
            out = [np.add.reduceat(np.log10(x), bounds[:-1]) for x in (base, probability)]
            n = np.diff(bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(n), pa.array(np.diff(known[bounds])),
                 pa.array(np.full(len(n), total)), pa.array(out[0]), pa.array(out[1])],
                names=["key", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, {SCORED}").withColumnRenamed("key", key)
