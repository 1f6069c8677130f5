"""Near-duplicate classes by BagMinHash: signatures of weighted sets, bands, verified overlap.

A text is the multiset of its five-word shingles, the weight of a shingle being how often it
occurs. Weights are discretised into the dyadic intervals [0, 1), [1, 2), [2, 4), ...; each
interval of each shingle carries a Poisson process of points that depends on the shingle only. A
point has a place in its interval, counts if the weight reaches it, and belongs to one of the
signature's components; a component keeps its first point. So two texts agree in a component with
the probability of their weighted Jaccard similarity. Points come in rising order and are drawn only
as far as a bound that a text's total weight gives; where a component is still empty, the bound
doubles.

Texts of the same words are one node from the start. Nodes that agree in a band share a bucket. In
each bucket all nodes are compared with one of them, that which shares most buckets, so a group of
near copies costs one comparison a copy and band at most; classes are the connected components of
the pairs whose multiset overlap is ``SIMILARITY`` or more. Only where a bucket still holds several
components are the pairs across them compared, too (without pairs that an exact bound rules out), so
that no link is lost that the bands show.

Defined cases: words are letters and digits, lower-cased; a text of fewer than five words is one
shingle; NULL, empty and wordless texts are classes of their own; repeated rows are one class; a
class is named by its least key, NULL keys coming last; keys are whole numbers, and a text that is
none is an error; an empty table gives no rows; other columns pass through :func:`drop_duplicates`
and don't matter elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.llm.common import (
    ALNUM,
    LOWER,
    buffers,
    chained,
    fresh,
    kept,
    mix,
    prefix_sums,
    slices,
    span_hashes,
    word_spans,
)

SHINGLE = 5
SIMILARITY = 0.8
#: Components of a signature, and the share of pairs just at the similarity that bands may miss: at
#: 0.8, 20 bands of 4 show a pair with probability 0.99997.
COMPONENTS, MISSED = 80, 3e-5
#: Bytes of text that are signed at once; short texts make a thousand points a kilobyte.
SIGNED_BYTES = 1 << 20

U = np.uint64


# Signatures


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of texts, the text of each, and a 16-byte digest of each text's words."""
    data, offsets = buffers(column)
    data = LOWER[data]
    begins, ends, before = word_spans(data, offsets, ALNUM)
    words = span_hashes(prefix_sums(data), begins, ends)
    n = np.diff(before)
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(words)) - before[owner]
    digest = np.zeros((len(n), 2), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        for k, salt in enumerate((0x1234567, 0x89ABCDEF)):
            each = mix(words ^ mix(place.astype(np.uint64) + U(salt)))
            digest[some, k] = np.add.reduceat(each, before[some])
    runs = chained(words, SHINGLE)
    whole = np.flatnonzero(n[owner] - place >= SHINGLE) if len(words) else np.empty(0, np.int64)
    hashes, texts = runs[whole], owner[whole]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        hashes = np.concatenate([hashes, digest[short, 0]])
        texts = np.concatenate([texts, short])
    return hashes, texts, digest


def bags(hashes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text, the text, and how often it has them; sorted."""
    order = np.lexsort((hashes, texts))
    h, t = hashes[order], texts[order]
    heads = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])[: len(h)])
    return h[heads], t[heads], np.diff(np.append(heads, len(h)))


def _unit(x: np.ndarray) -> np.ndarray:
    """Numbers above 0 and up to 1 from hashes."""
    return ((x >> U(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(
    hashes: np.ndarray, texts: np.ndarray, counts: np.ndarray, n_texts: int, m: int = COMPONENTS
) -> np.ndarray:
    """BagMinHash: for each text the identities of the first points of its m components."""
    out = np.zeros((n_texts, m), np.uint64)
    total = np.bincount(texts, counts, minlength=n_texts)
    # an element is a shingle with one of the intervals its weight reaches
    reach = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1
    element = np.repeat(np.arange(len(hashes)), reach)
    level = np.arange(len(element)) - np.repeat(np.cumsum(reach) - reach, reach)
    seed = mix(hashes[element] + mix(level.astype(np.uint64) + U(77)))
    width = np.where(level == 0, 1.0, 2.0 ** (level - 1))
    start = np.where(level == 0, 0.0, width)
    text, weight = texts[element], counts[element]
    pending = np.flatnonzero(total > 0)
    slack = 3.0
    while len(pending):
        bound = np.zeros(n_texts)
        bound[pending] = m * (np.log(m) + slack) / total[pending]
        active = np.flatnonzero(bound[text] > 0)
        x = np.zeros(len(active))
        first = np.full(n_texts * m, np.inf)
        found: list[tuple] = []
        i = 0
        while len(active):
            i += 1
            point = mix(seed[active] + U(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            x = x - np.log(_unit(point)) / width[active]
            near = x <= bound[text[active]]
            active, x, point = active[near], x[near], point[near]
            where = mix(point + U(0x632BE59BD9B4E019))
            place = start[active] + width[active] * _unit(mix(where + U(1)))
            counted = (place <= weight[active]) | (level[active] == 0)
            cell = text[active] * m + (where % U(m)).astype(np.int64)
            np.minimum.at(first, cell[counted], x[counted])
            found.append((cell[counted], x[counted], point[counted]))
        for cell, at, point in found:
            winner = at == first[cell]
            out.reshape(-1)[cell[winner]] = point[winner]
        empty = np.isinf(first.reshape(n_texts, m)).any(axis=1)
        pending = pending[empty[pending]]
        slack = 2 * slack + np.log(m)
    return out


def band_rows(similarity: float) -> int:
    """Components of a band: as many as still show all but ``MISSED`` of the pairs."""
    sizes = [r for r in range(1, COMPONENTS + 1) if COMPONENTS % r == 0]
    good = [r for r in sizes if (1 - similarity**r) ** (COMPONENTS // r) <= MISSED]
    return max(good, default=1)


def _sign(batch: pa.RecordBatch, rows: int) -> pa.RecordBatch:
    hashes, texts, digest = shingles(batch.column("text"))
    n = batch.num_rows
    h, t, c = bags(hashes, texts)
    points = signatures(h, t, c, n)
    keys = points.reshape(n, COMPONENTS // rows, rows)
    bands = keys[:, :, 0].copy()
    for k in range(1, rows):
        bands = mix(bands * U(0xD6E8FEB86659FD93) + keys[:, :, k])
    size = np.bincount(texts, minlength=n)
    none = size == 0
    flat = pa.array(bands.reshape(-1).view(np.int64))
    starts = pa.array(np.arange(n + 1, dtype=np.int32) * bands.shape[1])
    each = pa.ListArray.from_arrays(starts, flat)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("key"),
            pa.array([None if e else d.tobytes() for d, e in zip(digest, none)], pa.binary()),
            pa.array(size.astype(np.int64)),
            each,
        ],
        names=["key", "node", "size", "bands"],
    )


SIGNED = "size long, bands array<long>"


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(
        F.col(f"`{key}`").cast("long").alias("key"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )


def signed(df: DataFrame, key: str, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """Key, node (a digest of the words; NULL without words), shingles and band hashes."""
    rows = band_rows(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SIGNED_BYTES):
            yield _sign(batch, rows)

    return _texts(df, key, text).mapInArrow(run, "key long, node binary, " + SIGNED)


def _with_nodes(df: DataFrame, text: str, name: str) -> DataFrame:
    """The rows, as a struct, with the node of their text."""
    whole = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, texts, digest = shingles(batch.column("text"))
            none = np.bincount(texts, minlength=batch.num_rows) == 0
            nodes = [None if e else d.tobytes() for d, e in zip(digest, none)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(nodes, pa.binary())], names=["row", name]
            )

    schema = T.StructType([whole.schema["row"], T.StructField(name, T.BinaryType())])
    return whole.mapInArrow(run, schema)


# Verification


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of pairs of texts."""
    n = len(left)
    parts = []
    for column in (left, right):
        hashes, texts, _ = shingles(column)
        parts.append(bags(hashes, texts))
    h = np.concatenate([p[0] for p in parts])
    t = np.concatenate([p[1] for p in parts])
    c = np.concatenate([p[2] for p in parts])
    order = np.lexsort((h, t))
    h, t, c = h[order], t[order], c[order]
    both = np.flatnonzero((h[1:] == h[:-1]) & (t[1:] == t[:-1]))
    common = np.bincount(t[both], np.minimum(c[both], c[both + 1]), minlength=n)
    total = np.bincount(t, c, minlength=n) - common
    return np.where(total > 0, common / np.maximum(total, 1), 0.0)


def _alike(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts overlap enough. ``texts`` has node and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SIGNED_BYTES):
            good = similarities(batch.column("text"), batch.column("other")) >= similarity
            yield batch.select(["a", "b"]).filter(pa.array(good))

    one = texts.select(F.col("node").alias("a"), "text")
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "text", "other")
    return both.mapInArrow(run, "a binary, b binary")


# Components


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Node and the least node of its component, for nodes with edges.

    Large and small star steps in turn: every edge moves towards the least node of its component,
    and nothing but one minimum for each node is ever gathered. With a number of ``rounds`` the
    steps end there: a root is then some node of the component, and the result, taken as edges,
    connects what the edges connect.
    """
    flat = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    flat = kept(flat.filter("a <> b").distinct(), "components")
    state, done = None, 0
    while True:
        both = flat.union(flat.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("b", "m").union(small.select("a", "m")).toDF("a", "b")
        flat = kept(small.filter("a <> b").distinct(), "components")
        done += 1
        now = None if rounds else flat.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if done == rounds or now == state and not rounds:
            return flat.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _labelled(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The nodes with their root in the column ``root``, or the node itself."""
    # a node that is a root has no row but may still have one before the steps have ended
    least = roots.groupBy("node").agg(F.min("root").alias("root"))
    return nodes.join(least, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _stars(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the one that shares most buckets, the likely original."""
    head = members.groupBy("band", "bucket").agg(F.max(F.struct("weight", "node")).alias("h"))
    pairs = members.join(head, ["band", "bucket"]).filter(F.col("node") != F.col("h.node"))
    return pairs.select(F.col("node").alias("a"), F.col("h.node").alias("b")).distinct()


def _reachable(members: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """Members without those that can't be similar to any other one.

    Whatever a text overlaps with lies in the shingles that other texts have as well. Where these
    are too small a part of it, no partner reaches the similarity: an exact bound, counted once for
    each shingle, that takes the many faint copies of a passage away before pairs are formed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, texts, _ = shingles(batch.column("text"))
            h, t, c = bags(hashes, texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(t)), pa.array(h.view(np.int64)), pa.array(c)],
                names=["node", "shingle", "n"],
            )

    nodes = members.select("node", "size").distinct()
    held = bodies.join(nodes.select("node"), "node").select("node", "text")
    held = kept(held.mapInArrow(run, "node binary, shingle long, n long"), "shingles")
    shared = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1")
    covered = held.join(shared.select("shingle"), "shingle").groupBy("node").agg(F.sum("n").alias("n"))
    good = nodes.join(covered, "node").filter(F.col("n") >= similarity * F.col("size") - 1e-9)
    return members.join(good.select("node", F.col("n").alias("shared")), "node")


def _open(members: DataFrame) -> DataFrame:
    """Members of buckets that hold several components."""
    mixed = members.groupBy("band", "bucket").agg(
        F.min("root").alias("low"), F.max("root").alias("high")
    )
    mixed = mixed.filter("low <> high").select("band", "bucket")
    return members.join(mixed, ["band", "bucket"])


_COMPARED = ("node", "root", "size", "shared", "bands")


def classes(
    df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row for each row of the frame: key, node and class (the least key of it)."""
    marks = kept(signed(df, key, text, similarity), "signatures")
    worded = marks.filter("node IS NOT NULL")
    # one row for each different text, its copies being in one class anyway
    nodes = worded.groupBy("node").agg(F.min("key").alias("key"))
    rows = worded.select("node", "key", "size", "bands")
    rows = rows.join(nodes.select("node", F.col("key").alias("least")), "node")
    rows = rows.filter(F.col("key").eqNullSafe(F.col("least"))).dropDuplicates(["node"])
    rows = kept(rows.select("node", "key", "size", "bands"), "nodes")
    slots = rows.select("node", "size", F.posexplode("bands").alias("band", "bucket"))
    filled = slots.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    slots = slots.join(filled, ["band", "bucket"])
    weights = slots.groupBy("node").agg(F.sum("n").alias("weight"))
    slots = kept(slots.drop("n").join(weights, "node"), "buckets")
    # the texts that comparisons read
    wanted = slots.select("node").distinct().join(rows.select("node", "key"), "node")
    source = _with_nodes(df.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text")
    ), "text", "node")
    source = source.filter("node IS NOT NULL").select("node", "row.key", "row.text")
    bodies = wanted.join(
        source, (wanted["node"] == source["node"]) & wanted["key"].eqNullSafe(source["key"])
    ).select(wanted["node"], source["text"])
    bodies = kept(bodies.dropDuplicates(["node"]), "texts")

    # two rounds join nearly all of a group; what they leave apart is compared for nothing only
    joined = components(_alike(_stars(slots), bodies, similarity), rounds=2)
    root = kept(_open(_labelled(slots, joined)), "open")
    root = kept(_open(_reachable(root, bodies, similarity)), "open")
    # buckets that still hold several components: all pairs across them
    root = root.join(rows.select("node", "bands"), "node")
    one = root.select("band", "bucket", *[F.col(c).alias(f"{c}_a") for c in _COMPARED])
    two = root.select("band", "bucket", *[F.col(c).alias(f"{c}_b") for c in _COMPARED])
    # an overlap has at most what the one shares with anybody, which bounds the similarity
    most = F.least("shared_a", "shared_b")
    same_bands = F.zip_with("bands_a", "bands_b", lambda x, y: x == y)
    across = one.join(
        two,
        (one["band"] == two["band"])
        & (one["bucket"] == two["bucket"])
        & (F.col("root_a") < F.col("root_b"))
        & (most >= similarity * (F.col("size_a") + F.col("size_b") - most) - 1e-9)
        # a pair comes from the first band that shows it
        & (F.array_position(same_bands, True) - 1 == one["band"]),
    )
    across = kept(across.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")), "across")
    edges = joined.toDF("a", "b").union(_alike(across, bodies, similarity))
    roots = _labelled(rows.select("node", "key"), components(edges))
    named = roots.groupBy("root").agg(F.min("key").alias("class"))
    named = roots.select("node", "root").join(named, "root").select("node", "class")
    with_words = worded.select("key", "node").join(named, "node").select("key", "node", "class")
    without = marks.filter("node IS NULL").select("key", "node", F.col("key").alias("class"))
    return with_words.union(without)


def drop_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row of each class, that with the least key, and all rows without words."""
    found = classes(df, key, text, similarity)
    first = (
        found.filter("node IS NOT NULL")
        .groupBy("class")
        .agg(F.min(F.struct(F.col("key").isNull().alias("n"), "key", "node")).alias("f"))
        .select("f.key", "f.node")
    )
    name = fresh(df, "node_")
    rows = _with_nodes(df, text, name)
    own = F.col("row").getField(key).cast("long")
    worded = rows.filter(F.col(name).isNotNull()).withColumn("own", own)
    held = worded.join(
        first, (F.col(name) == F.col("node")) & F.col("own").eqNullSafe(F.col("key")), "left_semi"
    ).dropDuplicates([name, "own"])
    out = held.select("row").union(rows.filter(F.col(name).isNull()).select("row"))
    return out.select([F.col("row").getField(c).alias(c) for c in df.columns])
