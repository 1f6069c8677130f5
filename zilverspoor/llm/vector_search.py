"""The vectors with the largest inner products with each query, exactly, by trees of boxes.

Vectors are rounded down to whole numbers, so scores are exact. They are dealt to shards of bounded
size: a few planes, fitted on a sample, put neighbours together, and what still exceeds a shard is
dealt evenly over several. Each shard gets a KD-tree: nodes are halved at the median of the axis on
which their points spread most, and every node keeps the tight box of its points. The largest inner
product that a query can have within a box bounds all scores below a node, so a search takes nodes
in the order of their bounds and ends when no bound reaches the k-th score found.

A query first searches the shard with the greatest bound. With its k-th score it then goes only to
shards whose box still reaches it. Queries meet a shard in blocks of bounded size, so a shard that
all queries ask for is no single task.

Defined cases: vectors that are NULL or hold a NULL, a component that is not finite or whose rounded
value is no 64-bit number take no part, nor does a NULL key; vectors meet those of their own length
only, and empty ones have the score 0; repeated keys are points of their own, but a query never gets
a row of its own key; repeated query rows are answered each; scores beyond 64 bits are the largest
or least such number; ties go to the smaller key; an empty table gives no rows; keys may be of any
type that can be sorted; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.llm.common import give_back, kept

#: Components times this, rounded down, are the whole numbers that count.
SCALE = 1024
#: Components of a shard's points, and of the queries that meet it in one task.
SHARD_VALUES, BLOCK_VALUES = 1 << 20, 1 << 17
#: Points of a leaf, unless more are equal.
LEAF = 64
#: The planes are fitted on so many components of sampled vectors, and cut space into so many cells.
SAMPLE_VALUES, CELLS = 1 << 21, 4096
#: Components of shards' boxes that a pass of the queries is held against.
BOX_VALUES = 1 << 22
#: Queries, and queries with a shard, that one step holds.
AT_ONCE = 1024
#: Sums below this are exact in a double.
EXACT = 1 << 53
_LEAST, _LARGEST = -(1 << 63), (1 << 63) - 1


def points(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``key`` and ``at``, the whole numbers, of every vector that takes part."""
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("v")
    )
    fits: Column = F.forall("v", lambda x: F.coalesce(F.abs(x) < 2.0**63 / scale, F.lit(False)))
    return rows.filter(F.col("key").isNotNull() & F.col("v").isNotNull() & fits).select(
        "key", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("at")
    )


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors of one length together: their rows, and a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    values = column.flatten().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, values[starts[rows][:, None] + np.arange(size)].reshape(len(rows), size)


# -- shards ---------------------------------------------------------------------------


def _median_cut(rows: np.ndarray) -> tuple[int, int]:
    """The axis of widest spread, and a value at the median with rows above it if rows differ."""
    if not rows.size:
        return 0, 0
    axis = int(np.argmax(np.ptp(rows.astype(float), axis=0)))
    values = np.sort(rows[:, axis])
    cut = values[(len(values) - 1) // 2]
    if cut == values[-1] != values[0]:
        cut = values[np.searchsorted(values, cut) - 1]
    return axis, int(cut)


class Planes:
    """Cuts of space at medians of a sample, for vectors of one length."""

    def __init__(self, sample: np.ndarray, cells: int, first_cell: int):
        axis, cut, child = [0], [0], [-1]
        open_, closed = [(0, sample)], 0
        while open_ and len(open_) + closed < cells:
            node, rows = open_.pop(0)
            axis[node], cut[node] = _median_cut(rows)
            low = rows[:, axis[node]] <= cut[node] if rows.size else np.ones(len(rows), bool)
            if low.all():
                closed += 1
                continue
            child[node] = len(child)
            open_ += [(len(child), rows[low]), (len(child) + 1, rows[~low])]
            axis, cut, child = axis + [0, 0], cut + [0, 0], child + [-1, -1]
        self.axis, self.cut, self.child = map(np.array, (axis, cut, child))
        self.cell = np.cumsum(self.child < 0) - 1 + first_cell
        self.next_cell = int(self.cell[-1]) + 1

    def cells(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        while True:
            moving = np.flatnonzero(self.child[node] >= 0)
            if not len(moving):
                return self.cell[node]
            at = node[moving]
            node[moving] = self.child[at] + (rows[moving, self.axis[at]] > self.cut[at])


def _planes(at: DataFrame, shard_rows: int) -> dict[int, Planes]:
    """Planes for each length that the sample holds; other vectors go by their length alone."""
    n, longest = at.agg(F.count(F.lit(1)), F.max(F.size("at"))).first()
    if n <= shard_rows:
        return {}
    most = max(1, SAMPLE_VALUES // max(1, longest))
    rows = at.select("at").sample(min(1.0, most / n), seed=1).limit(most).collect()
    by_length: dict[int, list] = {}
    for (vector,) in rows:
        by_length.setdefault(len(vector), []).append(vector)
    found, first = {}, 0
    for length, vectors in sorted(by_length.items()):
        share = len(vectors) / len(rows)
        cells = max(1, min(int(share * CELLS), round(share * n / shard_rows), len(vectors) // 16))
        found[length] = Planes(np.array(vectors, np.int64).reshape(len(vectors), length), cells, first)
        first = found[length].next_cell
    return found


def _with_cells(at: DataFrame, planes: dict[int, Planes]) -> DataFrame:
    held = at.sparkSession.sparkContext.broadcast(planes)  # at most CELLS cuts in all

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.full(batch.num_rows, -1, np.int64)
            for rows, matrix in _matrices(batch.column("at")):
                if matrix.shape[1] in held.value:
                    cell[rows] = held.value[matrix.shape[1]].cells(matrix)
            yield batch.append_column("cell", pa.array(cell))

    return at.mapInArrow(run, T.StructType([*at.schema, T.StructField("cell", T.LongType())]))


TREE = [
    T.StructField("length", T.IntegerType()),
    T.StructField("low", T.ArrayType(T.LongType())),
    T.StructField("high", T.ArrayType(T.LongType())),
    T.StructField("points", T.BinaryType()),
    T.StructField("boxes", T.BinaryType()),
    T.StructField("child", T.ArrayType(T.IntegerType())),
    T.StructField("start", T.ArrayType(T.IntegerType())),
    T.StructField("stop", T.ArrayType(T.IntegerType())),
    T.StructField("first", T.ArrayType(T.IntegerType())),
]
TREE_COLUMNS = [f.name for f in TREE] + ["keys"]


def _tree(rows: pa.Table) -> pa.Table:
    """The KD-tree of a shard's points as one row; children of a node stand next to each other."""
    rows = rows.take(pc.sort_indices(rows, [("key", "ascending")]))
    matrix = next(_matrices(rows.column("at")))[1]
    order = np.arange(len(matrix))
    child, start, stop, boxes = [-1], [0], [len(order)], []
    node = 0
    while node < len(start):
        a, b = start[node], stop[node]
        own = matrix[order[a:b]]
        low, high = own.min(axis=0), own.max(axis=0)
        boxes.append(np.concatenate([high, low]))
        if b - a <= LEAF or (low == high).all():
            order[a:b].sort()  # by key
        else:
            axis = np.argmax(high.astype(float) - low)
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, axis], middle)]
            child[node] = len(start)
            child += [-1, -1]
            start += [a, a + middle]
            stop += [a + middle, b]
        node += 1
    first = [a + int(np.argmin(order[a:b])) for a, b in zip(start, stop)]  # places of least keys
    keys = rows.column("key").take(pa.array(order)).combine_chunks()
    one = lambda values, kind: pa.array([values], kind)
    return pa.table(
        {
            "length": one(matrix.shape[1], pa.int32()),
            "low": one(matrix.min(axis=0), pa.list_(pa.int64())),
            "high": one(matrix.max(axis=0), pa.list_(pa.int64())),
            "points": one(matrix[order].astype("<i8").tobytes(), pa.binary()),
            "boxes": one(np.array(boxes, "<i8").tobytes(), pa.binary()),
            "child": one(child, pa.list_(pa.int32())),
            "start": one(start, pa.list_(pa.int32())),
            "stop": one(stop, pa.list_(pa.int32())),
            "first": one(first, pa.list_(pa.int32())),
            "keys": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
            "least": keys.take(pa.array([first[0]])),
        }
    )


def build(at: DataFrame) -> DataFrame:
    """One row for each shard: its number, box, least key and tree. ``at`` is read several times."""
    longest = at.agg(F.max(F.size("at"))).first()[0] or 1
    shard_rows = max(LEAF, SHARD_VALUES // max(1, longest))
    placed = _with_cells(at, _planes(at, shard_rows))
    # the number stays, as the frame is written once: a task that runs again deals alike
    placed = kept(placed.withColumn("number", F.monotonically_increasing_id()), "vector-cells")
    place = ["cell", F.size("at").alias("length")]
    counts = placed.groupBy(*place).count()
    pieces = counts.withColumn("pieces", F.ceil(F.col("count") / shard_rows)).drop("count")
    dealt = placed.select("key", "at", "number", *place)
    dealt = dealt.join(kept(pieces, "vector-pieces"), ["cell", "length"])
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("number"), "pieces"))
    key = at.schema["key"].dataType
    schema = T.StructType(
        [*TREE, T.StructField("keys", T.ArrayType(key)), T.StructField("least", key)]
    )
    trees = dealt.groupBy("cell", "length", "piece").applyInArrow(
        lambda rows: _tree(rows.select(["key", "at"])), schema
    )
    return kept(trees.withColumn("shard", F.monotonically_increasing_id()), "vector-shards")


# -- search ---------------------------------------------------------------------------


def _exactly(*matrices: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as doubles if all their inner products are exact in doubles, else as integers
    of any size."""
    most = [float(np.abs(m.astype(float)).max(initial=0)) + 1 for m in matrices]
    exact = matrices[0].shape[1] * np.prod(most) < EXACT
    return [m.astype(float if exact else object) for m in matrices]


def _held(scores: np.ndarray) -> np.ndarray:
    """Scores as 64 bits hold them; doubles are far below that."""
    if scores.dtype == object:
        scores = np.minimum(np.maximum(scores, _LEAST), _LARGEST)
    return scores


def _bounds(queries: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """The largest inner product of each query within each box, given by its high and low ends."""
    if not queries.shape[1]:
        return np.zeros((len(queries), len(boxes)))
    signed = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1)
    signed, boxes = _exactly(signed, boxes)
    return _held(signed @ boxes.T)


class Nearest:
    """The best points so far, as negative score and key."""

    def __init__(self, k: int, floor: tuple | None = None):
        self.k = k
        self.found: list[tuple] = []
        self.last = floor  # what a point must come before

    def admits(self, score, key) -> bool:
        return self.last is None or (-score, key) < self.last

    def add(self, pairs: list[tuple]) -> None:
        self.found = sorted(self.found + pairs)[: self.k]
        if len(self.found) == self.k and (self.last is None or self.found[-1] < self.last):
            self.last = self.found[-1]


class Tree:
    """A shard's tree, as :func:`_tree` wrote it."""

    def __init__(self, row: pa.Table):
        value = lambda name: row.column(name)[0].as_py()
        self.child, self.start, self.stop, self.first, self.keys = (
            value(n) for n in ("child", "start", "stop", "first", "keys")
        )
        length = value("length")
        self.points = np.frombuffer(value("points"), "<i8").reshape(len(self.keys), length)
        self.boxes = np.frombuffer(value("boxes"), "<i8").reshape(len(self.child), 2 * length)

    def search(self, query: np.ndarray, points: np.ndarray, bounds: list, own, best: Nearest) -> int:
        """Best-first through the nodes, whose bounds are given; gives how many leaves were read."""
        heap, leaves = [(-bounds[0], 0)], 0
        while heap:
            bound, node = heappop(heap)
            if best.last is not None and bound > best.last[0]:
                break
            if not best.admits(-bound, self.keys[self.first[node]]):
                continue
            below = self.child[node]
            if below >= 0:
                for side in (below, below + 1):
                    if best.admits(bounds[side], self.keys[self.first[side]]):
                        heappush(heap, (-bounds[side], side))
                continue
            leaves += 1
            a, b = self.start[node], self.stop[node]
            scores = _held(points[a:b] @ query) if len(query) else np.zeros(b - a)
            good = range(b - a) if best.last is None else np.flatnonzero(scores >= -best.last[0]).tolist()
            pairs = [(-int(scores[i]), self.keys[a + i]) for i in good]
            best.add([p for p in pairs if p[1] != own and best.admits(-p[0], p[1])])
        return leaves


def _near(bounds: np.ndarray, shards: list, home: int, floor: int | None, key) -> list[int]:
    """The shards, but for the one searched first, that may hold points before the k-th."""
    best = Nearest(1, None if floor is None else (-floor, key))
    reached = range(len(shards)) if floor is None else np.flatnonzero(bounds >= floor).tolist()
    return [
        s for s in reached
        if shards[s]["shard"] != home and best.admits(bounds[s], shards[s]["least"])
    ]


def _reached(asked: DataFrame, boxes: list, home: bool) -> DataFrame:
    """Queries with each shard (of one part of the boxes) whose box reaches their k-th score.

    With ``home`` only the shard of the greatest bound is given, with that bound.
    """
    held = asked.sparkSession.sparkContext.broadcast(boxes)  # BOX_VALUES components at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, list] = {}
        for row in held.value:
            by_length.setdefault(row["length"], []).append(row)
        ends = {
            length: np.array([r["high"] + r["low"] for r in rows], np.int64).reshape(len(rows), -1)
            for length, rows in by_length.items()
        }
        for batch in batches:
            floors = [None] * batch.num_rows
            if not home:
                columns = (batch.column(c).to_pylist() for c in ("home", "floor", "floor_key"))
                floors = list(zip(*columns))
            who, where, bound = [], [], []
            for rows, matrix in _matrices(batch.column("at")):
                shards = by_length.get(matrix.shape[1], [])
                for a in range(0, len(rows) if shards else 0, AT_ONCE):
                    found = _bounds(matrix[a : a + AT_ONCE], ends[matrix.shape[1]])
                    for i, bounds in zip(rows[a : a + AT_ONCE].tolist(), found):
                        near = [int(np.argmax(bounds))] if home else _near(bounds, shards, *floors[i])
                        who += [i] * len(near)
                        where += [shards[s]["shard"] for s in near]
                        bound += [float(bounds[s]) for s in near]
                        if len(who) >= AT_ONCE:
                            yield pairs(batch, who, where, bound)
                            who, where, bound = [], [], []
            yield pairs(batch, who, where, bound)

    def pairs(batch: pa.RecordBatch, who: list, where: list, bound: list) -> pa.RecordBatch:
        out = batch.take(pa.array(who, pa.int64()))
        out = out.append_column("shard", pa.array(where, pa.int64()))
        return out.append_column("bound", pa.array(bound, pa.float64())) if home else out

    extra = [T.StructField("shard", T.LongType())]
    extra += [T.StructField("bound", T.DoubleType())] if home else []
    return asked.mapInArrow(run, T.StructType([*asked.schema, *extra]))


def _box_parts(shards: DataFrame) -> Iterator[list]:
    """The shards' boxes, as many at a time as a pass may hold."""
    boxes = shards.select("shard", "length", "low", "high", "least")
    size = boxes.agg(F.coalesce(F.sum(2 * F.col("length") + 4), F.lit(0))).first()[0]
    parts = 1 if size <= BOX_VALUES else -(-3 * int(size) // (2 * BOX_VALUES))
    for part in range(parts):
        yield boxes.filter(F.pmod(F.xxhash64("shard"), F.lit(parts)) == part).collect()


def _united(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _visit(pairs: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """Each query's best points in each shard it goes to, those that its k-th score so far admits."""
    pairs = kept(pairs, "vector-pairs")
    key = pairs.schema["key"].dataType
    rows = F.ceil(F.sum(F.size("at") + 1) / BLOCK_VALUES).cast("int")
    blocks = kept(pairs.groupBy("shard").agg(rows.alias("blocks")), "vector-blocks")
    asked = pairs.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("query"), "blocks"))
    every = blocks.select("shard", F.explode(F.sequence(F.lit(1), "blocks")).alias("copy"))
    trees = shards.join(every, "shard").select(
        F.col("shard").alias("tree"), (F.col("copy") - 1).cast("long").alias("copy"), *TREE_COLUMNS
    )

    def run(asked: pa.Table, tree: pa.Table) -> pa.Table:
        found = _answers(asked, Tree(tree), k) if asked.num_rows and tree.num_rows else []
        query, own, keys, scores = zip(*found) if found else ((), (), (), ())
        kind = asked.schema.field("key").type
        return pa.table(
            {
                "query": pa.array(query, pa.int64()), "own": pa.array(own, kind),
                "keys": pa.array(keys, pa.list_(kind)), "scores": pa.array(scores, pa.list_(pa.int64())),
            }
        )

    schema = T.StructType(
        [T.StructField("query", T.LongType()), T.StructField("own", key),
         T.StructField("keys", T.ArrayType(key)), T.StructField("scores", T.ArrayType(T.LongType()))]
    )
    found = asked.groupBy("shard", "block").cogroup(trees.groupBy("tree", "copy"))
    return kept(found.applyInArrow(run, schema), "vector-found")


def _answers(asked: pa.Table, tree: Tree, k: int) -> list[tuple]:
    """A block of queries on one tree: query, its key, and the keys and scores found."""
    matrix = next(_matrices(asked.column("at")))[1]
    bounds = _bounds(matrix, tree.boxes)
    matrix, points = _exactly(matrix, tree.points)
    floors = [None] * len(matrix)
    if "floor" in asked.column_names:
        columns = zip(asked.column("floor").to_pylist(), asked.column("floor_key").to_pylist())
        floors = [None if s is None else (-s, key) for s, key in columns]
    out = []
    numbers, own = asked.column("query").to_pylist(), asked.column("key").to_pylist()
    for i, row in enumerate(matrix):
        best = Nearest(k, floors[i])
        tree.search(row, points, bounds[i].tolist(), own[i], best)
        keys = [key for _, key in best.found]
        scores = [-s for s, _ in best.found]
        out.append((numbers[i], own[i], keys, scores))
    give_back()
    return out


def search(queries: DataFrame, shards: DataFrame, k: int = 10) -> DataFrame:
    """``query`` (its key), ``rank``, ``key`` and ``score`` of the k best points for every query.

    ``queries`` has the columns of :func:`points`, ``shards`` is what :func:`build` gives.
    """
    numbered = F.monotonically_increasing_id().alias("query")
    asked = kept(queries.select(numbered, "key", "at"), "vector-queries")
    home = _united([_reached(asked, boxes, True) for boxes in _box_parts(shards)])
    best_home = Window.partitionBy("query").orderBy(F.col("bound").desc(), "shard")
    home = home.withColumn("place", F.row_number().over(best_home)).filter("place = 1")
    home = kept(home.drop("place", "bound"), "vector-home")
    near = _visit(home, shards, k)
    full = F.size("scores") == k
    floors = near.select(
        "query",
        F.when(full, F.get("scores", F.lit(k - 1))).alias("floor"),
        F.when(full, F.get("keys", F.lit(k - 1))).alias("floor_key"),
    )
    again = home.withColumnRenamed("shard", "home").join(floors, "query")
    again = kept(again, "vector-floors")
    far = _visit(_united([_reached(again, boxes, False) for boxes in _box_parts(shards)]), shards, k)
    each = near.unionByName(far).select(
        "query", "own", F.explode(F.arrays_zip("keys", "scores")).alias("p")
    )
    each = each.select("query", "own", F.col("p.keys").alias("key"), F.col("p.scores").alias("score"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("key"))
    ranked = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("own").alias("query"), "rank", "key", "score")
