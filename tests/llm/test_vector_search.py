import math
import random

import numpy as np
import pyarrow as pa
import pytest

from zilverspoor.llm import vector_search as v
from zilverspoor.llm.queries import queries

SCHEMA = "vec_id long, embedding array<float>, at string, shard int, query double, key int"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "a", 1, 0.5, 2) for i, x in rows], SCHEMA)


def whole(x):
    fits = x is not None and all(c is not None and math.isfinite(c) and abs(c) < 2**53 for c in x)
    return tuple(math.floor(1024 * float(np.float32(c))) for c in x) if fits else None


def brute(rows, asked, k):
    """Query, rank, key and score by scoring everything."""
    points = [(i, p) for i, x in rows if i is not None and (p := whole(x)) is not None]
    out = []
    for q, at in points:
        if asked(q):
            found = sorted(
                (-min(max(sum(a * b for a, b in zip(at, p)), -(2**63)), 2**63 - 1), i)
                for i, p in points if i != q and len(p) == len(at)
            )
            out += [(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def searched(df, asked, k):
    at = v.points(df, "vec_id", "embedding")
    rows = v.search(at.filter(asked), v.build(at), k).collect()
    return sorted((r["query"], r["rank"], r["key"], r["score"]) for r in rows)


def clustered(n, length=6, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(length)] for _ in range(5)]
    rows = [[c + rng.gauss(0, 0.1) for c in rng.choice(centres)] for _ in range(n)]
    rows[n // 2 :: 3] = [rows[1]] * len(rows[n // 2 :: 3])  # one vector that many rows have
    return list(enumerate(rows))


@pytest.fixture
def small(monkeypatch):
    """Many shards, blocks and parts of boxes, and planes from a small sample."""
    monkeypatch.setattr(v, "SHARD_VALUES", 6 * 80)
    monkeypatch.setattr(v, "BLOCK_VALUES", 20)
    monkeypatch.setattr(v, "SAMPLE_VALUES", 6 * 200)
    monkeypatch.setattr(v, "BOX_VALUES", 100)
    monkeypatch.setattr(v, "AT_ONCE", 7)
    monkeypatch.setattr(v, "LEAF", 4)


def test_against_brute_force_in_many_shards(spark, small):
    rows = clustered(900)
    df = frame(spark, rows).repartition(3)
    shards = v.build(v.points(df, "vec_id", "embedding"))
    counted = shards.selectExpr("count(*)", "sum(size(keys))", "max(size(keys))").first()
    assert counted[0] > 9 and counted[1] == 900 and counted[2] < 250
    assert searched(df, "key % 30 = 0", 7) == brute(rows, lambda i: i % 30 == 0, 7)


def test_against_brute_force_in_one_shard(spark):
    rows = clustered(500, 12, 3)
    assert searched(frame(spark, rows), "key % 20 = 0", 10) == brute(rows, lambda i: i % 20 == 0, 10)


AWKWARD = [
    (0, None), (100, [0.5, None]), (200, [float("nan"), 1.0]), (300, [float("inf"), 0.0]), (None, [1.0, 1.0]),
    (1, [1.0, -1.0]), (2, [0.25, 0.125]), (3, [-0.0004, 0.0004]), (400, [0.25, 0.125]), (400, [0.25, 0.125]),
    (2, [0.25, 0.125]), (4, [0.0, 0.0]), (5, [1.0]), (500, [2.0]), (6, []), (600, []), (7, [1.0, 2.0, 3.0]),
    (700, [3.0e9, -3.0e9]), (8, [3.0e9, -3.0e9]), (9, [5.0e15, 5.0e15]), (800, [5.0e15, 5.0e15]), (10, [1e16, 0.0]),
]


def test_defined_cases(spark, small):
    asked = lambda i: i % 100 == 0
    got = searched(frame(spark, AWKWARD), "key % 100 = 0", 3)
    assert got == brute(AWKWARD, asked, 3)
    assert {q for q, *_ in got} == {400, 500, 600, 700, 800}
    assert (600, 1, 6, 0) in got and (800, 3, 9, 2**63 - 1) in got


def test_text_keys_and_empty_tables(spark):
    rows = [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("é", [2.0, 0.0]), ("z", [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    assert [r[2] for r in searched(df, "key = 'z'", 3)] == ["é", "a", "b"]
    assert searched(frame(spark, []), "true", 3) == []
    assert searched(frame(spark, [(0, None)]), "true", 3) == []
    assert searched(frame(spark, clustered(9)), "false", 3) == []


def test_boxes_out_of_reach_are_not_read():
    rng = np.random.default_rng(5)
    matrix = np.concatenate([rng.integers(-50, 50, (3000, 4)), rng.integers(900, 1000, (200, 4))])
    rows = pa.table({"key": np.arange(3200), "at": pa.array(matrix.tolist())})
    tree = v.Tree(v._tree(rows))
    query = np.array([3, 1, 2, 1])
    best = v.Nearest(10)
    bounds = v._bounds(query[None, :], tree.boxes)[0].tolist()
    leaves = tree.search(query, tree.points, bounds, -1, best)
    scores = matrix @ query
    want = sorted(zip((-scores).tolist(), range(3200)))[:10]
    assert best.found == want
    assert leaves < 12 < tree.child.count(-1)
    # with a k-th score from elsewhere, fewer still
    floor = v.Nearest(10, (want[0][0], want[0][1]))
    assert tree.search(query, tree.points, bounds, -1, floor) <= 3 and floor.found == []


def test_boxes_are_tight_and_halves_even():
    rows = pa.table({"key": np.arange(1000), "at": pa.array(np.random.default_rng(1).integers(0, 99, (1000, 3)).tolist())})
    tree = v.Tree(v._tree(rows))
    for node, below in enumerate(tree.child):
        own = tree.points[tree.start[node] : tree.stop[node]]
        assert tree.boxes[node].tolist() == [*own.max(axis=0), *own.min(axis=0)]
        assert tree.keys[tree.first[node]] == min(tree.keys[tree.start[node] : tree.stop[node]])
        if below >= 0:
            sizes = [tree.stop[n] - tree.start[n] for n in (below, below + 1)]
            assert abs(sizes[0] - sizes[1]) <= 1


def test_registered_query_has_full_recall(spark, folder):
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = queries()["op13_vector_search"](spark, folder).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)
    assert got == brute(rows, lambda i: i % 100 == 0, 10)
