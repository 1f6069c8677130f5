import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from zilverspoor.llm import lexical_search as s
from zilverspoor.llm.queries import queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    """Item, rank, key and score; every document is scored for every item."""
    held = [(i, Counter(ws), len(ws)) for i, t in docs if (ws := terms(t))]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    holders = Counter(t for _, tf, _ in held for t in tf)
    out = []
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for i, tf, n in held:
            m = 100 - 25 + 25 * n * n_docs // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1)))
                * (1000000000 * tf[t] // (1000 * tf[t] + 12 * m))
                for t, times in asked.items() if t in tf
            )
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: (x[:2], () if x[1] else (x[2],)))
        out += [(item, r, i, -score) for r, (score, _, i) in enumerate(found[:k], 1)]
    return out


def same(frame, want):
    got = [tuple(r) for r in frame.select("item", "rank", "key", "score").collect()]
    order = lambda r: [(v is not None, v if v is not None else 0) for v in r]
    assert sorted(got, key=order) == sorted(want, key=order)


def corpus(awkward, n=400):
    rng = random.Random(4)
    words = [f"t{int(rng.expovariate(0.02))}" for _ in range(3000)] + ["The", "of", "ÉTÉ", "日本"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(n)]
    texts += awkward + [texts[3]] * 60 + [texts[3] + " " + texts[3]] * 3
    items = [texts[5], texts[3], "the OF the t1 t1 t2", "unknown words only", "", None, " !! ", "été", "日本 t5"]
    items += [" ".join(rng.choices(words, k=40)) for _ in range(10)] + [awkward[-8]]
    return texts, list(enumerate(items))


@pytest.fixture
def asked(spark):
    def make(items):
        rows = [(i, t, "x", 1) for i, t in items]
        return spark.createDataFrame(rows, "item_id long, text string, query string, rank int")

    return make


@pytest.mark.parametrize("part_bytes,docs_a_shard", [(s.PART_BYTES, 4096), (s.PART_BYTES, 7), (300, 50)])
def test_against_brute_force(docs, awkward, asked, monkeypatch, part_bytes, docs_a_shard):
    monkeypatch.setattr(s, "SHARD_DOCS", docs_a_shard)
    monkeypatch.setattr(s, "STEP", 64)
    texts, items = corpus(awkward)
    want = brute(list(enumerate(texts)), items)
    assert len(want) > 200
    same(s.search(docs(texts).repartition(3), asked(items), part_bytes=part_bytes), want)


def test_null_and_repeated_keys_and_items(spark, asked):
    texts = ["a b", "a b", "a", None, "", "b b", "a b"]
    ids = [5, None, 5, 1, 2, 3, 5]
    rows = [(i, t, 9) for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    items = [(1, "a B"), (None, "b"), (1, "a B")]
    want = brute(list(zip(ids, texts)), items, k=3)
    same(s.search(docs, asked(items), k=3), want)


def test_text_keys_and_empty_tables(spark, docs, asked):
    frame = spark.createDataFrame([("z", "a"), ("é", "a"), ("b", "a")], "name string, body string")
    found = s.search(frame, asked([(1, "a b")]), k=2, key="name", text="body").orderBy("rank").collect()
    assert [(r["rank"], r["key"]) for r in found] == [(1, "b"), (2, "z")]
    assert s.search(docs([]), asked([(1, "a")])).count() == 0
    assert s.search(docs(["a"]), asked([])).count() == 0
    assert s.search(docs([None, ""]), asked([(1, "a")])).count() == 0


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(s, "span_hashes", lambda sums, b, e: np.zeros(len(b), np.uint64))
    known = s.Vocabulary([b"aa", b"b", b"cc"])
    low = np.frombuffer(b"b cc aa dd c", np.uint8)
    begins, ends = np.array([0, 2, 5, 8, 11]), np.array([1, 4, 7, 10, 12])
    words, found = known.find(low, begins, ends)
    assert sorted(zip(words.tolist(), found.tolist())) == [(0, 1), (1, 2), (2, 0)]


def test_intervals_out_of_reach_are_not_looked_at():
    """A rare term's few documents decide; of a thousand others only some are scored."""
    import pyarrow as pa

    n = 1000
    table = pa.table({
        "key": list(range(n)), "n": [50] * n,
        "terms": pa.array([[0, 1] if i % 200 == 7 else [0] for i in range(n)], pa.list_(pa.int32())),
        "tfs": pa.array([[1, 3] if i % 200 == 7 else [1 + i % 2] for i in range(n)], pa.list_(pa.int32())),
    })
    ranking = s.Ranking(n, 50 * n, np.array([10, 5000]), [], 3)
    best = s.Best(3)
    scored = s.Shard(table, ranking).search(np.array([0, 1]), np.array([1, 1]), best)
    assert [k for _, _, k in best.found] == [7, 207, 407]
    assert scored < 100


def test_long_lengths_do_not_overflow():
    ranking = s.Ranking(10**12, 10**15, np.zeros(1, np.int64), [], 1)
    n = np.array([10**7], np.int64)
    tf = np.array([3], np.int64)
    assert ranking.impacts(tf, n).tolist() == [3 * 10**9 // (3000 + 12 * (75 + 25 * 10**7 * 10**12 // 10**15))]


def test_registered_query_against_brute_force(spark, folder):
    read = lambda t: [tuple(r)[:2] for r in spark.read.parquet(f"{folder}/{t}.parquet").collect()]
    frame = queries()["op12_lexical_search"](spark, folder)
    frame = frame.withColumnRenamed("item_id", "item").withColumnRenamed("doc_id", "key")
    same(frame, brute(read("documents"), read("benchmark")))
