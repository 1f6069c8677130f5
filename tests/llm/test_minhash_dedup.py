import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from zilverspoor.llm import minhash_dedup as m

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bag(text):
    words = WORD.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(texts):
    bags, parent = [bag(t) for t in texts], list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= m.SIMILARITY:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def cloud(seed, n, size=150):
    """Copies of a text with more and more words changed."""
    rng = random.Random(seed)
    words = [f"c{seed}x{i}" for i in range(size)]
    out = []
    for k in range(n):
        own = list(words)
        for _ in range(k % 9):
            own[rng.randrange(size)] = f"n{seed}x{k}x{rng.random()}"
        out.append(" ".join(own))
    return out


def test_classes_against_brute_force(docs, awkward):
    texts = awkward + cloud(1, 40) + cloud(2, 25) + ["a! B", "A b", "five of the words x"] * 2
    texts += [" ".join(["again and again"] * k) for k in (40, 41, 45, 80)]
    random.Random(4).shuffle(texts)
    rows = m.classes(docs(texts)).collect()
    assert len(rows) == len(texts)
    found = {r["key"]: r["class"] for r in rows}
    assert [found[i] for i in range(len(texts))] == brute(texts)


def test_one_row_of_each_class_stays(spark, docs, awkward):
    texts = awkward + cloud(3, 12)
    frame = docs(texts).withColumnRenamed("key", "node_")
    kept = m.drop_duplicates(frame)
    assert kept.columns == frame.columns
    want = sorted(set(brute(texts)))
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert m.drop_duplicates(docs([])).count() == 0
    # equal and NULL keys, whole rows repeated
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text), (5, text), (None, text), (None, "other words"), (None, "other words"), (7, None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in m.drop_duplicates(odd).collect())
    assert got == sorted([("5", text), ("None", "other words"), ("7", "None")])


def test_signatures_estimate_the_weighted_similarity():
    rng = random.Random(9)
    for share in (0.2, 0.5, 0.8):
        left, right, text = [], [], []
        sizes = []
        for side in range(2):
            h, c = [], []
            for i in range(200):
                common = i < 200 * share
                h.append((i if common else i + 1000 * (side + 1)) * 2654435761 + 12345)
                c.append(1 + (i % 7) + (side if i % 11 == 0 else 0))
            sizes.append(dict(zip(h, c)))
        both = set(sizes[0]) | set(sizes[1])
        want = sum(min(sizes[0].get(k, 0), sizes[1].get(k, 0)) for k in both) / sum(
            max(sizes[0].get(k, 0), sizes[1].get(k, 0)) for k in both
        )
        hashes = m.mix(np.array([*sizes[0], *sizes[1]], np.uint64))
        text = np.repeat([0, 1], [len(sizes[0]), len(sizes[1])])
        counts = np.array([*sizes[0].values(), *sizes[1].values()])
        points = m.signatures(hashes, text, counts, 2, m=4000)
        assert (points[0] == points[1]).mean() == pytest.approx(want, abs=0.04)
    assert rng and not left and not right


def test_similarities_of_pairs():
    texts = cloud(5, 9)
    pairs = list(combinations(texts, 2))
    got = m.similarities(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]))
    assert got == pytest.approx([similarity(bag(a), bag(b)) for a, b in pairs])


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 101 + i) for i in range(30)]
    edges += [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(30)]
    raw = [(a.to_bytes(2, "big"), b.to_bytes(2, "big")) for a, b in edges]
    rng.shuffle(raw)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in raw:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    found = m.components(spark.createDataFrame(raw, "a binary, b binary")).collect()
    got = {bytes(r["node"]): bytes(r["root"]) for r in found}
    assert {k: got.get(k, k) for k in parent} == {k: find(k) for k in parent}


def linked(texts, similarity):
    """The least member of each text's class, by comparing all pairs."""
    bags, least = [bag(t) for t in texts], list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        both = sum(min(c, bags[j].get(k, 0)) for k, c in bags[i].items())
        all_ = sum(bags[i].values()) + sum(bags[j].values()) - both
        if both >= similarity * all_ and least[i] != least[j]:
            a, b = sorted((least[i], least[j]))
            least = [a if x == b else x for x in least]
    return least


def test_pairs_across_components_at_a_lower_similarity(docs):
    rng, texts = random.Random(8), []
    for g in range(8):
        # members share some of a group's blocks: similarities on both sides of one half
        blocks = [" ".join(f"g{g}b{b}w{i}" for i in range(14)) for b in range(12)]
        for _ in range(12):
            texts.append(" ".join(blocks[b] for b in sorted(rng.sample(range(12), 8))))
    found = {r["key"]: r["class"] for r in m.classes(docs(texts), similarity=0.5).collect()}
    assert [found[i] for i in range(len(texts))] == linked(texts, 0.5)


def test_bands_follow_the_similarity():
    assert m.band_rows(m.SIMILARITY) == 4
    for similarity in (0.3, 0.5, 0.7, 0.9):
        rows = m.band_rows(similarity)
        assert (1 - similarity**rows) ** (m.COMPONENTS // rows) <= m.MISSED
