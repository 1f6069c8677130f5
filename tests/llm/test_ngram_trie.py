import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from zilverspoor.llm import ngram_trie as n
from zilverspoor.llm.elias_fano import EliasFano, pack, unpack

D = n.DISCOUNT


@pytest.mark.parametrize("size, universe", [(0, 5), (1, 1), (50, 1000), (300, 20), (500, 1 << 64)])
def test_elias_fano(size, universe):
    rng = np.random.default_rng(size)
    values = np.sort(rng.integers(0, universe, size, dtype=np.uint64))
    built = EliasFano.build(values, universe)
    read = EliasFano.of(unpack(np.frombuffer(pack(built.arrays("x")), np.uint8)), "x")
    asked = np.concatenate([values, rng.integers(0, universe, 200, dtype=np.uint64)])
    assert (read.get(np.arange(size)) == values).all()
    assert (read.successor(asked) == np.searchsorted(values, asked)).all()
    found = read.find(asked)
    assert ((found >= 0) == np.isin(asked, values)).all()
    assert (values[found[found >= 0]] == asked[found >= 0]).all()


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def brute(train, texts):
    """The model without shards, tries or quantising."""
    grams = [Counter() for _ in range(3)]
    for text in train:
        words = tokens(text)
        for k in range(3):
            for i in range(len(words) - k):
                grams[k][tuple(words[i : i + k + 1])] += 1
    one = grams[0]
    total, kinds = sum(one.values()), len(one)
    kept = [dict(one)]
    for k in (1, 2):
        good = lambda g: kept[-1].get(g, 0) >= n.LEAST
        kept.append({
            g: c for g, c in grams[k].items() if c >= n.LEAST and good(g[1:]) and good(g[:-1])
        })
    used = [defaultdict(float) for _ in range(3)]
    for k in (1, 2):
        for g, c in kept[k].items():
            used[k][g[:-1]] += (c - D) / kept[k - 1][g[:-1]]
    out = []
    for text in texts:
        words, base, score, known = tokens(text), 0.0, 0.0, 0
        for i, w in enumerate(words):
            c = one.get((w,), 0)
            known += c > 0
            p = (c + 1) / (total + kinds + 1)
            base += math.log10(p)
            for k in (1, 2):
                if i >= k:
                    h = tuple(words[i - k : i])
                    if h in kept[k - 1]:
                        got = kept[k].get((*h, w))
                        p = (got - D if got else 0) / kept[k - 1][h] + (1 - used[k][h]) * p
            score += math.log10(p)
        out.append((len(words), known, total, base, score))
    return out


def check(spark_rows, expected):
    step = -n.LOWEST / (n.STEPS - 1)
    for row, (size, known, total, base, score) in zip(spark_rows, expected):
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (size, known, total)
        assert row["base_score"] == pytest.approx(base, abs=1e-6)
        # rounding down loses at most two steps a token and level
        assert score - 4 * step * size <= row["score"] <= score + 1e-9


@pytest.mark.parametrize("shards", [1, 5, 60])
def test_against_brute_force(spark, docs, awkward, shards):
    rng = random.Random(3)
    common = ["the", "of", "a", "b", "c"]
    more = [" ".join(rng.choice(common) for _ in range(80)) for _ in range(100)]
    train, texts = awkward + more, awkward + more[:5] + ["never seen words", "The of zzz a b"]
    levels = n.train(docs(train), shards=shards)
    assert len(levels[0].files) == shards
    if shards == 60:
        assert levels[0].hot and levels[1].hot_sums
    rows = n.score(docs(texts), levels).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    check(rows, brute(train, texts))


def test_model_beats_the_base_and_needs_no_texts(spark, docs):
    texts = ["one two three four five"] * 3
    row = n.score(docs(texts), n.train(docs(texts))).first()
    assert row["score"] > row["base_score"]
    levels = n.train(docs([]))
    assert n.score(docs(["x y"]), levels).first()["base_score"] == 0.0
    assert n.score(docs([]), levels).count() == 0


def test_sequences_that_occur_once_count(spark, docs):
    text = "one two three four"
    row = n.score(docs([text]), n.train(docs([text]), shards=3)).first()
    one = (1 + 1) / (5 + 5 + 1)
    two = (1 - D) + D * one
    three = (1 - D) + D * two
    check([row], [(5, 5, 5, 5 * math.log10(one), math.log10(one * two * three**3))])
    assert row["score"] > row["base_score"] + 1
