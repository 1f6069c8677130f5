import random
from collections import Counter

import numpy as np
import pytest

from zilverspoor.llm import suffix_dedup as s


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        spans = [tuple(x) for x in edges.reshape(-1, 2).tolist()]
        out.append((len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def passages():
    rng = random.Random(6)
    chars = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared, short = chars(700), chars(330)
    texts = [chars(50) + shared[a : a + 450] + chars(80) for a in (0, 30, 100, 250, 249)]
    texts += [chars(rng.randint(0, 200)) + short + chars(rng.randint(0, 200)) for _ in range(30)]
    texts += [shared, shared[:400], shared[:399], "ab" * 700, "x" * 401, chars(300) * 3]
    return texts


def check(frame, texts, length):
    rows = frame.orderBy("doc_id").collect()
    got = [
        (r["n_bytes"], r["n_removed"], [tuple(x) for x in r["spans"]], bytes(r["kept"])) for r in rows
    ]
    assert got == brute(texts, length)


@pytest.mark.parametrize("shards", [1, 7])
def test_against_brute_force(docs, awkward, shards):
    texts = awkward + passages()
    check(s.remove_repeats(docs(texts), shards=shards), texts, s.LENGTH)


def test_windows_of_a_crowd(docs, monkeypatch):
    """A core with more stretches than a transform takes; workers read the limit from the module."""
    rng = random.Random(8)
    chars = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    core = chars(395)
    texts = [chars(30) + core + chars(30) for _ in range(s.CROWD + 60)]
    texts += [texts[0][:440], texts[1][3:], chars(5) + texts[2][20:440]]
    check(s.remove_repeats(docs(texts)), texts, s.LENGTH)


def test_common_prefixes_of_suffixes():
    rng = random.Random(2)
    for length in (1, 5, 9, 20, 60):
        text = bytes(rng.choice(b"ab") for _ in range(300))
        text += text[50:150] + b"c" + text[:90] + b"\xff"
        data = np.frombuffer(text, np.uint8)
        want = Counter(text[i : i + length] for i in range(len(text) - length + 1))
        got = s.alike(data, length)
        for i in range(len(text) - length):
            assert got[i] == (want[text[i : i + length]] > 1)


def test_nulls_equal_keys_and_empty_tables(spark, docs):
    text = "".join(random.Random(1).choice("abcdef ") for _ in range(900))
    rows = [(1, text), (1, text), (None, text[:500]), (1, "z" * 10), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in s.remove_repeats(frame).collect())
    assert got == sorted([("1", 900, 900), ("1", 900, 900), ("None", 500, 500), ("1", 10, 0), ("None", 0, 0)])
    assert s.remove_repeats(docs([])).count() == 0


def test_registered_query(spark, folder):
    import hashlib

    from zilverspoor.llm.queries import queries

    rows = queries()["op6_suffix_dedup"](spark, folder).orderBy("doc_id").collect()
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()]
    for row, (size, gone, spans, kept) in zip(rows, brute(texts, 400), strict=True):
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (size, gone, len(spans))
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
