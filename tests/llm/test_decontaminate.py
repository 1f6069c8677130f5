import re

import pytest

from zilverspoor.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, body in items:
        ws = words(body)
        for i in range(max(1, len(ws) - 12) if ws else 0):
            window = ws[i : i + 13]
            for p in range(len(own) - len(window) + 1):
                if own[p : p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    found.add(item)
    return len(own), len(hit), sorted(found)


LINE = " ".join(f"q{i}" for i in range(20))
ITEMS = [
    (1, LINE), (2, "The Short one"), (3, None), (4, ""), (5, "a"), (6, "...!"), (7, LINE + " more"),
    (8, "été à Noël 日本"), (9, "x" * 40 + " " + "y" * 30), (10, LINE),
]
TEXTS = [
    LINE, "begin " + LINE.upper() + " end", " ".join(LINE.split()[:12]), " ".join(LINE.split()[3:16]),
    "the,short--ONE. the short one", "shorts one the short", "a", "b a b", "aa ba", "Été à noël 日本!",
    "été à noël 日本", "x" * 40 + "\n" + "y" * 30, "x" * 41 + " " + "y" * 30, "q1 " * 50,
    "w " * 400 + LINE,
]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("part_bytes", [d.PART_BYTES, 40])
def test_against_brute_force(docs, awkward, benchmark, part_bytes):
    texts = TEXTS + awkward
    frame = d.hits(docs(texts), benchmark, part_bytes=part_bytes)
    rows = frame.withColumn("n_hit", d.hit_words()).orderBy("row.doc_id").collect()
    got = [(r["n_words"], r["n_hit"], r["items"]) for r in rows]
    assert got == [brute(t, ITEMS) for t in texts]


def test_drop_keeps_clean_rows_and_columns(docs, benchmark, awkward):
    frame = docs(TEXTS).withColumnRenamed("key", "spans")
    kept = d.drop_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    gone = {0, 1, 3, 4, 6, 7, 10, 11}
    brute_gone = {
        i for i, t in enumerate(TEXTS) if (r := brute(t, ITEMS))[1] and 20 * r[1] >= r[0]
    }
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(TEXTS))) - brute_gone
    assert gone <= brute_gone
    assert d.drop_contaminated(docs([]), benchmark).count() == 0
    assert d.drop_contaminated(docs(awkward), benchmark.limit(0)).count() == len(awkward)


def test_shifts_never_jump_over_a_window():
    import random

    import numpy as np

    rng = random.Random(5)
    for _ in range(20):
        text = bytes(rng.choice(b"ab ") for _ in range(5000))
        patterns = sorted({text[i : i + rng.randint(20, 30)] for i in range(0, 4900, 300)})
        at, window = d.Search(patterns).find(np.frombuffer(text, np.uint8))
        want = {
            (i, k) for k, p in enumerate(patterns) for i in range(len(text)) if text.startswith(p, i)
        }
        assert set(zip(at.tolist(), window.tolist())) == want
