import itertools
import random
import re

import pytest

from zilverspoor.llm import filter_audit as a
from zilverspoor.llm.queries import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FLAGS = {"good": "quality = 1", "toxic": "toxic = 1"}


def fails(text, repeats):
    text = text or ""
    words = WORD.findall(text)
    out = "A" * (len(words) < 100)
    out += "B" * (100 * len(set(words)) < 80 * len(words))
    out += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
    out += "D" * bool(re.search(r"[#$%&*|]", text))
    return out + "E" * repeats


def brute(rows, labels):
    """Applies every order to the list of documents, filter by filter."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    judged = [
        (p or "", fails(t, i is not None and i > first[t or ""]), labels.get(i, (0, 0)))
        for i, t, p in rows
    ]
    out = {}
    for part in {p for p, _, _ in judged}:
        own = [(f, flags) for p, f, flags in judged if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[0]]
                left = [x for x in left if name not in x[0]]
                total[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in f for f, _ in own) - len(gone),
                    sum(f == name for f, _ in own), sum(g for _, (g, _) in gone), sum(t for _, (_, t) in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


NUMBERS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def collected(frame):
    rows = frame.collect()
    assert all(r["filter"] == r["filter_order"][r["step"] - 1] for r in rows)
    found = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in NUMBERS] for r in rows}
    assert len(found) == len(rows)
    return found


def corpus(awkward):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    prose = lambda n: " ".join(rng.sample(words, n))
    texts = [*awkward, *awkward[:9]]
    texts += [prose(150), prose(150).upper(), prose(150) + " #", "b " * 150, "B # " * 200, prose(99) + " A|"]
    texts += [texts[-1], texts[-2], "é" * 10 + "A", "\U0001f600" * 10 + "AA"]
    ids = [None if i % 11 == 5 else i // 2 if i % 7 == 3 else i for i in range(len(texts))]
    parts = [(None, "", "en", "de", "日本")[i % 5] for i in range(len(texts))]
    labels = {i: (i % 3 == 0, i % 4 == 1) for i in range(0, len(texts), 2)}
    return list(zip(ids, texts, parts)), labels


def frames(spark, rows, labels):
    rows = [(*r, 1, "x", 0.5, True) for r in rows]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, mask int, part string, key double, digest boolean"
    )
    marks = [(i, int(g), int(t), "z") for i, (g, t) in labels.items()] + [(0, 0, 0, "z"), (None, 1, 1, "z")]
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int, key string")


def test_against_brute_force(spark, awkward):
    rows, labels = corpus(awkward)
    docs, marks = frames(spark, rows, labels)
    assert collected(a.interactions(docs, marks, FLAGS)) == brute(rows, labels)


def test_empty_tables(spark):
    docs, marks = frames(spark, [(1, "a", "en")], {})
    assert a.interactions(docs.limit(0), marks, FLAGS).count() == 0
    found = collected(a.interactions(docs, marks.limit(0), FLAGS))
    assert found == brute([(1, "a", "en")], {})


def test_text_keys(spark):
    docs = spark.createDataFrame([("b", "t", "x"), ("a", "t", "x")], "doc_id string, text string, lang string")
    rows = a.with_repeats(a.measured(docs)).collect()
    assert {r["key"]: r["repeats"] for r in rows} == {"a": False, "b": True}


@pytest.mark.parametrize("filters", range(1, 7))
def test_swaps_meet_every_order_once(filters):
    order, seen = list(range(filters)), set()
    seen.add(tuple(order))
    for level in a.swaps(filters):
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.add(tuple(order))
    assert len(seen) == len(list(a.swaps(filters))) + 1 == len(list(itertools.permutations(range(filters))))


def test_swapped_diagram_is_the_one_built_for_that_order():
    rng = random.Random(1)
    for _ in range(20):
        counts = {m: (rng.randint(1, 2), m % 3) for m in rng.sample(range(32), rng.randint(0, 32))}
        diagram = a.Diagram(counts, 5, 2)
        for level in a.swaps(5):
            diagram.swap(level)
            moved = {sum((m >> v & 1) << i for i, v in enumerate(diagram.order)): c for m, c in counts.items()}
            built = a.Diagram(moved, 5, 2)
            assert [x[1:] for x in diagram.steps()] == [x[1:] for x in built.steps()]
            # shared branches: no more nodes on a level than in a diagram made for the order
            assert [len(x) for x in diagram.levels] == [len(x) for x in built.levels]


def test_too_many_filters(spark):
    with pytest.raises(ValueError):
        a.audit(spark.createDataFrame([], "part string, mask int, n long"), "ABCDEFGHI")


def test_registered_query_against_brute_force(spark, folder):
    read = lambda t: spark.read.parquet(f"{folder}/{t}.parquet").collect()
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in read("documents")]
    labels = {r["doc_id"]: (r["quality"] == 1, r["toxic"] == 1) for r in read("labels")}
    assert collected(queries()["op11_filter_audit"](spark, folder)) == brute(rows, labels)
