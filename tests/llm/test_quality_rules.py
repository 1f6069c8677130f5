import re
import time
from collections import Counter

import pytest

from zilverspoor.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
        len(lines) - len(set(lines)), len(hit),
    )


def test_measures_against_brute_force(docs, awkward):
    texts = [*awkward, "a b a b a b a", "x y z x y z", "😀 é # a\tb\x0bc", "one two three " * 200]
    rows = q.ledger(docs(texts)).orderBy("doc_id").collect()
    assert [tuple(r[m] for m in q.MEASURES) for r in rows] == [brute(t) for t in texts]


def test_long_texts_take_the_exact_way(docs, awkward, monkeypatch):
    monkeypatch.setattr(q, "POSITION_BITS", 3)  # texts of seven words or more count as long
    rows = q.ledger(docs(awkward)).orderBy("doc_id").collect()
    assert [r["n_repeat_words"] for r in rows] == [brute(t)[-1] for t in awkward]


def test_bits_policies_and_ablations(docs):
    good = " ".join(f"word{i}" for i in range(60))
    texts = [good, good + " " + "# " * 30, "\n".join([good] * 4), "few", "few #", None]
    book = q.ledger(docs(texts))
    bits = [r["failures"] for r in book.orderBy("doc_id").collect()]
    assert bits[0] == 0 and bits[1] == 0b100 and bits[2] == 0b1010 and bits[3] == 1
    assert bits[4] & 0b101 == 0b101 and bits[5] & 1
    rows = {(r["policy"], r["rule"]): r for r in q.ablations(book).collect()}
    for (policy, rule), row in rows.items():
        mask = q.POLICIES[policy]
        less = mask & ~(1 << next(r.bit for r in q.RULES if r.name == rule))
        assert row["kept"] == sum(not b & mask for b in bits)
        assert row["kept_without"] == sum(not b & less for b in bits)
    assert len(rows) == sum(bin(m).count("1") for m in q.POLICIES.values())


@pytest.mark.parametrize("condition", [*q.POLICIES, "n_repeat_words > 3 and n_words < 40"])
def test_conditions_on_a_ledger_do_not_measure_again(docs, awkward, condition):
    texts = [*awkward, *[f"w{i} x y z w{i} x y z " * 20 for i in range(20)]]
    book = q.ledger(docs(texts))
    held = book.filter(q.verdict(condition) if condition in q.POLICIES else condition)
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") == 1
    assert "Filter" in plan and plan.index("Filter") < plan.index("xxhash64")
    began = time.monotonic()
    got = sorted(r["doc_id"] for r in held.collect())
    assert time.monotonic() - began < 30
    rows = book.collect()
    if condition in q.POLICIES:
        want = [r["doc_id"] for r in rows if not r["failures"] & q.POLICIES[condition]]
    else:
        want = [r["doc_id"] for r in rows if r["n_repeat_words"] > 3 and r["n_words"] < 40]
    assert got == sorted(want)


def test_keep_clean_keeps_columns_and_rows(spark, docs):
    good = " ".join(f"word{i}" for i in range(60))
    frame = docs([good, "bad", None, good]).withColumnRenamed("key", "row_")
    kept = q.keep_clean(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3]
    assert q.keep_clean(docs([])).count() == 0
    assert q.ablations(q.ledger(docs([]))).count() == 0


def test_a_rule_has_a_bit_of_its_own():
    assert len({r.bit for r in q.RULES}) == len(q.RULES)
    with pytest.raises(KeyError):
        q.verdict("unknown")
