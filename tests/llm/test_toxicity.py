import random

import pytest

from zilverspoor.llm import toxicity as t

WORDS = [f"word{i}" for i in range(200)]


def corpus(n=240):
    rng, rows = random.Random(2), []
    for i in range(n):
        text = [rng.choice(WORDS) for _ in range(rng.randint(20, 80))]
        toxic = i % 4 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["grobling", "groblings", "zwetsoid"]))
        rows.append((i, " ".join(text) + ".", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = [r for r in corpus() if r[0] % 3]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return t.fit(docs, labels)


def test_learns_stems_and_scores_unseen_texts(spark, model):
    assert {"gro", "zwe"} <= {s[:3] for s in model.stems}
    rows = [r for r in corpus() if not r[0] % 3]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in t.score(docs, model).collect()}
    right = sum((found[i] >= t.THRESHOLD) == bool(toxic) for i, _, toxic in rows)
    assert right >= 0.95 * len(rows)


def test_awkward_texts_get_the_score_of_no_evidence(docs, awkward, model):
    rows = t.score(docs(awkward), model).collect()
    assert len(rows) == len(awkward)
    assert {round(r["score"], 9) for r in rows} == {round(rows[0]["score"], 9)}
    assert rows[0]["score"] < t.THRESHOLD
    assert t.score(docs([]), model).count() == 0


def test_clauses_not_isolated_words():
    model = t.Model({"fool": 2.0}, [1.0] * t.CATEGORIES + [-3.0])
    grammar = t.compose()
    import pyarrow as pa

    texts = ["a fool", "you fool", "not a fool", "she said a fool", "you. a fool", "I kill you", None]
    found = t.features(pa.array(texts), model, grammar)
    where = [
        t.category(t.INSULT, 0, False, 0), t.category(t.INSULT, 1, False, 0),
        t.category(t.INSULT, 0, True, 0), t.category(t.INSULT, 0, False, 1),
        t.category(t.INSULT, 0, False, 0), t.category(t.THREAT, 1, False, 0),
    ]
    for row, column in zip(found, where):
        assert row[column] > 0 and (row > 0).sum() == 1
    assert not found[-1].any()


def test_a_negation_reaches_three_words():
    grammar = t.compose()
    for gap, negated in ((0, True), (2, True), (3, False), (9, False)):
        out = grammar.clause([t.NEGATION, t.INSULT], [0, gap], [1.0, 2.0])
        assert out == {t.category(t.INSULT, 0, negated, 0): 2.0}


def test_without_labels_and_with_odd_ones(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = t.fit(docs(["a b"]), labels)
    assert model.stems == {}
    odd = spark.createDataFrame([(0, None), (None, 1), (1, 0), (1, 1)], "doc_id long, toxic int")
    assert t.score(docs(["x", "y"]), t.fit(docs(["x", "y"]), odd)).count() == 2


def test_registered_query_on_held_out_rows(spark, folder):
    from zilverspoor.llm.queries import queries

    rows = {r["doc_id"]: r for r in queries()["op2_toxicity"](spark, folder).collect()}
    marks = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [(rows[m["doc_id"]], m["toxic"]) for m in marks if rows[m["doc_id"]]["held_out"]]
    assert held and all(0 <= r["score"] <= 1 for r in rows.values())
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    assert sum(r["predicted"] == toxic for r, toxic in held) >= 0.9 * len(held)
