"""Registered queries that SQL cannot say, on a given table, against plain loops."""

import hashlib
import math
import re
import zlib

import pytest
import test_minhash_dedup as near
import test_ngram_trie as grams
from pyspark.sql import functions as F

from zilverspoor.llm import secret_scan, toxicity
from zilverspoor.llm.queries import queries

WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


@pytest.fixture
def given(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    return {r["doc_id"]: r["text"] for r in rows.collect()}


def remainder(key, parts):
    return zlib.crc32(str(key).encode()) % parts


def test_near_duplicates(spark, folder, given):
    found = {r["doc_id"]: r["class_id"] for r in queries()["op1_minhash_dedup"](spark, folder).collect()}
    ids = list(given)
    want = [ids[c] for c in near.brute([given[i] for i in ids])]
    groups = lambda of: {frozenset(i for i in ids if of[i] == c) for c in set(of.values())}
    assert set(found) == set(ids)
    assert groups(found) == groups(dict(zip(ids, want)))
    assert len(set(want)) < len(ids)  # there are copies


def test_ngram_scores(spark, folder, given):
    rows = queries()["op3_ngram_trie"](spark, folder).orderBy("doc_id").collect()
    assert [r["held_out"] for r in rows] == [remainder(i, 7) == 2 for i in given]
    train = [t for i, t in given.items() if remainder(i, 7) != 2]
    grams.check(rows, grams.brute(train, list(given.values())))


def toxic_score(text, model):
    """One text after the other, word by word, without transducers."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    clauses: dict[int, list] = {}
    for m in WORD.finditer(low):
        clauses.setdefault(len(re.findall(r"[.!?;:\n]", low[: m.start()])), []).append(m[0])
    found = [0.0] * toxicity.CATEGORIES
    for words in clauses.values():
        stem = lambda w: next((s for n in model.lengths if (s := w[:n]) in model.stems and len(w) >= n), None)
        fixed = lambda w, some: stem(w) is None and w in some
        targeted = any(fixed(w, toxicity.TARGETS) for w in words)
        reported = any(fixed(w, toxicity.REPORTS) for w in words)
        for i, w in enumerate(words):
            threat = fixed(w, toxicity.THREATS)
            if threat or stem(w) is not None:
                negated = any(fixed(x, toxicity.NEGATIONS) for x in words[max(0, i - toxicity.REACH) : i])
                place = 8 * threat + 4 * targeted + 2 * negated + reported
                found[place] += 1.0 if threat else model.stems[stem(w)]
    *weights, constant = model.coefficients
    total = sum(w * math.log1p(x) for w, x in zip(weights, found)) + constant
    return 1 / (1 + math.exp(-min(max(total, -30), 30)))


def test_toxicity_scores(spark, folder, given):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"), 4, 2)))
    rows = queries()["op2_toxicity"](spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(given)
    for r in rows:
        assert r["held_out"] == (remainder(r["doc_id"], 4) == 2)
        assert r["score"] == pytest.approx(toxic_score(given[r["doc_id"]], model), abs=1e-9)
        assert r["predicted"] == (r["score"] >= 0.3)


def test_scores_of_a_clause_by_hand():
    model = toxicity.Model({"grob": 2.0, "zwet": 3.0}, [i / 10 for i in range(16)] + [-1.0])
    texts = [
        "you are a groblin", "not a groblin", "not one two three groblin", "he said: you zwetter", "he said you zwetter",
        "I will kill you. Never groblin!", "never kill or groblin dich", "Zwet\nzwet zwet", "", None, "plain words",
    ]
    import pyarrow as pa

    found = toxicity.features(pa.array(texts, pa.string()), model, toxicity.compose())
    got = toxicity.scores(found, model).tolist()
    assert got == pytest.approx([toxic_score(t, model) for t in texts], abs=1e-12)
    assert len(set(got[:7])) > 4


def test_found_secrets_stand_where_they_are_said_to(spark, folder):
    folder = folder.replace("sf0.001", "sf0.01")  # the smallest table that holds some
    rows = queries()["op4_secret_scan"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert any(r["secret"] for r in rows) and not all(r["secret"] for r in rows)
    for r in rows:
        part = given[r["doc_id"]][r["start"] : r["end"]]
        assert hashlib.sha256(part.encode()).hexdigest() == r["value_sha256"]
    places = [(r["doc_id"], r["start"]) for r in rows]
    assert len(places) == len(set(places))


def test_templates_that_were_never_seen(spark):
    """Whole templates are left out in turn; what the forest says of them is its figure."""
    lines = [F.struct(F.lit(m).alias("label"), t.alias("text")) for m, t in secret_scan._templates()]
    drawn = secret_scan._draws(spark.range(40, numPartitions=1))
    each = drawn.select("id", F.posexplode(F.array(*lines)).alias("template", "line"))
    each = each.select("id", "template", "line.*").cache()
    right = total = 0
    for fold in range(5):
        forest = secret_scan.fit(each.filter(F.col("template") % 5 != fold))
        held = each.filter(F.col("template") % 5 == fold)
        found = secret_scan.scan(held.withColumn("key", F.struct("id", "template", "label", "text")), forest, key="key")
        for r in found.groupBy("key").agg(F.max("secret").alias("secret")).collect():
            right += bool(r["key"]["label"]) == r["secret"]
            total += 1
    print(f"unseen templates judged right: {right} of {total}")
    assert total > 1800 and right >= 0.75 * total


def test_keys_that_are_no_numbers_are_errors(spark):
    import public_tokenizers

    from zilverspoor.llm import decontaminate, minhash_dedup, quote_linking, token_records
    from zilverspoor.session import run_dir

    docs = spark.createDataFrame([("abc", "some words here")], "doc_id string, text string")
    talk = spark.createDataFrame([("abc", 0, "a", "hi")], "conv_id string, turn int, role string, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = run_dir(spark, "keys")
    for run in (
        lambda: minhash_dedup.classes(docs).collect(),
        lambda: token_records.write(docs, folder, path, 2),
        lambda: quote_linking.conversations(talk).collect(),
        lambda: decontaminate.hits(docs, docs, item="doc_id").collect(),
    ):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            run()
