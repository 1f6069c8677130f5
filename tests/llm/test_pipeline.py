import os

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as driver
import corpus_pipeline as p
from zilverspoor.checks.compare import compare, duck
from zilverspoor.llm import byte_bpe, quality_rules
from zilverspoor.llm.queries import oracle_sql, queries

NAMES = [n for n, _ in p.STAGES]


def test_queries_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")}
    assert numbers == set(range(1, 14))
    assert set(queries()) | {"pipeline"} <= set(driver.queries())
    assert set(oracle_sql()) <= set(driver.oracle_sql())
    assert NAMES == ["quality", "near_duplicates", "contamination", "secrets", "token_ids"]


def test_oracles(spark, folder):
    connection = duck(folder)
    for name, sql in oracle_sql().items():
        assert compare(queries()[name](spark, folder), connection, sql) is None, name


def write(spark, tmp_path, texts):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(os.path.join(tmp_path, "documents.parquet"))
    items = [(1, " ".join(f"bench{i}" for i in range(30)))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        os.path.join(tmp_path, "benchmark.parquet")
    )


def test_stages_take_effect(spark, tmp_path):
    def prose(seed, n=80):
        return " ".join(f"{chr(97 + (seed + i) % 26)}word{seed}of{i % 70}" for i in range(n))

    secret = prose(4) + " password=531ccd051a92ebcb68 end"
    texts = [
        prose(1), prose(1) + " tail", prose(1), "too short", prose(2) + " " + " ".join(f"bench{i}" for i in range(30)),
        prose(3), secret, "# " * 200,
    ]
    write(spark, str(tmp_path), texts)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, left = docs.columns, []
    for name, stage in p.STAGES:
        docs = p.kept(stage(spark, docs, str(tmp_path)), name)
        left.append(sorted(r["doc_id"] for r in docs.collect()))
        if name != NAMES[-1]:
            assert docs.columns == columns, name
        if name == "secrets":
            masked = docs.filter("doc_id = 6").first()
            assert masked["text"] == prose(4) + " password=[SECRET] end"
            assert masked["n_chars"] == len(masked["text"])
    assert left == [[0, 1, 2, 4, 5, 6], [0, 4, 5, 6], [0, 5, 6], [0, 5, 6], [0, 5, 6]]


def test_run_gives_ids_of_the_kept_texts(spark, folder):
    rows = {r["doc_id"]: r for r in p.run(spark, folder).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    clean = {r["doc_id"] for r in quality_rules.ledger(spark.read.parquet(f"{folder}/documents.parquet")).filter(quality_rules.verdict("standard")).collect()}
    assert rows and set(rows) <= clean
    ranks = byte_bpe.read_ranks(public_tokenizers.path(p.RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    same = 0
    for i, row in rows.items():
        text = library.decode(row["ids"])
        assert row["n_tokens"] == len(row["ids"])
        assert row["ids"] == library.encode_ordinary(text)
        same += text == texts[i]
        assert text == texts[i] or "[SECRET]" in text
    assert same > 0.9 * len(rows)


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, row_ string, key int, failures string, spans int, `class` string"


@pytest.mark.parametrize("name", NAMES)
def test_stages_on_awkward_tables(spark, tmp_path, awkward, name):
    write(spark, str(tmp_path), ["x"])
    stage = dict(p.STAGES)[name]
    rows = [(None if i == 3 else i, t, None, "s", None, "x", 1, "y", 2, "z") for i, t in enumerate(awkward)]
    docs = spark.createDataFrame(rows, AWKWARD)
    for frame, n in ((docs.limit(0), 0), (docs, len(awkward)), (docs.unionAll(docs), 2 * len(awkward))):
        out = stage(spark, frame, str(tmp_path))
        found = out.collect()
        if name == NAMES[-1]:
            assert out.columns == ["doc_id", "n_tokens", "ids"]
        else:
            assert out.columns == docs.columns and out.schema["text"] == docs.schema["text"]
            given = {r[1] for r in rows}
            assert {r["text"] for r in found} <= given
        assert len(found) <= n
        if name not in ("quality", "near_duplicates"):
            assert len(found) == n
        if name == "near_duplicates" and n:
            one = sum(t is None or not t.strip() for t in awkward)
            assert len(found) < n and sum(not (r["text"] or "").strip() for r in found) >= one
