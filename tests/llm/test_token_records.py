import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from zilverspoor.llm import token_records as t
from zilverspoor.llm.common import filesystem
from zilverspoor.session import run_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
END = 2


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


TEXTS = ["it's 'LL we'd A.B, x-y", "é É 日本 x́ z", "<|endoftext|> a", "U.S.A. 12,345", "x y \x1c z"]


def test_round_trip_in_key_order(spark, docs, awkward, library):
    texts = awkward + TEXTS
    out = run_dir(spark, "records")
    found = t.write(docs(texts), out, PATH, END, file_bytes=20_000)
    assert found.count() > 2
    rows = t.read(spark, out, records=3).orderBy("key").collect()
    start = 0
    for i, (row, text) in enumerate(zip(rows, texts)):
        ids = [*library(text), END]
        assert (row["key"], row["start"], row["n_tokens"]) == (i, start, len(ids))
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids
        start += len(ids)
    assert len(rows) == len(texts)


def test_nulls_ties_and_empty_tables(spark, library):
    frame = spark.createDataFrame(
        [(None, "z"), (3, "b"), (3, "a"), (3, "a"), (1, None)], "doc_id long, text string"
    )
    out = run_dir(spark, "records")
    t.write(frame, out, PATH, END)
    rows = t.read(spark, out).orderBy("start").collect()
    assert [r["key"] for r in rows] == [None, 1, 3, 3, 3]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in rows] == [
        [*library(x), END] for x in ["z", "", "a", "a", "b"]
    ]
    empty = run_dir(spark, "records")
    assert t.write(frame.limit(0), empty, PATH, END).count() == 0
    assert t.read(spark, empty).count() == 0


def test_damage_is_found(spark, docs):
    out = run_dir(spark, "records")
    name = t.write(docs(["some words here"]), out, PATH, END).first()["data"]
    file = os.path.join(filesystem(out)[1], name)
    raw = bytearray(open(file, "rb").read())
    raw[25] ^= 1
    open(file, "wb").write(raw)
    with pytest.raises(Exception, match="damaged record"):
        t.read(spark, out).collect()


def test_masked_checksum_differs_from_the_plain_one():
    assert t.masked(b"abc") != zlib.crc32(b"abc")
    key, ids = t.open_record(np.frombuffer(t.record(7, b"\1\0"), np.uint8), 0, 8 + 4 + 9 + 2 + 4)
    assert (key, ids) == (7, b"\1\0")


def test_ids_must_fit(spark, docs):
    with pytest.raises(Exception, match="do not fit"):
        t.write(docs(["some words here"]), run_dir(spark, "records"), PATH, END, width=1)


def test_registered_query(spark, library, folder):
    from zilverspoor.llm.queries import queries

    rows = queries()["op9_token_records"](spark, folder).orderBy("doc_id").collect()
    texts = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    assert len(rows) == len(texts)
    for row, doc in zip(rows, texts):
        ids = np.array([*library(doc["text"]), END], "<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc["doc_id"], start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(ids.tobytes())
        start += len(ids)
