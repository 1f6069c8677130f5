import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from zilverspoor.llm import byte_bpe as b

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=b.read_ranks(PATH), special_tokens={}
    )


TEXTS = [
    "it's 'll we'd  x", "a  b\n\n c \x1c d", "日本語 テスト 😀😀  　 z", "aaaa" * 2000, " " * 500,
    "tab\tthe \r\n  x", "x y  z", "12345 67 8,9.0", "Ünïcödé Straße ſ",
]


def test_ids_equal_the_library(docs, awkward, library):
    texts = awkward + TEXTS
    rows = b.encode(docs(texts), PATH, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    for row, text in zip(rows, texts):
        assert row["ids"] == library.encode_ordinary(text or "")


def test_round_trip_and_columns(docs, awkward):
    frame = docs(awkward)
    encoded = b.encode(frame, PATH, public_tokenizers.PATTERN)
    assert encoded.columns == [*frame.columns, "ids"]
    back = b.decode(encoded, PATH).orderBy("doc_id").collect()
    assert [bytes(r["decoded"]).decode() for r in back] == [t or "" for t in awkward]
    assert b.encode(docs([]), PATH, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        b.encode(encoded, PATH, public_tokenizers.PATTERN)


def test_unknown_ids_are_refused(spark):
    with pytest.raises(Exception, match="not in the vocabulary"):
        b.decode(spark.createDataFrame([([10**6],)], "ids array<int>"), PATH).collect()


def slow(piece, ranks):
    parts = [bytes([x]) for x in piece]
    while True:
        pairs = [(ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1)]
        if not pairs or min(pairs)[0] == 1 << 40:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_merges_of_any_vocabulary():
    """Also where a merge lets a lower rank appear, and where equal pairs overlap."""
    for seed in range(30):
        rng = random.Random(seed)
        tokens = [bytes([x]) for x in b"abc"]
        while len(tokens) < 25:
            new = rng.choice(tokens) + rng.choice(tokens)
            if new not in tokens:
                tokens.append(new)
        late = tokens[3:]
        rng.shuffle(late)
        ranks = {t: i for i, t in enumerate(tokens[:3] + late)}
        vocab = b.Vocabulary(ranks)
        pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 60))) for _ in range(40)]
        offsets = np.cumsum([0] + [len(p) for p in pieces])
        ids, counts = vocab.merge(np.frombuffer(b"".join(pieces), np.uint8), offsets)
        ends = np.cumsum(counts)
        for piece, begin, end in zip(pieces, ends - counts, ends):
            assert ids[begin:end].tolist() == slow(piece, ranks)


def test_rank_queue_gives_ranks_in_order():
    queue, rng = b.RankQueue(300_000), random.Random(0)
    ranks = [rng.randrange(300_000) for _ in range(2000)]
    for rank in ranks:
        queue.push(rank, np.array([rank]))
    out = []
    while (item := queue.pop()) is not None:
        out += [item[0]] * len(item[1])
    assert out == sorted(ranks)


def test_registered_query(spark, library, folder):
    from zilverspoor.llm.queries import queries

    rows = queries()["op10_byte_bpe"](spark, folder).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
