import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_texts() -> list[str | None]:
    """NULL, empty, blank, very short, very long, repeated and non-ASCII texts."""
    rng = random.Random(7)
    words = ["w%d" % i for i in range(400)] + ["the", "of", "and", "été", "日本", "naïve"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = line(30_000)
    shared = line(120)
    return [
        None, "", "   \n\t ", "a", "a b", "The the THE the", line(60), line(60), line(300),
        shared, shared, shared, line(20) + " " + shared + " " + line(20), long, long + " tail",
        "\n".join(["same line here"] * 40), "x" * 5000, "é" * 3000, "# $ % & | < > *" * 30, "\x00\x01 z",
    ]


@pytest.fixture(scope="session")
def awkward():
    return awkward_texts()


@pytest.fixture
def docs(spark):
    """A frame of documents from texts, with columns that clash with the operators' own names."""

    def make(texts, start=0):
        rows = [
            (i + start, t, "en", "s%d" % (i % 3), len(t or ""), i, "x", 1.5)
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(
            rows, DOC + ", n_words long, key string, score double"
        ).withColumnRenamed("n_words", "failures")

    return make


@pytest.fixture
def folder():
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("test data not there")
    return path
