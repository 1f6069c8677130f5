"""From raw documents to token ids: quality rules, near-duplicates, contamination, secrets, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and gives a frame; the driver of a run writes it as
Parquet and reads it again for the next stage. All stages but the last give the columns they got.

Defined cases of all stages: other columns of any name pass through (the last stage leaves them
out); an empty table gives an empty one. NULL and empty texts fail the quality rules, are no copies
of each other, are clean of the benchmark, hold no secrets and have no ids. Repeated rows are one
class of near copies, of which one row stays; the other stages judge them one by one. Ids are whole
numbers; rows without one are kept like others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zilverspoor.llm import (
    byte_bpe,
    decontaminate,
    minhash_dedup,
    quality_rules,
    secret_scan,
)
from zilverspoor.llm.common import kept, ready, table

#: Rank file of the vocabulary that the last stage encodes with.
RANKS = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy keeps."""
    ready(spark)
    return quality_rules.keep_clean(docs, "standard")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near copies."""
    ready(spark)
    return minhash_dedup.drop_duplicates(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of the benchmark than the limit."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars`` follows where the text changes."""
    ready(spark)
    forest = secret_scan.fit(secret_scan.labelled_findings(spark))
    out = secret_scan.redact(docs, forest)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Document id, number of token ids and the ids."""
    ready(spark)
    path = public_tokenizers.path(RANKS)
    found = byte_bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("contamination", contamination),
    ("secrets", secrets),
    ("token_ids", token_ids),
]

#: Near-duplicates and the forest can't be said in SQL; the run is tested stage by stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
