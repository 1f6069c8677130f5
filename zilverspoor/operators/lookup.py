"""Decoding through domain tables.

Domain tables are small in practice, yet nothing here forces a broadcast:
Spark broadcasts a side by itself while its size stays under the threshold and
falls back to a shuffled join beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Household relation codes and their descriptions.
HOUSEHOLD_RELATIONS = (
    (1, "Hoofd gezin zonder kind(eren)", "M"),
    (2, "Hoofd gezin met kind(eren)", "M"),
    (3, "Ouder met kind(eren)", "M of V"),
    (4, "Echtgenote binnen gezin", "V"),
    (5, "Kind", "M of V"),
    (6, "Alleenstaand/Samenwonend", "M of V"),
    (7, "Hoofd partnerrelatie", "M of V"),
    (8, "Hoofd huwelijk gelijk geslacht", "M of V "),
)


def household_relations(spark: SparkSession) -> DataFrame:
    """The eight household relations; a fixed list, so a broadcast is always safe."""
    rows = ", ".join(f"({n}, '{text}', '{who}')" for n, text, who in HOUSEHOLD_RELATIONS)
    relation = spark.sql(f"SELECT * FROM VALUES {rows} AS v(nummer, omschrijving, geslacht)")
    return F.broadcast(relation)


def decode(df: DataFrame, code: str, domains: DataFrame, domain: str, out: str) -> DataFrame:
    """Add the description of a code from one domain of a (kode, kveld, oms) table."""
    labels = domains.where(F.col("kveld") == domain).select(
        F.col("kode").alias("__kode"), F.col("oms").alias(out)
    )
    return df.join(labels, F.col(code) == F.col("__kode"), "left").drop("__kode")


def coalesced_lookup(
    df: DataFrame, key: str, first: DataFrame, second: DataFrame, value: str, out: str
) -> DataFrame:
    """Left join two registers on the same key and take the first's value, else the second's."""
    one = first.select(F.col(key).alias("__k1"), F.col(value).alias("__v1"))
    two = second.select(F.col(key).alias("__k2"), F.col(value).alias("__v2"))
    return (
        df.join(one, F.col(key) == F.col("__k1"), "left")
        .join(two, F.col(key) == F.col("__k2"), "left")
        .withColumn(out, F.coalesce("__v1", "__v2"))
        .drop("__k1", "__v1", "__k2", "__v2")
    )
