"""Registry of queries with their oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.session import run_dir, tune
from zilverspoor.sinks.tables import TableStore


# the given tables do not change, so their footers are looked at once
_schemas: dict[str, T.StructType] = {}


class Tables:
    """The given tables of one folder as frames, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def run_dir(self, label: str) -> str:
        return run_dir(self.spark, label)

    def store(self, label: str) -> TableStore:
        """A table store of its own, so queries never meet."""
        name = f"zs_{label}_{uuid.uuid4().hex[:8]}"
        return TableStore(self.spark, name, self.run_dir(label))


@dataclass(frozen=True)
class Check:
    query: Callable[[Tables], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None):
    """Register a query under a name together with its oracle SQL."""

    def register(query: Callable[[Tables], DataFrame]):
        if name in CHECKS:
            raise ValueError(f"two queries named {name}")
        CHECKS[name] = Check(query, sql)
        return query

    return register


def portable(df: DataFrame) -> DataFrame:
    """Dates and decimals as text, so both engines hand out the same values."""
    as_text = (T.DateType, T.DecimalType)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, as_text)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def text(sql: str, *columns: str) -> str:
    """The SQL with the named columns cast to text."""
    casts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({sql}) AS typed"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(entry: Check) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: portable(entry.query(Tables(tune(spark), folder)))

    return {name: runner(entry) for name, entry in CHECKS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.sql for name, entry in CHECKS.items() if entry.sql is not None}
