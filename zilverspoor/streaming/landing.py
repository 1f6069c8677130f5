"""Pick up new part files and bring them to bronze, each file once.

Structured Streaming keeps in its checkpoint which files a run has taken, so a
run that is repeated after a failure takes up where the last one stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from zilverspoor.operators.conform import to_bronze
from zilverspoor.operators.history import latest_rows
from zilverspoor.sinks.tables import TableStore


def landing_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000
) -> DataFrame:
    """New part files of a folder as bronze rows."""
    parts = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
    return to_bronze(parts)


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Add a batch to a folder, one subfolder per stream and batch.

    A batch that runs again overwrites its own subfolder only, so its rows are
    never there twice. A stream is known by the id its checkpoint keeps: with a
    new checkpoint batches count from 0 again, but into folders of their own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"stream={stream or 'none'}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(f"{path}/{folder}")

    return write


def upsert_batches(
    store: TableStore, table: str, key: list[str], version: str
) -> Callable[[DataFrame, int], None]:
    """Merge batches into a table by key; of all rows for one key the latest counts.

    What is known of a key is its row in the table's bucket. A batch reads and writes the buckets
    of its own keys only, once, and stored rows that are later stay. A batch that runs again changes
    nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = latest_rows(batch, key, version)
        store.write(rows, table, "upsert", key=key, newest_by=version)

    return write


def land(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]
) -> None:
    """Take every file that is there now, then stop."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``append_batches`` has written so far."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
