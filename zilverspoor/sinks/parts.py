"""Dumping tables as Parquet parts with a manifest of the run."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zilverspoor.sources.files import list_files
from zilverspoor.sources.footers import read_footers


def dump_parts(
    frames: Mapping[str, DataFrame],
    folder: str,
    max_rows_per_part: int = 0,
    run_id: str | None = None,
) -> str:
    """Write each frame as parts and return the path of the manifest.

    A part is what a task writes, unless ``max_rows_per_part`` cuts it. A frame
    without rows gets no part. The manifest is written last, and Spark commits it
    as a whole, so a manifest that can be read is complete.
    """
    if not frames:
        raise ValueError("nothing to dump")
    spark = next(iter(frames.values())).sparkSession
    run_id = run_id or uuid.uuid4().hex
    written = {}
    for name, df in frames.items():
        path = f"{folder}/{run_id}/{name}"
        df.write.option("maxRecordsPerFile", max_rows_per_part).parquet(path)
        written[name] = path
    return write_manifest(spark, f"{folder}/{run_id}-manifest", run_id, written)


def write_manifest(
    spark: SparkSession, path: str, run_id: str, folders: Mapping[str, str]
) -> str:
    """One JSON line per file of the run that has rows, with what its footer says.

    Rows, bytes, schema and bounds let a reader plan without opening the files.
    """
    tables = {f: table for table, folder in folders.items() for f in list_files(spark, folder)}
    named = spark.createDataFrame(list(tables.items()), "file string, table_name string")
    lines = read_footers(spark, list(tables)).where("rows > 0").join(named, "file")
    lines.select(
        F.lit(run_id).alias("run_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        "table_name",
        "file",
        "rows",
        "bytes",
        "schema",
        "bounds",
    ).write.json(path)
    return path
