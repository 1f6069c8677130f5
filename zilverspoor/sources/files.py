"""Parquet part sets, manifests and CSV folders."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from zilverspoor.operators.columns import lower_columns
from zilverspoor.operators.conform import harmonise_decimals
from zilverspoor.sources.csv_split import read_records
from zilverspoor.sources.footers import FOOTER, may_hold, read_footers, schema_of

# Fixed value: the part number at the end of a part file's name.
_PART = re.compile(r"^(?P<base>.+)_part\d+$")


class ManifestError(ValueError):
    """The manifest is missing, unreadable or lists a file that is gone."""


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> list[str]:
    """Paths of the files in a folder: Spark lists it, no file is opened and no task runs.

    The names of files, not their rows; Spark's own planner holds the same list.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.inputFiles()


def table_name(file_name: str) -> str:
    """The table a part belongs to: no part number, no brackets, dots as underscores."""
    stem = re.sub(r"\.parquet$", "", unquote(file_name).rsplit("/", 1)[-1], flags=re.IGNORECASE)
    match = _PART.match(stem)
    base = match.group("base") if match else stem
    return base.replace("[", "").replace("]", "").replace(".", "_")


def group_part_files(paths: Iterable[str]) -> dict[str, list[str]]:
    """Parquet paths by table, sorted."""
    groups: dict[str, list[str]] = defaultdict(list)
    for path in paths:
        if path.lower().endswith(".parquet"):
            groups[table_name(path)].append(path)
    return {name: sorted(files) for name, files in groups.items()}


def _literal_path(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    if urlparse(path).scheme:
        path = unquote(path)
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_part_set(
    spark: SparkSession, paths: Sequence[str], widen_decimals: bool = False
) -> DataFrame:
    """All parts of one table.

    ``widen_decimals`` reads each part with its own schema, for services whose
    decimals differ per page; without it the parts are one scan. The schemas come
    from the footers, which one job reads and groups.
    """
    if not widen_decimals:
        return lower_columns(spark.read.parquet(*[_literal_path(p) for p in paths]))
    files = [f for p in paths for f in _parquet_files(spark, p)]
    shapes = read_footers(spark, files).groupBy("schema").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return _of_shapes(spark, {r["schema"]: r["files"] for r in shapes.collect()})


def _parquet_files(spark: SparkSession, path: str) -> list[str]:
    """A part is a file, or a folder that a writer has filled."""
    return [path] if _is_file(spark, path) else list_files(spark, _literal_path(path))


def _is_file(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).isFile(hadoop)


def _of_shapes(spark: SparkSession, shapes: Mapping[str | None, Sequence[str]]) -> DataFrame:
    """Files by their schema; each schema is one scan, which opens no file before it runs."""
    frames = []
    for text, files in sorted(shapes.items(), key=lambda s: s[1]):
        literal = [_literal_path(f) for f in files]
        if text is None:  # only Spark can tell; such files are looked at one by one
            frames += [spark.read.parquet(f) for f in literal]
        else:
            frames.append(spark.read.schema(schema_of(text)).parquet(*literal))
    return harmonise_decimals(frames)


def read_part_folder(
    spark: SparkSession, folder: str, widen_decimals: bool = False
) -> dict[str, DataFrame]:
    """Every table of a folder of part files."""
    groups = group_part_files(list_files(spark, folder))
    return {name: read_part_set(spark, files, widen_decimals) for name, files in groups.items()}


@dataclass(frozen=True)
class Between:
    """A range of a column's values, ends included; an end that is None is open."""

    column: str
    low: object = None
    high: object = None

    def holds(self, kind: T.DataType) -> Column:
        value, inside = F.col(f"`{self.column.lower()}`"), F.lit(True)
        if self.low is not None:
            inside = inside & (value >= F.lit(self.low).cast(kind))
        if self.high is not None:
            inside = inside & (value <= F.lit(self.high).cast(kind))
        return inside & value.isNotNull()


def manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """The files of one run with what their footers say. A line that is not whole is an error."""
    schema = f"run_id string, created_at string, table_name string, {FOOTER}, _corrupt string"
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt")
    try:
        lines = reader.json(path)
    except AnalysisException as error:
        raise ManifestError(f"manifest {path} cannot be read") from error
    whole = F.col("_corrupt").isNull() & (F.length("table_name") > 0) & (F.length("file") > 0)
    bad = F.raise_error(F.lit(f"manifest {path} has an invalid line"))
    return lines.withColumn("table_name", F.when(F.coalesce(whole, F.lit(False)), F.col("table_name")).otherwise(bad)).drop("_corrupt")


def read_manifest(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files per table of one run. There is no fallback to listing the folder."""
    return {
        table: sorted(f for files in shapes.values() for f in files)
        for table, shapes in _shapes(manifest_lines(spark, path), path).items()
    }


def _shapes(lines: DataFrame, path: str) -> dict[str, dict[str | None, list[str]]]:
    """The files to read, by table and schema: what Spark's planner needs to know of them."""
    grouped = lines.groupBy("table_name", "schema").agg(F.sort_array(F.collect_list("file")).alias("files"))
    try:
        rows = grouped.collect()
    except Exception as error:
        raise ManifestError(f"manifest {path} has an invalid line") from error
    found: dict[str, dict[str | None, list[str]]] = defaultdict(dict)
    for row in rows:
        found[row["table_name"]][row["schema"]] = row["files"]
    return dict(found)


def read_manifest_tables(
    spark: SparkSession, path: str, ranges: Mapping[str, Between] | None = None
) -> dict[str, DataFrame]:
    """The tables of one run, from exactly the files it wrote.

    No file is opened before a table is used where the manifest has schemas. A table with a range
    gives the rows in it, and of its files only those are read whose bounds reach into the range.
    """
    lines = manifest_lines(spark, path)
    try:
        shapes = _shapes(lines, path)
        return {
            name: _read_listed(spark, path, lines, name, found, (ranges or {}).get(name))
            for name, found in shapes.items()
        }
    except AnalysisException as error:
        raise ManifestError(f"manifest {path} lists a file that cannot be read") from error


def _read_listed(
    spark: SparkSession,
    path: str,
    lines: DataFrame,
    name: str,
    shapes: Mapping[str | None, Sequence[str]],
    asked: Between | None,
) -> DataFrame:
    if None in shapes:  # a manifest without schemas
        whole = read_part_set(spark, [f for files in shapes.values() for f in files])
    else:
        whole = lower_columns(_of_shapes(spark, shapes))
    if asked is None:
        return whole
    kind = whole.schema[asked.column.lower()].dataType
    if None not in shapes:
        names = [f.name for f in schema_of(next(iter(shapes))) if f.name.lower() == asked.column.lower()]
        near = lines.where((F.col("table_name") == name) & may_hold(names[0], kind, asked.low, asked.high))
        left = _shapes(near, path).get(name)
        whole = lower_columns(_of_shapes(spark, left)) if left else whole.limit(0)
    return whole.where(asked.holds(kind))


def read_csv_folder(
    spark: SparkSession,
    folder: str,
    schemas: Mapping[str, T.StructType] | T.StructType | None = None,
) -> dict[str, DataFrame]:
    """Every CSV file of a folder as a table named after the file.

    Types are inferred, which reads a file twice, unless ``schemas`` gives them, by table or one
    for all.
    """
    tables = {}
    for path in sorted(list_files(spark, folder, "*.csv")):
        name = unquote(path).rsplit("/", 1)[-1][: -len(".csv")].lower()
        schema = schemas if isinstance(schemas, T.StructType) else (schemas or {}).get(name)
        tables[name] = read_csv(spark, path, schema)
    return tables


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    split: bool | None = None,
) -> DataFrame:
    """One CSV table with a header line; names in lower case.

    A schema's columns are found by their name in the header, in any case and order; a column that
    the header lacks and a value that is not of its type are errors. Quotes in quoted text are
    doubled. ``multi_line`` lets quoted text hold line breaks. A file of several blocks is then read
    by as many tasks, which needs its types given; ``split`` asks for that, or forbids it.
    """
    if split is None:
        split = multi_line and schema is not None and _blocks(spark, path) > 1
    if split and schema is None:
        raise ValueError("a file is split only where a schema gives its types")
    reader = (
        spark.read.option("header", "true")
        .option("multiLine", str(multi_line).lower())
        .option("escape", '"')
        .option("mode", "FAILFAST")
    )
    if schema is None:
        return lower_columns(reader.option("inferSchema", "true").csv(_literal_path(path)))
    if split:
        found = read_records(spark, _literal_path(path))
    else:
        found = lower_columns(reader.csv(_literal_path(path)))
    missing = [f.name for f in schema if f.name.lower() not in found.columns]
    if missing:
        raise ValueError(f"{path} has no column {missing}; it has {found.columns}")
    return found.select(
        *[F.col(f"`{f.name.lower()}`").cast(f.dataType).alias(f.name.lower()) for f in schema]
    )


def _blocks(spark: SparkSession, path: str) -> int:
    """Tasks that would read a file if it can be split."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(unquote(path) if urlparse(path).scheme else path)
    size = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).getLen()
    block = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return -(-size // block)


def source_count(df: DataFrame) -> DataFrame:
    """Number of rows of a source as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
