"""Records of a CSV file whose quoted text holds line breaks, found by many tasks.

Spark reads such a file in one task, as a line break inside quotes looks like the end of a record.
Whether a line begins inside quotes depends on all text before it, but only by one bit. So a line is
a function of that bit: where it ends if it begins outside of quotes, and where if inside. Functions
of successive lines compose, in a block of the file and over its blocks, so every block is read by a
task of its own: first what each block does to the bit, then the bit at each block's begin, then at
each line. Lines that begin inside quotes are put behind those that they continue.

A quote opens quoted text only at the begin of a field; inside, two quotes stand for one; what
follows the closing quote up to the next separator belongs to the field.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.session import keep


def _patterns(separator: str) -> tuple[str, str]:
    """Lines that end inside quotes, if they begin outside of them and if they begin inside."""
    s = re.escape(separator)
    quoted = '"(?:[^"]++|"")*+'
    field = f'(?:{quoted}"[^{s}]*+|[^"{s}][^{s}]*+|)'
    opened = f"(?:{field}{s})*+{quoted}$"
    from_outside = f"^{opened}"
    from_inside = f'^(?:[^"]++|"")*+(?:"[^{s}]*+{s}{opened}|$)'
    return from_outside, from_inside


def records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """``record``, the text of each record with its line breaks, and ``first`` for the header.

    A block holds as many bytes as Spark gives to a read (``spark.sql.files.maxPartitionBytes``),
    and is the largest group of rows that a task gets.
    """
    if len(separator) != 1 or separator in '"\n\r':
        raise ValueError(f"a separator is one character, not {separator!r}")
    outside, inside = _patterns(separator)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),  # the order of lines within a block
        F.col("value").alias("text"),
    )
    # a line's function: constant if both begins end alike, otherwise it keeps or turns the bit
    bare = F.rtrim(F.col("text"), F.lit("\r"))
    ends = lines.select("*", bare.rlike(outside).alias("out"), bare.rlike(inside).alias("in"))
    in_block = Window.partitionBy("file", "block").orderBy("line")
    ends = _composed(ends, in_block)
    # what each block does, and the bit at its begin
    last = F.max_by(F.struct("known", "turns"), "line").alias("end")
    blocks = ends.groupBy("file", "block").agg(last)
    blocks = blocks.select("file", "block", *_function("end"))
    order = Window.partitionBy("file").orderBy("block")
    blocks = _composed(blocks, order).select(
        "file", "block", F.lag(_bit(F.lit(False))).over(order).alias("before")
    )
    starts = F.coalesce(F.lag(_bit(F.col("at_begin"))).over(in_block), F.col("at_begin"))
    joined = ends.join(
        blocks.select("file", "block", F.coalesce("before", F.lit(False)).alias("at_begin")),
        ["file", "block"],
    )
    lines = joined.select("file", "block", "line", "text", starts.alias("goes_on"))
    lines = lines.withColumn("record", F.count_if(~F.col("goes_on")).over(in_block))
    # lines of one record within a block stand together already
    parts = lines.groupBy("file", "block", "record").agg(
        F.sort_array(F.collect_list(F.struct("line", "text"))).alias("lines"),
        F.min("line").alias("line"),
    )
    text = F.array_join(F.transform("lines", lambda x: x["text"]), "\n")
    parts = parts.select("file", "block", "record", text.alias("text"))
    return _across_blocks(keep(parts, "csv-records"))


def _function(end: str) -> list:
    """The function of a block from that of its last line: as the two ends of a line."""
    known, turns = F.col(f"{end}.known"), F.col(f"{end}.turns")
    turned = turns % 2 == 1
    fixed = known["value"] != ((turns - known["turns"]) % 2 == 1)
    return [
        F.when(known.isNotNull(), fixed).otherwise(turned).alias("out"),
        F.when(known.isNotNull(), fixed).otherwise(~turned).alias("in"),
    ]


def _composed(rows: DataFrame, window) -> DataFrame:
    """For each row the last constant function up to it, and how often the bit is turned by then."""
    turns = F.sum(F.when(F.col("out") & ~F.col("in"), 1).otherwise(0)).over(window)
    rows = rows.withColumn("turns", turns)
    constant = F.when(
        F.col("out") == F.col("in"), F.struct(F.col("out").alias("value"), "turns")
    )
    return rows.withColumn("known", F.last(constant, ignorenulls=True).over(window))


def _bit(at_begin) -> object:
    """The bit after a row, from the last constant before it or the bit at the begin."""
    since = F.col("turns") - F.coalesce(F.col("known.turns"), F.lit(0))
    return F.coalesce(F.col("known.value"), at_begin) != (since % 2 == 1)


def _across_blocks(parts: DataFrame) -> DataFrame:
    """Records whole: what a block begins with may belong to the last record of an earlier one."""
    ends = parts.groupBy("file", "block").agg(F.max("record").alias("last"))
    order = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, Window.currentRow - 1
    )
    own = F.when(F.col("last") > 0, F.struct(F.col("block").alias("block"), F.col("last").alias("record")))
    heads = ends.select("file", "block", "last", F.last(own, ignorenulls=True).over(order).alias("of"))
    placed = parts.join(heads, ["file", "block"])
    goes_on = F.col("record") == 0
    at = F.when(goes_on, F.col("of")).otherwise(F.struct("block", "record"))
    placed = placed.select("file", "block", "text", at.alias("at"), (F.col("record") == F.col("last")).alias("open"), goes_on.alias("goes_on"))
    whole = placed.where(~F.col("open") & ~F.col("goes_on")).select("file", "at", "text")
    # at most two pieces of a block are put together with others
    pieces = placed.where(F.col("open") | F.col("goes_on")).groupBy("file", "at").agg(
        F.sort_array(F.collect_list(F.struct("block", "text"))).alias("p")
    )
    joined = pieces.select("file", "at", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    found = whole.unionByName(joined).select(
        "file",
        F.rtrim(F.col("text"), F.lit("\r")).alias("record"),
        ((F.col("at.block") == 0) & (F.col("at.record") == 1)).alias("first"),
    )
    return found.where(F.col("first") | (F.length("record") > 0))


def read_records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """A CSV file with a header line as text columns, named as in the header, in lower case."""
    reader = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
    header = reader.option("sep", separator).csv(path).columns  # opens the begin of the file only
    own = [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in own])
    options = {"escape": '"', "sep": separator, "mode": "FAILFAST"}
    rows = records(spark, path, separator).where(~F.col("first"))
    parsed = rows.select(F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    return parsed.select(*[F.col(f"r.{c}").alias(h.lower()) for c, h in zip(own, header)])
