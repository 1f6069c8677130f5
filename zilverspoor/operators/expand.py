"""Rows that stand for several equal ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: So many copies of a row are made in one go.
BLOCK = 1 << 16
#: Up to so many copies are made where a row is.
FEW = 16


def repeat_rows(
    df: DataFrame, copies: str, block: int | None = None, most: int | None = None
) -> DataFrame:
    """Every row as often as ``copies`` says, without that column; none for zero, less or NULL.

    In two levels: a row for each block of copies first, dealt evenly over as many tasks as a
    shuffle has, then the copies in each block. So neither an array nor a task holds all copies of
    one row, and what is shuffled are blocks, not copies. Where no row has more than ``most``
    copies, and these are few, nothing needs to be dealt out.
    """
    size = F.lit(block or BLOCK).cast("long")
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    n = F.col(f"`{copies}`").cast("long")
    names = [f"c{i}" for i in range(len(df.columns) - 1)]  # of any name, so nothing clashes
    own = [c for c in df.columns if c != copies]
    rows = df.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(own, names)], n.alias("n"))
    spread = rows = rows.where("n >= 1")
    if most is None or most > FEW:
        cut = rows.withColumn(
            "block", F.explode(F.sequence(none, F.floor((F.col("n") - one) / size)))
        )
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        inside = F.least(size, F.col("n") - F.col("block") * size)
        spread = cut.select(*names, inside.alias("n")).repartition(tasks)
    each = spread.select(*names, F.explode(F.sequence(one, F.col("n"))))
    return each.select(*[F.col(a).alias(c) for c, a in zip(own, names)])
