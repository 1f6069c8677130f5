"""How filters interact: what each removes, in every order they could be applied in.

Every text is judged once by all filters. What is counted is a failure mask for each part of the
corpus, so the audit's size depends on the number of filters alone. A part's masks become a decision
diagram: a level for each filter, a branch for passing and one for failing it, equal branches shared,
and on every node the counts of all documents below it. The path that passes everything tells what
the order of the levels removes step by step. Swapping two adjacent levels touches only the nodes of
these two and gives the diagram of another order; a walk of such swaps meets every order once.

Defined cases: NULL texts count as empty, a NULL part as the empty string; an empty text fails the
least number of words only; equal texts under one id don't repeat each other; a NULL id is neither
smaller nor larger than another one and has no label; several labels of an id are united; repeated
rows count one by one; an empty table has no parts and gives no rows; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.llm.common import kept

SPACE = r"[\x20\x09-\x0D]+"
#: Name and failure condition on what :func:`measured` gives, or on ``repeats``, in this order of bits.
FILTERS: Mapping[str, str] = {
    "A": "n_words < 100",
    "B": "100 * n_distinct < 80 * n_words",
    "C": "100 * n_capitals > 10 * n_chars",
    "D": "has_symbol",
    "E": "repeats",
}
#: An audit has this many filters at most: it has a row for every step of every order.
MOST = 8

Counts = tuple[int, ...]


class Diagram:
    """Counts by failure mask, as a decision diagram whose levels can be swapped.

    Node 0 stands for branches without documents, on every level. Below the last level are leaves,
    one for each different tuple of counts.
    """

    def __init__(self, counts: Mapping[int, Counts], filters: int, width: int):
        self.order = list(range(filters))
        self.weights: list[Counts] = [(0,) * width]
        self.levels: list[dict[int, tuple[int, int]]] = [{} for _ in range(filters)]
        self._leaves: dict[Counts, int] = {self.weights[0]: 0}
        tables: list[dict[tuple[int, int], int]] = [{} for _ in range(filters)]
        self.root = self._build(0, dict(counts), tables)

    def _build(self, level: int, counts: dict[int, Counts], tables: list[dict]) -> int:
        if not counts:
            return 0
        if level == len(self.order):
            return self._leaf(*counts.values())
        halves = ({}, {})
        for mask, count in counts.items():
            halves[mask >> self.order[level] & 1][mask] = count
        passing, failing = (self._build(level + 1, half, tables) for half in halves)
        return self._node(level, tables[level], passing, failing)

    def _leaf(self, counts: Counts) -> int:
        if counts not in self._leaves:
            self._leaves[counts] = len(self.weights)
            self.weights.append(counts)
        return self._leaves[counts]

    def _node(self, level: int, table: dict[tuple[int, int], int], passing: int, failing: int) -> int:
        if not passing and not failing:
            return 0
        found = table.get((passing, failing))
        if found is None:
            found = table[passing, failing] = len(self.weights)
            below = zip(self.weights[passing], self.weights[failing])
            self.weights.append(tuple(a + b for a, b in below))
            self.levels[level][found] = (passing, failing)
        return found

    def swap(self, level: int) -> None:
        """Exchange a level with the one below it; every upper node keeps its number and counts."""
        below, self.levels[level + 1] = self.levels[level + 1], {}
        table: dict[tuple[int, int], int] = {}
        for node, (passing, failing) in self.levels[level].items():
            both, second = below.get(passing, (0, 0))
            first, none = below.get(failing, (0, 0))
            self.levels[level][node] = (
                self._node(level + 1, table, both, first),
                self._node(level + 1, table, second, none),
            )
        self.order[level : level + 2] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """Along the path that passes all: the filter, the counts it removes, and those it leaves."""
        node = self.root
        for level, filter_ in enumerate(self.order):
            node, failing = self.levels[level].get(node, (0, 0))
            yield filter_, self.weights[failing], self.weights[node]


def swaps(filters: int) -> Iterator[int]:
    """Levels to swap one after another so that every order of the filters comes up once."""
    if filters < 2:
        return
    down = True
    for other in [*swaps(filters - 1), None]:
        yield from range(filters - 2, -1, -1) if down else range(filters - 1)
        if other is not None:  # the filter that walks stands above all others now, or below them
            yield other + down
        down = not down


def orders(counts: Mapping[int, Counts], names: Sequence[str], width: int) -> list[tuple]:
    """For every order and step: order, step, filter, kept, removed, redundant, unique, the further
    counts of what was removed, and what the filter removes in all orders together."""
    diagram = Diagram(counts, len(names), width)
    paths = []
    for level in [None, *swaps(len(names))]:
        if level is not None:
            diagram.swap(level)
        paths.append(list(diagram.steps()))
    fails, alone, total = ([0] * len(names) for _ in range(3))
    for path in paths:
        fails[path[0][0]] = path[0][1][0]  # above all others, a filter removes whatever fails it
        alone[path[-1][0]] = path[-1][1][0]  # below them, what fails nothing else
        for filter_, removed, _ in path:
            total[filter_] += removed[0]
    return [
        ("".join(names[f] for f, _, _ in path), step, names[f], left[0], gone[0],
         fails[f] - gone[0], alone[f], *gone[1:], total[f])
        for path in paths
        for step, (f, gone, left) in enumerate(path, 1)
    ]


def measured(df: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """What the filters look at: ``key``, ``part``, word and character counts, and the text's digest."""
    whole = df.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    cut = whole.select("*", F.array_remove(F.split("text", SPACE), "").alias("words"))
    return cut.select(
        "key",
        "part",
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.length("text").cast("long").alias("n_chars"),
        F.col("text").rlike(r"[#$%&*|]").alias("has_symbol"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )


def with_repeats(rows: DataFrame) -> DataFrame:
    """``repeats``: whether a row of smaller key has the same digest, anywhere in the table.

    The least key of a digest is found by partial minima; only digests that occur twice or more are
    written and joined back, so Spark can split that join where one of them has very many rows.
    """
    first = rows.groupBy("digest").agg(
        F.min("key").alias("first"), F.count(F.lit(1)).alias("copies")
    )
    first = kept(first.filter("copies > 1").select("digest", "first"), "filter-audit-copies")
    return rows.join(first, "digest", "left").withColumn(
        "repeats", F.coalesce(F.col("key") > F.col("first"), F.lit(False))
    )


def failure_mask(filters: Mapping[str, str] = FILTERS) -> Column:
    """One bit for each filter that a row fails."""
    mask = F.lit(0)
    for bit, condition in enumerate(filters.values()):
        mask = mask + F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0))
    return mask


def labelled(labels: DataFrame, key: str, flags: Mapping[str, str]) -> DataFrame:
    """One row for each key: whether any of its labels meets each condition."""
    sums = [F.max(F.expr(c).cast("int")).alias(name) for name, c in flags.items()]
    found = labels.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("key"))
    return found.agg(*sums)


def mask_counts(rows: DataFrame, flags: Sequence[str], filters: Mapping[str, str] = FILTERS) -> DataFrame:
    """Documents, and documents with each flag, by part and failure mask."""
    marked = rows.select("part", failure_mask(filters).alias("mask"), *flags)
    sums = [F.sum(F.coalesce(F.col(f), F.lit(0))).cast("long").alias(f) for f in flags]
    return marked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *sums)


def audit(counts: DataFrame, names: Sequence[str], flags: Sequence[str] = ()) -> DataFrame:
    """Every step of every order for each part, from counts by ``part`` and ``mask``.

    A part has one row for each mask at most, so each group is small whatever the corpus holds.
    """
    if len(names) > MOST:
        raise ValueError(f"{len(names)} filters; at most {MOST} can be put into every order")
    names, flags = list(names), list(flags)
    lost = [f"{f}_lost" for f in flags]
    numbers = ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"]
    schema = T.StructType(
        [T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
         T.StructField("step", T.IntegerType()), T.StructField("filter", T.StringType())]
        + [T.StructField(n, T.LongType()) for n in numbers]
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        by_mask = {
            int(row[0]): tuple(int(x) for x in row[1:])
            for row in group[["mask", "n", *flags]].itertuples(index=False)
        }
        rows = orders(by_mask, names, 1 + len(flags))
        return pd.DataFrame([(group["part"].iloc[0], *r) for r in rows], columns=schema.names)

    return counts.groupBy("part").applyInPandas(run, schema)


def interactions(
    docs: DataFrame,
    labels: DataFrame,
    flags: Mapping[str, str],
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """The audit of :data:`FILTERS` on documents, with what they lose of each kind of label.

    Texts are read once: what was measured is written, a few numbers and a digest a document.
    """
    rows = with_repeats(kept(measured(docs, key, text, part), "filter-audit"))
    rows = rows.join(labelled(labels, key, flags), "key", "left")
    return audit(mask_counts(rows, list(flags)), list(FILTERS), list(flags))
