"""Reply-ordered conversations from messages that quote each other.

A line that begins with ``>`` is quoted, each further ``>`` is one level deeper, and lines of one
level that follow each other are a passage. Passages and their lines are hashed in a normal form
(lower case, no markers, white space as one blank) and joined to the paragraphs and lines that
messages of the same conversation wrote themselves. A message answers the earlier one that wrote
most of what it quotes on the first level; ties go to the latest of these. Without such a quote it
answers the message with the turn before its own. Quotes, and the line that announces one, are taken
out of the text.

Threads follow by pointer doubling: a message points to what it answers, then to what that points
to, until all point to the first message. No conversation is ever gathered in one task.

Defined cases: NULL texts stay NULL, quote nothing and write nothing; a message that only quotes
becomes empty; messages with the same conversation and turn each get their rows, and others link to
their common turn; NULL conversations or turns link to nothing; these are whole numbers, and a text
that is none is an error; a quote of text that nobody wrote earlier links to nothing; an empty table
gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.llm.common import kept

MARKERS = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
#: Lines that announce a quote, if one follows (fixed forms of common mail programs).
ANNOUNCES = re.compile(r"^.{0,200}\b(?:wrote|schrieb|a écrit|escribió)\b.{0,80}:\s*$", re.IGNORECASE)
SPACES = re.compile(r"\s+")


def normal(text: str) -> str:
    return SPACES.sub(" ", text).strip().lower()


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def parse(text: str | None) -> tuple[str | None, list[dict], list[dict]]:
    """The text without quotes; what it quotes (level, hash, characters); what it writes (hash)."""
    if text is None:
        return None, [], []
    lines = text.split("\n")
    levels, contents = [], []
    for line in lines:
        marks = MARKERS.match(line)
        levels.append(marks[1].count(">") if marks else 0)
        contents.append(line[marks.end() :] if marks else line)
    own, quoted, i = [], [], 0
    while i < len(lines):
        stop = i
        while stop < len(lines) and levels[stop] == levels[i]:
            stop += 1
        if levels[i]:
            part = [n for n in map(normal, contents[i:stop]) if n]
            units = dict.fromkeys([" ".join(part), *part])
            quoted += [{"level": levels[i], "hash": digest(u), "n": len(u)} for u in units if u]
        else:
            block = lines[i:stop]
            last = max((k for k, x in enumerate(block) if x.strip()), default=-1)
            if stop < len(lines) and last >= 0 and ANNOUNCES.match(block[last]):
                block = block[:last]
            own += block
        i = stop
    body = "\n".join(own).strip("\n") if any(levels) else text
    written = {normal(x) for x in own} | {normal(p) for p in re.split(r"\n[ \t]*\n", body)}
    written.add(normal(body))
    return body, quoted, [{"hash": digest(u)} for u in sorted(written - {""})]


_QUOTED = T.ArrayType(
    T.StructType(
        [
            T.StructField("level", T.IntegerType()),
            T.StructField("hash", T.LongType()),
            T.StructField("n", T.LongType()),
        ]
    )
)
_WRITTEN = T.ArrayType(T.StructType([T.StructField("hash", T.LongType())]))


def parsed(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    rows = df.select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.col(f"`{role}`").cast("string").alias("role"),
        F.col(f"`{text}`").alias("text"),
    )
    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField("quoted", _QUOTED),
            T.StructField("written", _WRITTEN),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                found = [parse(t) for t in part.column("text").to_pylist()]
                body, quoted, written = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in ("conv", "turn", "role")],
                        pa.array(body, pa.string()),
                        pa.array(quoted, pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("n", pa.int64())]))),
                        pa.array(written, pa.list_(pa.struct([("hash", pa.int64())]))),
                    ],
                    names=["conv", "turn", "role", "text", "quoted", "written"],
                )

    return rows.mapInArrow(run, schema)


def links(messages: DataFrame) -> DataFrame:
    """Quoting turn, quoted turn, level and matched characters, one row for each of these pairs.

    ``messages`` is what :func:`parsed` gives. A text that several turns wrote counts for the first
    of them, so one row of the right side meets each quote.
    """
    quotes = messages.select("conv", "turn", F.explode("quoted").alias("q")).select(
        "conv", "turn", "q.*"
    )
    quotes = quotes.distinct()
    wanted = quotes.select("conv", "hash").distinct()
    written = messages.select("conv", "turn", F.explode("written.hash").alias("hash"))
    first = (
        written.join(wanted, ["conv", "hash"], "left_semi")
        .groupBy("conv", "hash")
        .agg(F.min("turn").alias("origin"))
    )
    return (
        quotes.join(first, ["conv", "hash"])
        .filter("origin < turn")
        .groupBy("conv", "turn", "origin", "level")
        .agg(F.sum("n").alias("matched"))
    )


def threads(answers: DataFrame) -> DataFrame:
    """First turn and depth for each (conv, turn) that points to what it answers, or to nothing.

    Only messages that do not point to a first one yet take part in a step, so a few long
    conversations cost what they have themselves.
    """
    state = kept(
        answers.select(
            "conv", "turn", F.coalesce("reply_to", "turn").alias("to"),
            F.when(F.col("reply_to").isNull(), 0).otherwise(1).cast("long").alias("depth"),
            F.col("reply_to").isNotNull().alias("open"),
        ), "threads",
    )
    while state.filter("open").limit(1).count():
        there = state.select(
            "conv", F.col("turn").alias("to"), F.col("to").alias("next"),
            F.col("depth").alias("more"), F.col("open").alias("still"),
        )
        moved = state.filter("open").join(there, ["conv", "to"]).select(
            "conv", "turn", F.col("next").alias("to"),
            (F.col("depth") + F.col("more")).alias("depth"), F.col("still").alias("open"),
        )
        state = kept(state.filter(~F.col("open")).unionByName(moved), "threads")
    return state.select("conv", "turn", F.col("to").alias("thread"), "depth")


def conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Messages without quotes: conversation, thread (its first turn), depth, turn, role, text, the
    turn answered, and the quoted characters on the first level that were found. Ordered by
    (conversation, thread, depth, turn), every message follows the one it answers."""
    messages = kept(parsed(df, conv, turn, role, text), "messages")
    places = messages.select("conv", "turn").filter("conv IS NOT NULL AND turn IS NOT NULL").distinct()
    direct = links(messages.filter("conv IS NOT NULL AND turn IS NOT NULL")).filter("level = 1")
    best = direct.groupBy("conv", "turn").agg(
        F.max(F.struct("matched", "origin")).alias("best")
    )
    previous = places.select("conv", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("previous"))
    answers = (
        places.join(best, ["conv", "turn"], "left")
        .join(previous, ["conv", "turn"], "left")
        .select(
            "conv", "turn", F.coalesce("best.origin", "previous").alias("reply_to"),
            F.coalesce("best.matched", F.lit(0)).cast("long").alias("matched"),
        )
    )
    answers = kept(answers, "answers")
    found = answers.join(threads(answers), ["conv", "turn"])
    return messages.join(found, ["conv", "turn"], "left").select(
        F.col("conv").alias(conv), "thread", "depth", F.col("turn").alias(turn),
        F.col("role").alias(role), F.col("text").alias(text), "reply_to",
        F.coalesce("matched", F.lit(0).cast("long")).alias("matched"),
    )
