"""Quality rules as a bitmask ledger. DataFrame functions only.

Every rule is evaluated once a text. What was measured and one bit for each failed rule are kept, so
a policy (a set of rules under a version) is a mask on stored bits: a new policy, or the question
what a rule costs, never reads a text again.

Defined cases: NULL and empty texts have no words and fail the base rules; repeated rows are judged
one by one; an empty table gives an empty ledger with the same columns; other columns, also ones
named like a measurement, don't matter to :func:`ledger` and pass through :func:`keep_clean`.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zilverspoor.llm.common import fresh, settled

SPACE = r"[\x20\x09-\x0D]+"
#: Word positions take this many bits next to a shortened hash; longer texts take the exact way only.
POSITION_BITS = 20


@dataclass(frozen=True)
class Rule:
    """A rule's bit and the condition on measurements under which a text fails it."""

    bit: int
    name: str
    fails: str


#: Bits are never used again for another rule: stored ledgers stay readable.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
)
#: Version of a policy: the rules that reject a text. On labelled texts the ablation shows repeated
#: lines to reject none but good texts once the other rules hold, so only "strict" has that rule.
POLICIES: Mapping[str, int] = {
    "base": 0b000011,
    "standard": 0b110111,
    "strict": 0b111111,
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _measured(df: DataFrame, key: Column, text: Column) -> DataFrame:
    text = F.coalesce(text, F.lit(""))
    first = df.select(
        key.alias("key"),
        text.alias("text"),
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "").alias(
            "lines"
        ),
    )
    counted = first.select(
        "key",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    return _repeats(counted)


def _repeats(df: DataFrame) -> DataFrame:
    """Words in three-word windows that a text holds twice or more.

    Windows are found by sorting longs of a shortened hash and the position, which Spark sorts as
    plain numbers; the few windows whose neighbour has the same short hash are compared by their
    words then.
    """
    low = (1 << POSITION_BITS) - 1
    at = lambda i: F.get("words", i)
    places = F.when(
        F.col("n_words") >= 3, F.sequence(F.lit(0), F.col("n_words").cast("int") - 3)
    ).otherwise(F.array().cast("array<int>"))
    packed = F.sort_array(
        F.transform(
            places,
            lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2))
            .bitwiseAND(F.lit(~low))
            .bitwiseOR(i.cast("long")),
        )
    )
    near = lambda x, y: F.coalesce(
        F.shiftright(x, POSITION_BITS) == F.shiftright(y, POSITION_BITS), F.lit(False)
    )
    df = df.select("*", F.when(F.col("n_words") < low, packed).alias("packed"), places.alias("all"))
    suspects = F.when(
        F.col("n_words") < low,
        F.transform(
            F.filter(
                "packed",
                lambda x, i: near(x, F.get("packed", i - 1)) | near(x, F.get("packed", i + 1)),
            ),
            lambda x: x.bitwiseAND(F.lit(low)).cast("int"),
        ),
    ).otherwise(F.col("all"))
    df = df.withColumn("suspects", suspects).drop("packed", "all")
    exact = F.sort_array(
        F.transform(
            "suspects", lambda i: F.struct(F.slice("words", i + 1, 3).alias("w"), i.alias("p"))
        )
    )
    df = df.withColumn("exact", F.when(F.size("suspects") > 0, exact)).drop("suspects", "words")
    same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
    found = F.sort_array(
        F.transform(
            F.filter(
                "exact", lambda x, i: same(x, F.get("exact", i - 1)) | same(x, F.get("exact", i + 1))
            ),
            lambda x: x["p"],
        )
    )
    covered = F.aggregate(
        found,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct(
            (a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n"), (p + 3).alias("end")
        ),
    )["n"]
    repeat = F.coalesce(F.when(F.col("exact").isNotNull(), covered), F.lit(0)).cast("long")
    return df.withColumn("n_repeat_words", repeat).drop("exact")


def failures(rules=RULES) -> Column:
    """One bit for each rule that a text fails, from its measurements."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in rules]
    out = F.lit(0).cast("long")
    for bit in bits:
        out = out.bitwiseOR(bit.cast("long"))
    return out


def ledger(df: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """Key, measurements and the failure bits of every text, each rule evaluated once."""
    measured = _measured(df, F.col(f"`{key}`"), F.col(f"`{text}`"))
    # one settled struct: a condition on any of its fields stays above all of it
    judged = measured.select(
        "key", settled(F.struct(*MEASURES, failures(rules).alias("failures"))).alias("line")
    )
    return judged.select(F.col("key").alias(key), *[f"line.{c}" for c in (*MEASURES, "failures")])


def verdict(policy: str, policies: Mapping[str, int] = POLICIES) -> Column:
    """Whether a policy keeps a text, from its stored bits."""
    return F.col("failures").bitwiseAND(F.lit(policies[policy]).cast("long")) == 0


def ablations(book: DataFrame, policies: Mapping[str, int] = POLICIES, rules=RULES) -> DataFrame:
    """For each policy and rule: texts kept, and kept if the policy lacked that rule.

    Texts are counted by failure pattern first, so at most two to the number of rules rows follow.
    """
    patterns = book.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        F.struct(F.lit(v).alias("policy"), F.lit(r.name).alias("rule"),
                 F.lit(m).cast("long").alias("mask"), F.lit(m & ~(1 << r.bit)).cast("long").alias("less"))
        for v, m in policies.items() for r in rules if m >> r.bit & 1
    ]
    each = patterns.select("*", F.explode(F.array(*cases)).alias("c")).select("*", "c.*")
    passing = lambda mask: F.sum(
        F.when(F.col("failures").bitwiseAND(F.col(mask)) == 0, F.col("n")).otherwise(F.lit(0))
    )
    return each.groupBy("policy", "rule").agg(
        passing("mask").alias("kept"), passing("less").alias("kept_without")
    )


def keep_clean(df: DataFrame, policy: str = "standard", text: str = "text") -> DataFrame:
    """The rows that a policy keeps, with the columns they came with."""
    name = fresh(df, "row_")
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
    measured = _measured(whole, F.col(name), F.col(f"{name}.`{text}`"))
    held = measured.withColumn("failures", settled(failures())).filter(verdict(policy))
    return held.select([F.col("key").getField(c).alias(c) for c in df.columns])
