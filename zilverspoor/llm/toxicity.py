"""Toxicity by a weighted finite-state grammar over clauses.

Words are mapped to classes (insult, threat, target, negation, reporting). Five small transducers
read the classes of a clause: one remembers insults, one threats, one whether somebody is
addressed, one how far a negation reaches, one whether speech is reported. :func:`compose` builds
their product as one table of states; running it over a clause ends in a state whose output is the
clause's category, and the weights of the clause's insults and threats count in that category. A
document's score is a logistic function of the weights it has in each category.

Insults are learned: stems whose document frequency in toxic training texts is much above that in
clean ones, weighted by log odds. The fixed word lists hold function words and a few threats only.
Fitting reads a sample of about ``FIT_ROWS`` labelled rows, everything of each text; scoring reads
all texts.

Defined cases: NULL and empty texts and texts without a matched clause get the score of no evidence;
a NULL key is in neither part of a split (:func:`held_out` gives NULL) and has no labels;
NULL labels don't count, and a document with several labels takes the highest; without labels the
model has no insults and fixed coefficients; repeated rows are scored one by one; an empty table
gives no rows; other columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zilverspoor.llm.common import (
    ALNUM,
    LOWER,
    buffers,
    kept,
    ranges,
    slices,
    strings,
    texts,
    word_spans,
)

#: Labelled rows that the model is fitted on, about.
FIT_ROWS = 20_000
#: Stems in a model, characters of a stem, and least share and number of toxic texts that have it.
STEMS, SHORTEST, LONGEST, LEAST_SHARE, LEAST_TEXTS = 400, 3, 10, 0.04, 4
#: Least log odds of a stem.
LEAST_ODDS = 3.0
THRESHOLD = 0.3

# Fixed word lists, in the languages of the corpus
THREATS = "kill hurt destroy murder punish töten vernichten tuer matar".split()
TARGETS = "you your yours u du dich dir euch tu toi vous usted ustedes vosotros".split()
NEGATIONS = "not never no nobody none neither nor nicht kein keine jamais nunca".split()
REPORTS = "said says told reported claims quoted wrote sagte schrieb dijo".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Words that a negation reaches.
REACH = 3


@dataclass(frozen=True)
class Transducer:
    """States from 0 on; arcs by (state, class), others stay; a step per word; a final output."""

    name: str
    arcs: dict[tuple[int, int], int]
    size: int
    decay: dict[int, int] = field(default_factory=dict)  # where a state goes with any other word

    def step(self, state: int, symbol: int) -> int:
        return self.arcs.get((state, symbol), self.decay.get(state, state))


def flag(name: str, symbol: int) -> Transducer:
    return Transducer(name, {(0, symbol): 1}, 2)


NEGATED = Transducer(
    "negation",
    {(s, NEGATION): REACH for s in range(REACH + 1)},
    REACH + 1,
    {s: s - 1 for s in range(1, REACH + 1)},
)
PARTS = (
    flag("target", TARGET),
    flag("reported", REPORT),
    NEGATED,
    flag("insult", INSULT),
    flag("threat", THREAT),
)


class Grammar:
    """The product of transducers: next states by state and class, and outputs of final states."""

    def __init__(self, parts: tuple[Transducer, ...] = PARTS):
        self.parts = parts
        states = list(product(*[range(p.size) for p in parts]))
        number = {s: i for i, s in enumerate(states)}
        self.table = np.array(
            [[number[tuple(p.step(x, c) for p, x in zip(parts, s))] for c in range(6)] for s in states]
        )
        at = {p.name: i for i, p in enumerate(parts)}
        self.negated = np.array([s[at["negation"]] > 0 for s in states])
        self.targeted = np.array([s[at["target"]] for s in states])
        self.reported = np.array([s[at["reported"]] for s in states])
        self.matches = np.array([s[at["insult"]] | s[at["threat"]] for s in states], bool)

    def clause(self, classes: list[int], gaps: list[int], weights: list[float]) -> Counter:
        """Weights of a clause by category; ``gaps`` counts the other words before each word."""
        table, state, found = self.table, 0, []
        for symbol, gap, weight in zip(classes, gaps, weights):
            for _ in range(min(gap, REACH)):
                state = table[state][OTHER]
            if symbol in (INSULT, THREAT):
                found.append((symbol, bool(self.negated[state]), weight))
            state = table[state][symbol]
        out: Counter = Counter()
        if self.matches[state]:
            for symbol, negated, weight in found:
                out[category(symbol, self.targeted[state], negated, self.reported[state])] += weight
        return out


def category(symbol: int, targeted: int, negated: bool, reported: int) -> int:
    return (symbol == THREAT) * 8 + int(targeted) * 4 + int(negated) * 2 + int(reported)


CATEGORIES = 16


def compose(parts: tuple[Transducer, ...] = PARTS) -> Grammar:
    return Grammar(parts)


@dataclass
class Model:
    """Stems with their weights, and the coefficients of categories, the constant last."""

    stems: dict[str, float]
    coefficients: list[float]

    def __post_init__(self):
        self.lengths = sorted({len(s) for s in self.stems})
        fixed = ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT))
        self.fixed = {w: c for words, c in fixed for w in words}
        self.known: dict[str, tuple[int, float]] = {}

    def classify(self, word: str) -> tuple[int, float]:
        for n in self.lengths:
            weight = self.stems.get(word[:n])
            if weight is not None and len(word) >= n:
                return INSULT, weight
        return self.fixed.get(word, OTHER), 1.0

    def classes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known = self.known
        out = []
        for word in words:
            found = known.get(word)
            if found is None:
                found = self.classify(word)
                if len(known) < 300_000:
                    known[word] = found
            out.append(found)
        kinds, weights = zip(*out) if out else ((), ())
        return np.array(kinds, np.int8), np.array(weights, np.float64)


_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?;:\n"]] = True


def _words(column: pa.Array):
    """Word spans of texts, codes of their lower-case forms and these forms."""
    data, offsets = buffers(column)
    begins, ends, before = word_spans(data, offsets, ALNUM)
    low = LOWER[data]
    sizes = ends - begins
    joined = low[ranges(begins, sizes)]
    coded = strings(joined, np.concatenate([[0], np.cumsum(sizes)])).dictionary_encode()
    return data, begins, before, coded.indices.to_numpy(), coded.dictionary.to_pylist()


def features(column: pa.Array, model: Model, grammar: Grammar) -> np.ndarray:
    """Weights by category for each text."""
    data, begins, before, codes, forms = _words(column)
    kinds, weights = model.classes(forms)
    out = np.zeros((len(column), CATEGORIES))
    if not len(codes):
        return out
    kind = kinds[codes]
    clause = np.cumsum(_ENDS[data])[begins] + np.repeat(
        np.arange(len(column)), np.diff(before)
    )  # a text begins a clause
    live = np.isin(kind, (INSULT, THREAT))
    chosen = np.flatnonzero((kind != OTHER) & np.isin(clause, clause[live]))
    if not len(chosen):
        return out
    clauses = clause[chosen]
    text = np.searchsorted(before, chosen, side="right") - 1
    cuts = np.flatnonzero(np.diff(clauses)) + 1
    gaps = np.diff(chosen, prepend=chosen[0]) - 1
    gaps = np.maximum(gaps, 0)
    symbols, each = kind[chosen].tolist(), weights[codes[chosen]].tolist()
    gaps = gaps.tolist()
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(chosen)]):
        row = out[text[first]]
        for c, w in grammar.clause(
            symbols[first:last], [0, *gaps[first + 1 : last]], each[first:last]
        ).items():
            row[c] += w
    return out


def scores(found: np.ndarray, model: Model) -> np.ndarray:
    w = np.array(model.coefficients)
    return 1 / (1 + np.exp(-np.clip(np.log1p(found) @ w[:-1] + w[-1], -30, 30)))


# Learning


def held_out(key: Column, parts: int, part: int) -> Column:
    """Rows whose crc32 of the key as text leaves that remainder."""
    return F.crc32(key.cast("string").cast("binary")) % parts == part


def labelled(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int
) -> DataFrame:
    """Texts of about ``rows`` labelled documents, chosen by the hash of their key."""
    marks = (
        labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"))
        .filter("label IS NOT NULL AND key IS NOT NULL")
        .groupBy("key")
        .agg(F.max("label").cast("int").alias("label"))
    )
    total = marks.count()
    if total > rows:
        limit = int((1 << 40) * rows / total)
        marks = marks.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 40)) < limit)
    # about ``rows`` rows of two numbers: small by the parameter, whatever the corpus
    return kept(texts(docs, key, text).join(F.broadcast(marks), "key"), "toxicity-sample")


def learn_stems(sample: DataFrame) -> dict[str, float]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            toxic, clean = Counter(), Counter()
            _, _, before, codes, forms = _words(batch.column("text"))
            marks = batch.column("label").to_pylist()
            for label, first, last in zip(marks, before[:-1], before[1:]):
                words = [forms[c] for c in set(codes[first:last].tolist())]
                stems = {w[:n] for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}
                (toxic if label else clean).update(stems)
            seen = sorted(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.string()), pa.array([toxic[s] for s in seen], pa.int64()),
                 pa.array([clean[s] for s in seen], pa.int64())],
                names=["stem", "toxic", "clean"],
            )

    of = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_toxic, n_clean = of.get(1, 0), of.get(0, 0)
    least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * n_toxic))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log(
        (F.col("clean") + 0.5) / (n_clean + 1)
    )
    ranked = (
        sample.select("text", "label")
        .mapInArrow(count, "stem string, toxic long, clean long")
        .groupBy("stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= least)
        .withColumn("odds", odds)
        .filter(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc(F.col("toxic") * F.col("odds")), F.length("stem"), "stem")
        .limit(STEMS * LONGEST)
        .collect()
    )
    held: dict[str, float] = {}
    for row in ranked:
        stem = row["stem"]
        if len(held) < STEMS and not any(stem.startswith(h) or h.startswith(stem) for h in held):
            held[stem] = float(row["odds"])
    return held


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = FIT_ROWS,
) -> Model:
    """Stems and coefficients from labelled rows. Leave rows that must not be learned out of
    ``labels``."""
    sample = labelled(docs, labels, key, text, label, rows)
    model = Model(learn_stems(sample), [1.0] * CATEGORIES + [-3.0])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = compose()
        for batch in slices(batches):
            found = features(batch.column("text"), model, grammar)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.list_(pa.float64())), batch.column("label")],
                names=["x", "y"],
            )

    rows = sample.select("text", "label").mapInArrow(measure, "x array<double>, y int").collect()
    y = np.array([r["y"] for r in rows], float)
    if len(set(y)) < 2:
        return model
    x = np.hstack([np.log1p(np.array([r["x"] for r in rows])), np.ones((len(y), 1))])
    w, ridge = np.zeros(x.shape[1]), np.diag([0.05] * CATEGORIES + [1e-6])
    for _ in range(25):  # Newton steps of a logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(w)), slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    # more evidence never lowers a score
    return Model(model.stems, [max(0.0, float(c)) for c in w[:-1]] + [float(w[-1])])


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, score, matched weight and the number of matched categories of every text."""
    held = docs.sparkSession.sparkContext.broadcast((model.stems, model.coefficients))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, grammar = Model(*held.value), compose()
        for batch in slices(batches):
            found = features(batch.column("text"), own, grammar)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(scores(found, own)), pa.array(found.sum(axis=1)),
                 pa.array((found > 0).sum(axis=1).astype(np.int32))],
                names=["key", "score", "weight", "categories"],
            )

    source = texts(docs, key, text)
    kind = source.schema["key"].dataType.simpleString()
    out = source.mapInArrow(run, f"key {kind}, score double, weight double, categories int")
    return out.withColumnRenamed("key", key)
