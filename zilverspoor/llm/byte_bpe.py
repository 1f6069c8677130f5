"""Byte-level BPE by a rank queue on hierarchical bitmaps.

All pre-tokens of a batch that are not known yet lie in one array as a linked list of symbols. A
bucket for each merge rank holds list positions. Bitmaps of 64-bit words, each level summing up the
one below, say which buckets have entries: find-first-set on each level gives the next rank. All
positions of a rank are merged together; entries whose pair has changed meanwhile are stale and are
skipped. A merge costs the same in a short and in a very long pre-token, as nothing is searched.

Defined cases: NULL and empty texts give no ids; repeated rows are encoded one by one; other columns
of the input stay, and the new columns must not be among them; an empty table gives no rows. Ids
beyond the vocabulary and bytes that no token spells are errors.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.llm.common import buffers, ranges, slices
from zilverspoor.llm.memo import Encoded, Memo, lists

NO_RANK = np.int32(2**31 - 1)
BATCH_BYTES = 4 << 20
#: Ids that one decoding step looks at; a single longer list is a step of its own.
BATCH_IDS = 1 << 19


class RankQueue:
    """Buckets of positions by rank; the lowest rank that has any comes first."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.levels: list[list[int]] = []
        while not self.levels or ranks > 1:
            ranks = max(1, -(-ranks // 64))
            self.levels.append([0] * ranks)

    def push(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        at = rank
        for level in self.levels:
            word, bit = at >> 6, at & 63
            before = level[word]
            level[word] = before | 1 << bit
            if before:
                break
            at = word

    def pop(self) -> tuple[int, list[np.ndarray]] | None:
        if not self.levels[-1][0]:
            return None
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            at = at << 6 | (word & -word).bit_length() - 1
        rank = at
        for level in self.levels:
            word, bit = at >> 6, at & 63
            level[word] &= ~(1 << bit)
            if level[word]:
                break
            at = word
        return rank, self.buckets.pop(rank)

    def push_all(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        some = ranks != NO_RANK
        positions, ranks = positions[some], ranks[some]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begin = 0
        for end, rank in zip([*cuts.tolist(), len(ranks)], ranks[[0, *cuts]].tolist()):
            self.push(rank, positions[begin:end])
            begin = end


class Vocabulary:
    """Merge ranks of a rank file, which are the ids as well."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values(), default=-1) + 1
        self.size = size
        spelled: list[bytes] = [b""] * size
        self.valid = np.zeros(size, bool)
        for token, rank in ranks.items():
            spelled[rank] = token
            self.valid[rank] = True
        self.lengths = np.array([len(t) for t in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        pairs: dict[int, int] = {}
        late = set()
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
                    # a merge of this token's part would let a lower rank appear
                    late.update(p for p, s in ((left, token[:cut]), (right, token[cut:]))
                                if p > rank and len(s) > 1)
        self.late = late
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.merged = np.fromiter(pairs.values(), np.int32, len(pairs))[order]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NO_RANK, np.int32)
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.merged[at], NO_RANK)

    def merge(self, data: np.ndarray, offsets: np.ndarray) -> Encoded:
        """Ids of the stretches of ``data`` between offsets, none of them empty."""
        n = len(data)
        symbols = self.bytes[data]
        if (symbols < 0).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        following = np.arange(1, n + 1, dtype=np.int64)
        before = np.arange(-1, n - 1, dtype=np.int64)
        following[offsets[1:] - 1] = -1
        before[offsets[:-1]] = -1
        alive = np.ones(n, bool)
        rank_at = np.full(n, NO_RANK, np.int32)
        joined = np.flatnonzero(following >= 0)
        rank_at[joined] = self.pair_ranks(symbols[joined], symbols[joined + 1])
        queue = RankQueue(self.size)
        queue.push_all(joined, rank_at[joined])
        while (item := queue.pop()) is not None:
            rank, parts = item
            at = parts[0] if len(parts) == 1 else np.sort(np.concatenate(parts))
            at = at[rank_at[at] == rank]
            if len(parts) > 1 and len(at):
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            if not len(at):
                continue
            if rank in self.late and len(at) > 1:
                # lower ranks may follow from this one: one merge in each stretch at a time
                owner = np.searchsorted(offsets, at, side="right")
                first = np.concatenate([[True], owner[1:] != owner[:-1]])
                if not first.all():
                    queue.push(rank, at[~first])
                    at = at[first]
            right = following[at]
            if len(at) > 1 and (chained := right[:-1] == at[1:]).any():
                # equal pairs that overlap: every second of a run, from the left
                index = np.arange(len(at))
                heads = np.where(np.concatenate([[True], ~chained]), index, 0)
                even = (index - np.maximum.accumulate(heads)) % 2 == 0
                at, right = at[even], right[even]
            symbols[at] = rank
            alive[right] = False
            rank_at[right] = NO_RANK
            after = following[right]
            following[at] = after
            has = after >= 0
            before[after[has]] = at[has]
            rank_at[at] = NO_RANK
            left_of = before[at]
            led = left_of >= 0
            lefts = np.concatenate([at[has], left_of[led]])
            ranks = self.pair_ranks(symbols[lefts], symbols[following[lefts]])
            rank_at[lefts] = ranks
            queue.push_all(lefts, ranks)
        total = np.concatenate([[0], np.cumsum(alive)])
        return symbols[alive], np.diff(total[offsets])

    def encode(self, pieces: list[bytes]) -> Encoded:
        """Ids of pre-tokens: the whole one if it is a token, else merged by rank."""
        direct = [self.ranks.get(p, -1) for p in pieces]
        rest = [p for p, r in zip(pieces, direct) if r < 0]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in rest])]).astype(np.int64)
        merged, each = self.merge(np.frombuffer(b"".join(rest), np.uint8), offsets)
        whole = np.array(direct, np.int32)
        counts = np.ones(len(pieces), np.int64)
        counts[whole < 0] = each
        ids = np.empty(int(counts.sum()), np.int32)
        starts = np.cumsum(counts) - counts
        ids[starts[whole >= 0]] = whole[whole >= 0]
        ids[ranges(starts[whole < 0], each)] = merged
        return ids, counts


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a token in base 64 and its rank."""
    with open(path, "rb") as source:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, source) if t}


_vocabularies: dict[str, Vocabulary] = {}
_memos: dict[tuple[str, str], Memo] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(read_ranks(path))
    return _vocabularies[path]


def memo(path: str, pattern: str) -> Memo:
    if (path, pattern) not in _memos:
        vocab, split = vocabulary(path), regex.compile(pattern)

        def encode(pieces: list[str]) -> Encoded:
            tokens = [split.findall(p) for p in pieces]
            ids, counts = vocab.encode([t.encode() for p in tokens for t in p])
            ends = np.cumsum([len(p) for p in tokens])
            total = np.concatenate([[0], np.cumsum(counts)])
            return ids, np.diff(np.concatenate([[0], total[ends]]))

        _memos[path, pattern] = Memo(encode)
    return _memos[path, pattern]


_TIGHT = np.ones(256, bool)  # bytes after which, or before which, a space may be cut off
_TIGHT[:33] = False
_OPENS = np.zeros(256, bool)  # first bytes of characters that may be white space
_OPENS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def cut_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts can be cut without a change of their pre-tokens: before lone spaces.

    A single space between two characters that are no white space always begins a match of
    patterns that put a space in front of the word after it. Characters that could be white space
    beyond ASCII simply stay uncut.
    """
    spaces = np.flatnonzero(data == 32)
    spaces = spaces[(spaces > 2) & (spaces < len(data) - 1)]
    behind, ahead = data[spaces - 1], data[spaces + 1]
    odd = (behind >= 128) & (_OPENS[data[spaces - 2]] | _OPENS[data[spaces - 3]])
    spaces = spaces[_TIGHT[behind] & ~odd & _TIGHT[ahead] & ~_OPENS[ahead]]
    cut = np.zeros(len(data) + 2, bool)
    cut[offsets] = True
    spaces = spaces[~cut[spaces + 1]]
    cut[spaces] = True
    return np.flatnonzero(cut)


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids"
) -> DataFrame:
    """The frame with the ids of each text, pre-tokens being the matches of ``pattern``.

    ``pattern`` must take a space together with the word after it, as the public patterns do.
    """
    if into in df.columns:
        raise ValueError(f"there is a column {into} already")
    whole = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    schema = T.StructType([whole.schema["row"], T.StructField(into, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = memo(path, pattern)
        for batch in slices(batches, BATCH_BYTES):
            data, offsets = buffers(batch.column("text"))
            cuts = cut_points(data, offsets)
            ids, counts = words.gather(data, cuts, np.searchsorted(cuts, offsets))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), lists(ids, counts)], names=["row", into]
            )

    return whole.mapInArrow(run, schema).select("row.*", into)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The frame with the bytes that each list of ids spells, in place of the list."""
    if into in df.columns:
        raise ValueError(f"there is a column {into} already")
    others = [c for c in df.columns if c != ids]
    whole = df.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")).alias("ids"),
    )
    schema = T.StructType([whole.schema["row"], T.StructField(into, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in slices(batches, BATCH_IDS, lambda b: pc.list_value_length(b.column("ids"))):
            column = batch.column("ids")
            flat = column.flatten().to_numpy(zero_copy_only=False)
            if len(flat) and not (
                0 <= flat.min() and flat.max() < vocab.size and vocab.valid[flat].all()
            ):
                raise ValueError("an id is not in the vocabulary")
            each = vocab.lengths[flat]
            total = np.concatenate([[0], np.cumsum(each)])
            ends = column.value_lengths().to_numpy(zero_copy_only=False)
            offsets = total[np.concatenate([[0], np.cumsum(ends)])]
            spelled = vocab.spelled[ranges(vocab.starts[flat], each)]
            parts = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(spelled)]
            out = pa.Array.from_buffers(pa.large_binary(), len(column), parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), out.cast(pa.binary())], names=["row", into]
            )

    return whole.mapInArrow(run, schema).select("row.*", into)
