"""Monotone sequences of numbers after Elias and Fano, for many look-ups at a time.

Each value is cut into low bits, packed next to each other, and a high part, written in unary into
a bit vector. Ranks of the bit vector are kept per 64-bit word, so that the i-th value, and the
values that share a high part, are found without reading the rest. All methods take arrays.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_ONE = _U(1)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits next to each other in 64-bit words."""
    n = len(values)
    out = np.zeros(n * width // 64 + 2, np.uint64)
    if width and n:
        at = np.arange(n, dtype=np.uint64) * _U(width)
        word, bit = (at >> _U(6)).astype(np.int64), at & _U(63)
        np.bitwise_or.at(out, word, values << bit)
        # what goes over a word's end; shifting in two steps never shifts by 64
        np.bitwise_or.at(out, word + 1, (values >> (_U(63) - bit)) >> _ONE)
    return out


# place of the n-th set bit of a byte, by byte and n
_BIT = np.full((256, 8), 8, np.uint8)
for _byte in range(256):
    for _n, _at in enumerate(i for i in range(8) if _byte >> i & 1):
        _BIT[_byte, _n] = _at
_BIT = _BIT.reshape(-1)
_ONES, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)


def _nth_set(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bit position of the n-th set bit of each word: by the bytes' counts, then inside a byte."""
    n = n.astype(np.uint64)
    sums = words - ((words >> _ONE) & _U(0x5555555555555555))
    sums = (sums & _U(0x3333333333333333)) + ((sums >> _U(2)) & _U(0x3333333333333333))
    sums = ((sums + (sums >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _ONES  # up to each byte
    passed = np.bitwise_count((((n * _ONES) | _TOPS) - sums) & _TOPS)
    at = passed.astype(np.uint64) << _U(3)
    inside = n - (((sums << _U(8)) >> at) & _U(255))
    byte = (words >> at) & _U(255)
    return (at + _BIT[(byte << _U(3)) | inside]).astype(np.int64)


class EliasFano:
    """``values`` rise or stay; all are below ``universe``."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.width = n, width
        self.low, self.high, self.ones = low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        values = values.astype(np.uint64)
        width = max(0, (universe // max(1, n)).bit_length() - 1)
        low = _packed(values & _U((1 << width) - 1), width)
        top = (values >> _U(width)).astype(np.int64)
        size = n + ((universe - 1) >> width if universe else 0) + 2
        marks = np.zeros(-(-size // 64) * 64, np.uint8)
        marks[top + np.arange(n)] = 1
        high = np.packbits(marks, bitorder="little").view("<u8").astype(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))])
        return cls(n, width, low, high, ones)

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {
            f"{name}.size": np.array([self.n, self.width], np.int64),
            f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.ones": self.ones,
        }

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, width = arrays[f"{name}.size"].tolist()
        return cls(n, width, *[arrays[f"{name}.{k}"] for k in ("low", "high", "ones")])

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * _U(self.width)
        word, bit = (at >> _U(6)).astype(np.int64), at & _U(63)
        value = (self.low[word] >> bit) | ((self.low[word + 1] << _ONE) << (_U(63) - bit))
        return value & _U((1 << self.width) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        at = word * 64 + _nth_set(self.high[word], i - self.ones[word])
        return ((at - i).astype(np.uint64) << _U(self.width)) | self.lows(i)

    def _bucket(self, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The indices of the values that have a high part, from the first to beyond the last."""
        j = np.maximum(top - 1, 0)
        word = np.searchsorted(self.zeros, j, side="right") - 1
        at = word * 64 + _nth_set(~self.high[word], j - self.zeros[word])
        begin = np.where(top > 0, at - j, 0)
        # the run of set bits that follows, word by word
        at = begin + top
        end = begin.copy()
        left = np.arange(len(top))
        while len(left):
            place = at[left]
            bit = (place & 63).astype(np.uint64)
            rest = ~(self.high[place >> 6] >> bit)
            run = np.bitwise_count((rest & -rest) - _ONE).astype(np.int64)
            room = 64 - (place & 63)
            end[left] += np.minimum(run, room)
            at[left] += room
            left = left[run >= room]
        return begin, end

    def _range(self, values: np.ndarray, first, last) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the values with the same high part begin and end, and the low parts wanted."""
        top = (values >> _U(self.width)).astype(np.int64)
        most = len(self.high) * 64 - self.n - 1
        beyond = (values >> _U(self.width)) > _U(most)
        far = beyond.any()
        begin, end = self._bucket(np.where(beyond, most, top) if far else top)
        begin, end = np.maximum(begin, first), np.minimum(end, self.n if last is None else last)
        if far:
            begin = np.where(beyond, end, begin)
        return begin, end, values & _U((1 << self.width) - 1)

    def _bisect(self, begin: np.ndarray, end: np.ndarray, want: np.ndarray) -> np.ndarray:
        """The first place from begin to end whose low part is not smaller."""
        begin, end = begin.copy(), end.copy()
        open_ = np.flatnonzero(begin < end)
        while len(open_):
            b, e = begin[open_], end[open_]
            middle = (b + e) >> 1
            less = self.lows(middle) < want[open_]
            begin[open_] = np.where(less, middle + 1, b)
            end[open_] = np.where(less, e, middle)
            open_ = open_[begin[open_] < end[open_]]
        return begin

    def successor(
        self, values: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | int | None = None
    ) -> np.ndarray:
        """Index of the first value that is not smaller, among the indices from first to last."""
        return self._bisect(*self._range(values.astype(np.uint64), first, last))

    def find(
        self, values: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | int | None = None
    ) -> np.ndarray:
        """Index of each value, or -1: its successor among the indices from first to last, where
        that has the same high and low part."""
        out = np.full(len(values), -1, np.int64)
        if not self.n:
            return out
        begin, end, want = self._range(values.astype(np.uint64), first, last)
        size = end - begin
        # most high parts belong to one value or none
        several = np.flatnonzero(size > 1)
        if len(several):
            begin[several] = self._bisect(begin[several], end[several], want[several])
        held = np.flatnonzero((size > 0) & (begin < end))
        at = begin[held]
        same = self.lows(at) == want[held]
        out[held[same]] = at[same]
        return out


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays as one block: a line that says what is where, then the arrays, eight bytes aligned."""
    import json

    head, body, at = [], [], 0
    for name, array in arrays.items():
        raw = np.ascontiguousarray(array).tobytes()
        raw += bytes(-len(raw) % 8)
        head.append([name, array.dtype.str, len(array), at])
        body.append(raw)
        at += len(raw)
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    return line + b"".join(body)


def unpack(data: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a block, as views into it."""
    import json

    end = 0
    while 10 not in (part := data[end : end + 4096]):
        end += 4096
    end += int(np.flatnonzero(part == 10)[0])
    data, out = np.asarray(data).view(np.ndarray), {}
    for name, kind, n, at in json.loads(data[:end].tobytes()):
        begin = end + 1 + at
        dtype = np.dtype(kind)
        out[name] = data[begin : begin + n * dtype.itemsize].view(dtype)
    return out
