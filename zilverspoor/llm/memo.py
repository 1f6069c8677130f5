"""Encode every different piece of text once in a worker and gather the ids of whole texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from zilverspoor.llm.common import ranges, strings

#: Pieces that a worker remembers; further ones are encoded again in each batch that has them.
REMEMBERED = 250_000

Encoded = tuple[np.ndarray, np.ndarray]  # all ids, and how many each piece has


class Memo:
    """Ids of pieces by their text; ``encode`` gets a list of pieces it has not seen."""

    def __init__(self, encode: Callable[[list[str]], Encoded], limit: int = REMEMBERED):
        self.encode, self.limit = encode, limit
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.counts = np.empty(0, np.int64)

    def look_up(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids; where the ids of each piece begin in it; how many they are."""
        get = self.known.get
        places = np.fromiter((get(p, -1) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(places < 0)
        ids, counts = self.ids, self.counts
        if len(new):
            missing = [pieces[i] for i in new]
            more, each = self.encode(missing)
            places[new] = len(counts) + np.arange(len(new))
            ids, counts = np.concatenate([ids, more]), np.concatenate([counts, each])
            room = self.limit - len(self.known)
            if room > 0:
                held = missing[:room]
                self.known.update(zip(held, range(len(self.counts), len(self.counts) + len(held))))
                self.counts = counts[: len(self.counts) + len(held)]
                self.ids = ids[: int(self.counts.sum())]
        starts = np.cumsum(counts) - counts
        return ids, starts[places], counts[places]

    def gather(self, data: np.ndarray, cuts: np.ndarray, offsets: np.ndarray) -> Encoded:
        """Ids of texts whose pieces are cut at ``cuts``; ``offsets`` counts pieces before a text."""
        coded = strings(data, cuts).dictionary_encode()
        ids, starts, counts = self.look_up(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy()
        each = counts[codes]
        total = np.concatenate([[0], np.cumsum(each)])
        return ids[ranges(starts[codes], each)], np.diff(total[offsets])


def lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One list of ids a text."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32, copy=False)))
