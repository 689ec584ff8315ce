"""Ids of repeated text units, kept per Python worker.

Tokenizers here never join text across white space, so the ids of a text are
the ids of its units (words, with or without the white space before them) one
after the other.  A worker encodes each distinct unit once and gathers the
rest; when the cache is full it starts again, which costs time only.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .words import hash_spans

#: Units a worker remembers before it starts again.
CACHE_UNITS = 1_000_000
#: Units that are encoded at once.
BLOCK_UNITS = 1 << 14


class UnitCache:
    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], limit: int = CACHE_UNITS):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # the hashes of the units held, in order
        self.number = np.zeros(0, np.int32)  # and the unit of each
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int32)
        self.units = self.used = 0

    def _add(self, units: list[bytes]) -> None:
        found = self.encode(units)
        sizes = np.array([len(ids) for ids in found], np.int64)
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
        n, m = self.units, len(units)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + m > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.ids[self.used:self.used + len(flat)] = flat
        self.size[n:n + m] = sizes
        self.first[n:n + m] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        self.units += m

    def index(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The cache index of each unit; valid until the next call."""
        if not len(start):
            return np.zeros(0, np.int64)
        uniq, one, back = np.unique(hash_spans(data, start, end), return_index=True, return_inverse=True)
        if self.units + len(uniq) > self.limit:
            self.clear()
        spot = np.searchsorted(self.keys, uniq)
        held = spot < len(self.keys)
        held[held] = self.keys[spot[held]] == uniq[held]
        at = np.empty(len(uniq), np.int64)
        at[held] = self.number[spot[held]]
        new = np.flatnonzero(~held)
        if len(new):
            at[new] = np.arange(self.units, self.units + len(new))
            for a in range(0, len(new), BLOCK_UNITS):
                self._add([data[start[i]:end[i]].tobytes() for i in one[new[a:a + BLOCK_UNITS]]])
            self.keys = np.insert(self.keys, spot[new], uniq[new])
            self.number = np.insert(self.number, spot[new], at[new])
        return at[back]

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, ids of each unit) for units given by cache index."""
        sizes = self.size[at].astype(np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(self.first[at] - (ends - sizes), sizes)
        return self.ids[where], sizes
