"""Words, word hashes and word n-grams of a whole Arrow column, in numpy.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D``.  UTF-8 keeps
ASCII bytes out of every multi-byte character, so the byte scan finds the
words of the text itself.  Nothing here knows Spark: the functions take the
Arrow batches that ``mapInArrow`` hands to a task and work on slices of a few
megabytes, so that memory does not follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes that one slice of a batch holds at most (one longer text is a slice of its own).
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)
_STEP = _U(0xD1342543DE82EF95)
_KEEP = np.array([0xFFFFFFFFFFFFFFFF] + [(1 << (8 * k)) - 1 for k in range(1, 8)], _U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Words:
    """The words of some rows: word ``i`` is ``data[start[i]:end[i]]``; row ``r`` has words ``first[r]:first[r + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, every row whole."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def find_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    if lower:
        data = _LOWER[data]
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(data, z, z, np.zeros(len(offsets), np.int64))
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = ~word[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = ~word[1:]
    start = np.flatnonzero(word & (before | edge[:-1]))
    end = np.flatnonzero(word & (after | edge[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets).astype(np.int64))


_KIND = np.full(256, 3, np.uint8)  # 0 white space, 1 letters, 2 digits, 3 other ASCII, 4 what splitting must not touch
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_KIND[65:91] = _KIND[97:123] = 1
_KIND[48:58] = 2
_KIND[128:] = _KIND[[39, 60, *range(0, 9), *range(14, 32)]] = 4


def split_plain(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut units at changes between ASCII letters, digits and other signs; white space stays with what follows.

    Units that hold an apostrophe, ``<``, a control character or non-ASCII text
    stay whole.  ``first`` (the first unit of each row) follows the new units.
    """
    if not len(start):
        return start, end, first
    kind = _KIND[data]
    cut = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[:-1] != 0)) + 1
    unit = np.searchsorted(start, cut, "right") - 1
    whole = np.concatenate([[0], np.cumsum(kind == 4, dtype=np.int32)])
    plain = whole[end] == whole[start]
    ok = (unit >= 0) & plain[unit] & (cut > start[unit]) & (cut < end[unit])
    cut, unit = cut[ok], unit[ok]
    before = np.concatenate([[0], np.cumsum(np.bincount(unit, minlength=len(start)))])
    at = np.arange(len(start)) + before[:-1]
    starts = np.empty(len(start) + len(cut), np.int64)
    starts[at] = start
    inner = unit + 1 + np.arange(len(cut))
    starts[inner] = cut
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:]
    ends[at + np.diff(before)] = end
    return starts, ends, first + before[first]


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, eight bytes a step."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = end - start
    h = mix(size.astype(_U) * _MUL + _STEP)
    live, at = np.arange(len(start)), 0
    if not len(start) or not size.any():
        return h
    while True:
        live = live[size[live] > at] if at else np.flatnonzero(size > 0)
        if not len(live):
            return h
        left = size[live] - at
        part = eight[start[live] + at] & _KEEP[np.where(left >= 8, 0, left)]
        h[live] = mix((h[live] ^ part) * _MUL + _STEP)
        at += 8


def hashed(words: Words) -> np.ndarray:
    return hash_spans(words.data, words.start, words.end)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive word hashes (one value per start, ``len(h) - n + 1`` of them)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, _U)
    g = np.zeros(m, _U)
    for j in range(n):
        g *= _STEP
        g += h[j:j + m]
    return mix(g)


def gram_starts(words: Words, n: int) -> np.ndarray:
    """Which word positions start an ``n``-gram inside their own row (mask over ``len(start) - n + 1`` starts)."""
    m = max(0, len(words.start) - n + 1)
    row = words.row_of()
    return row[:m] == row[n - 1:n - 1 + m]


def batches_of(batch: pa.RecordBatch, column: str, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of each slice of a batch."""
    data, offsets = text_buffer(batch.column(column))
    for a, b in slices(offsets):
        yield a, b, find_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], lower)


_PLAIN = np.zeros(256, bool)
_PLAIN[48:58] = _PLAIN[65:91] = _PLAIN[97:123] = True
_PLAIN[128:] = True


def plain_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of ASCII letters, digits and non-ASCII bytes, ASCII in lower case; every other sign is a break."""
    return find_words(np.where(_PLAIN[data], data, 32).astype(np.uint8), offsets, lower=True)
