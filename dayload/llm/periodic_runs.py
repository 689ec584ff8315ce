"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period ``q`` that is at least
``max(12, 2 q)`` words long and can't be extended.  They are found scale by
scale, for all texts of a slice at once:

* periods below ``3 * BASE`` are found by comparing the words with themselves,
  shifted;
* at scale ``t`` (``BASE``, doubled again and again) the positions of a
  synchronising set are chosen by hash: position ``i`` belongs to it if the
  smallest hash of the ``t``-word windows starting in ``[i, i + t]`` stands at
  either end of that range, windows with a period of ``t / 3`` or less left
  out.  Whether a position belongs depends on its ``2 t`` words alone, and every
  ``t`` positions have one unless the text is highly periodic there;
* a run of period ``3 t <= q < 6 t`` then holds two positions ``q`` apart with
  equal ``2 t`` words: such pairs (a position has a bounded number of others so
  near) propose ``q``, pairs that overlap are one proposal, which is extended
  word by word;
* if the first period of a run is itself highly periodic, the run lies across
  two such regions that touch; all regions of period ``t / 3`` or less are
  known from smaller scales, and a pair of neighbours with the same root
  proposes its periods, which are one residue class.

Words are compared by 64-bit hashes within one document.

Defined results: a null text has no words and no run; a null id is never
planted; rows that share an id or a text are judged by themselves; an empty
table gives an empty result; other columns are not read.  A document is held
whole by one task, at about 150 bytes for each of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, batches_of, hashed, mix

#: Words of the shortest run, and the smallest scale.
LEAST, BASE = 12, 4
#: Words joined at a time when a long text is hashed.
BLOCK_WORDS = 1 << 18
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0xD1342543DE82EF95)


def _doubled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as wide; what would leave the array is hashed with its place instead."""
    right = np.empty_like(h)
    right[:len(h) - width] = h[width:]
    right[len(h) - width:] = np.arange(min(width, len(h)), dtype=np.uint64) + _STEP
    return mix(h ^ mix(right * _STEP + np.uint64(width)))


def _window_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values: suffix and prefix minima of blocks."""
    n = len(a)
    if n < width:
        return np.zeros(0, a.dtype)
    padded = np.full(-(-n // width) * width, _NONE, a.dtype)
    padded[:n] = a
    blocks = padded.reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n - width + 1], prefix[width - 1:n])


def _extended(t: np.ndarray, lo: np.ndarray, hi: np.ndarray, d: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The widest [lo, hi) around each given one in which every word equals the one ``d`` further on."""
    lo, hi, n = lo.copy(), hi.copy(), len(t)
    ahead = np.arange(step)
    live = np.arange(len(lo))
    while len(live):
        at = hi[live, None] + ahead
        to = at + d[live, None]
        same = (to < n) & (t[np.minimum(at, n - 1)] == t[np.minimum(to, n - 1)])
        k = np.where(same.all(axis=1), step, same.argmin(axis=1))
        hi[live] += k
        live = live[k == step]
    live = np.arange(len(lo))
    while len(live):
        at = lo[live, None] - 1 - ahead
        same = (at >= 0) & (t[np.maximum(at, 0)] == t[np.maximum(at, 0) + d[live, None]])
        k = np.where(same.all(axis=1), step, same.argmin(axis=1))
        lo[live] -= k
        live = live[k == step]
    return lo, hi


def _small_periods(t: np.ndarray, below: int) -> list[np.ndarray]:
    """(start, end, period) of the stretches with periods under ``below``, four words at least."""
    out = []
    for q in range(1, min(below, len(t))):
        same = np.zeros(len(t) - q + 2, np.int8)
        same[1:-1] = t[q:] == t[:-q]
        edge = np.flatnonzero(np.diff(same))
        lo, hi = edge[::2], edge[1::2] + q
        keep = hi - lo >= max(4, 2 * q)
        out.append(np.stack([lo[keep], hi[keep], np.full(keep.sum(), q)]))
    return out


def _primitive(runs: np.ndarray) -> np.ndarray:
    """Of the runs over the same stretch the one of the smallest period."""
    order = np.lexsort((runs[2], runs[1], runs[0]))
    runs = runs[:, order]
    first = np.ones(runs.shape[1], bool)
    first[1:] = (runs[0, 1:] != runs[0, :-1]) | (runs[1, 1:] != runs[1, :-1])
    return runs[:, first]


def _touching(t: np.ndarray, known: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    """(from, to, period) proposed by neighbouring highly periodic regions: each word there equals the one a period on."""
    lo, hi, q = known[:, (3 * known[2] <= scale) & (known[1] - known[0] >= 3 * scale)]
    order = np.lexsort((lo, q))
    lo, hi, q = lo[order], hi[order], q[order]
    for i in np.flatnonzero((q[1:] == q[:-1]) & (lo[1:] <= hi[:-1]) & (lo[1:] > lo[:-1])).tolist():
        a, end, y, far, p = int(lo[i]), int(hi[i]), int(lo[i + 1]), int(hi[i + 1]), int(q[i])
        root, text = t[y:y + p].tobytes(), t[a:a + 2 * p - 1].tobytes()
        at = text.find(root)
        while at >= 0 and at % t.itemsize:
            at = text.find(root, at + 1)
        if at < 0:
            continue
        first = (y - a - at // t.itemsize) % p
        start = 3 * scale + (first - 3 * scale) % p
        for d in range(start, min(6 * scale, far - a), p):
            x0, x1 = max(a, y - d), min(end, far - d)
            if x1 > x0:
                yield x0, x1, d


def find_runs(t: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs.  ``t`` holds word hashes; document ``r`` starts at ``first[r]`` and is followed by one value of its own."""
    known = _primitive(np.concatenate([np.zeros((3, 0), np.int64), *_small_periods(t, 3 * BASE)], axis=1))
    size = np.diff(np.r_[first, len(t)]) - 1
    sub, place, h, scale = t, np.arange(len(t)), t, 1
    while scale < BASE and len(t):
        h, scale = _doubled(h, scale), 2 * scale
    while len(sub):
        enough = size >= 6 * scale
        if not enough.all():
            keep = np.repeat(enough, size + 1)
            sub, place, h, size = sub[keep], place[keep], h[keep], size[enough]
        if not len(sub):
            break
        # windows of a small period are left out of the choice
        lo, hi, _ = known[:, (3 * known[2] <= scale) & (known[1] - known[0] >= scale)]
        at = np.minimum(np.searchsorted(place, lo), len(place) - 1)
        here = place[at] == lo
        cover = np.zeros(len(sub) + 1, np.int32)
        np.add.at(cover, at[here], 1)
        np.add.at(cover, at[here] + (hi - lo)[here] - scale + 1, -1)
        order = np.where(np.cumsum(cover[:-1]) > 0, _NONE, h)
        least = _window_min(order, scale + 1)
        chosen = np.flatnonzero((least != _NONE) & ((least == order[:len(least)]) | (least == order[scale:])))
        wide = _doubled(h, scale)
        context = wide[chosen]
        pairs, k = [], 1
        while k < len(chosen):
            far = chosen[k:] - chosen[:-k]
            near = far < 6 * scale
            if not near.any():
                break
            hit = np.flatnonzero(near & (far >= 3 * scale) & (context[k:] == context[:-k]))
            pairs.append(np.stack([chosen[hit], far[hit]]))
            k += 1
        found = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        order = np.lexsort((found[0], found[1]))
        at, d = found[0][order], found[1][order]
        new = np.ones(len(at), bool)
        new[1:] = (d[1:] != d[:-1]) | (at[1:] - at[:-1] > 2 * scale)
        begin = np.flatnonzero(new)
        last = np.r_[begin[1:], len(at)] - 1
        lo, hi, d = place[at[begin]], place[at[last]] + 2 * scale if len(at) else np.zeros(0, np.int64), d[begin]
        near = np.array(list(_touching(t, known, scale)), np.int64).reshape(-1, 3).T
        lo, hi, d = (np.concatenate([a, b]).astype(np.int64) for a, b in zip((lo, hi, d), near))
        for a in range(0, len(lo), 1 << 14):
            part = slice(a, a + (1 << 14))
            x0, x1 = _extended(t, lo[part], hi[part], d[part], 32)
            good = x1 - x0 >= d[part]
            known = np.concatenate([known, np.stack([x0[good], (x1 + d[part])[good], d[part][good]])], axis=1)
        known = _primitive(known)
        h, scale = wide, 2 * scale
    return known[:, known[1] - known[0] >= LEAST]


def planted_index(words: Words, keys: list) -> np.ndarray:
    """The word that stands at each place: where ``key % 10 == 0`` the tail of the row repeats its first words.

    With ``g = key // 10`` the tail starts at ``g % n`` and its period is one
    more than the ``3 + g % 8``-th part of its length.
    """
    src = np.arange(len(words.start))
    for r, key in enumerate(keys):
        f, n = int(words.first[r]), int(words.first[r + 1] - words.first[r])
        if key is None or key % 10 or not n:
            continue
        g = key // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        src[f + a:f + n] = f + a + np.arange(n - a) % p
    return src


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """The words with one space after each."""
    size = end - start + 1
    ends = np.cumsum(size)
    if not len(ends):
        return b""
    where = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
    where[ends - 1] = 0
    out = data[where]
    out[ends - 1] = 32
    return out.tobytes()


class SliceRuns:
    """The runs of the rows of one slice: ``row``, ``start``, ``length``, ``period`` (by row, start, period) and the kept words."""

    def __init__(self, words: Words, keys: list | None = None):
        n = words.rows
        h, self.start, self.end, self.words = hashed(words), words.start, words.end, words
        if keys is not None:
            src = planted_index(words, keys)
            h, self.start, self.end = h[src], self.start[src], self.end[src]
        first = words.first[:-1] + np.arange(n)  # one value more after each row
        t = np.empty(len(h) + n, np.uint64)
        at = np.arange(len(h)) + words.row_of()
        t[at] = h
        t[words.first[1:] + np.arange(n)] = mix(np.arange(n, dtype=np.uint64) * _STEP + np.uint64(1))
        lo, hi, period = find_runs(t, first)
        row = np.searchsorted(first, lo, "right") - 1
        order = np.lexsort((period, lo))
        self.row, self.length, self.period = row[order], (hi - lo)[order], period[order]
        self.at = (lo - first[row])[order]
        gone = np.zeros(len(t) + 1, np.int32)
        np.add.at(gone, lo + period, 1)
        np.add.at(gone, hi, -1)
        self.kept = (np.cumsum(gone)[:-1] == 0)[at]

    def rows(self) -> Iterator[tuple[int, slice]]:
        """(row, its part of the runs)."""
        cut = np.searchsorted(self.row, np.arange(self.words.rows + 1))
        for r in range(self.words.rows):
            yield r, slice(int(cut[r]), int(cut[r + 1]))

    def collapsed(self, r: int) -> Iterator[bytes]:
        """The kept words of a row, joined by one space, in blocks."""
        a, b = int(self.words.first[r]), int(self.words.first[r + 1])
        held = b""
        for x in range(a, b, BLOCK_WORDS):
            at = np.flatnonzero(self.kept[x:min(b, x + BLOCK_WORDS)]) + x
            if len(at):
                yield held
                held = _joined(self.words.data, self.start[at], self.end[at])
        yield held[:-1]


def _per_slice(docs: DataFrame, render, schema: str, planted: bool, id_col: str, text_col: str) -> DataFrame:
    """``render(ids, SliceRuns)`` (an Arrow batch) of every slice of every batch."""

    def run(batches):
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("key").to_pylist()
            for a, b, words in batches_of(batch, "text"):
                yield render(ids.slice(a, b - a), SliceRuns(words, keys[a:b] if planted else None))

    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.crc32(F.col(id_col).cast("string")).alias("key"))
    return frame.mapInArrow(run, f"doc_id {dict(frame.dtypes)['doc_id']}, {schema}")


def run_digests(docs: DataFrame, planted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: number of runs, the longest run, digests of all runs and of the collapsed text."""

    def render(ids, found: SliceRuns):
        columns: list[list] = [[] for _ in range(7)]
        for r, part in found.rows():
            at, length, period = found.at[part].tolist(), found.length[part].tolist(), found.period[part].tolist()
            best = min(zip([-n for n in length], at, period), default=None)
            text = hashlib.sha256("".join(f"{x},{n},{p}\n" for x, n, p in zip(at, length, period)).encode())
            whole = hashlib.sha256()
            for block in found.collapsed(r):
                whole.update(block)
            row = (len(at), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4), text.hexdigest(), whole.hexdigest())
            for c, v in zip(columns, row):
                c.append(v)
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        return pa.record_batch([ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", *names])

    return _per_slice(docs, render, "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string",
                      planted, id_col, text_col)


def document_runs(docs: DataFrame, planted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each run: doc_id, start, length, period."""

    def render(ids, found: SliceRuns):
        return pa.record_batch([ids.take(pa.array(found.row)), *(pa.array(x, pa.int64()) for x in (found.at, found.length, found.period))],
                               names=["doc_id", "start", "length", "period"])

    return _per_slice(docs, render, "start long, length long, period long", planted, id_col, text_col)


def collapsed_texts(docs: DataFrame, planted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the text with the first period of every run kept alone, words joined by one space."""

    def render(ids, found: SliceRuns):
        texts = [b"".join(found.collapsed(r)).decode("utf-8") for r in range(found.words.rows)]
        return pa.record_batch([ids, pa.array(texts, pa.string())], names=["doc_id", "text"])

    return _per_slice(docs, render, "text string", planted, id_col, text_col)
