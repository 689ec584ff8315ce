"""Benchmark items in documents, by latent semantic retrieval.

Passages of all documents are rows of a TF-IDF matrix over the items' words.
A randomised SVD of it (one distributed pass: every task sums ``A^T A`` times a
random matrix over its passages, the driver finishes the small Nystroem step)
gives each word a short vector.  A window of a document is the sum of its
words' vectors; windows of about an item's length slide over every whole text,
and those whose cosine with an item, and whose share of the item's own vector,
are high enough become candidates.  The latent space may miss paraphrases, so
every stretch of up to ``SPAN`` times an item's length that can pass the check
becomes a candidate too: one that keeps ``LOOSE`` of an item's words must hold
some of its rarest, and those are looked up word by word.

A candidate is checked on the words: the longest common subsequence of the item
and the text around the window must hold ``SAME`` of the item's words, or, for
paraphrases, ``LOOSE`` of them and with them the item's answer, its last
sentence, all but whole.

Items are read in blocks of bounded size; each block is one set of passes over
all documents, whose cost doesn't depend on how documents repeat.

Defined results: a null text has no words and no hits; items without words are
found nowhere; rows with null ids take part and keep their null; repeated rows
give repeated hits; an item of one id with several rows is one item for each
row; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bucket, fresh_worker, payload_batches
from .words import Words, hashed, plain_words, slices, text_buffer

#: Latent dimensions, and those the sketch has beyond them; words of a passage that the matrix has a row for.
RANK, OVERSAMPLE, PASSAGE = 48, 8, 32
#: Least cosine of a window with an item, and least share of the item's vector that the window must hold.
COSINE, SHARE = 0.65, 0.6
#: Parts of an item's words that the common subsequence must hold: alone, or together with the answer; and of the answer.
SAME, LOOSE, ANSWER = 0.75, 0.5, 0.8
#: Window lengths grow by this factor; a window moves on by its length over ``STEPS``; both in groups of ``GRAIN`` words.
GROW, STEPS, GRAIN = 1.4, 5, 3
#: Share of an item that the nearest window covers at least; windows times items of one product.
HELD, CELLS = 0.8, 2_000_000
#: A stretch to be found is at most so many times an item's length; part of an item's words that are looked up
#: beyond those of which a hit holds one at least; items whose words are looked up together.
SPAN, MORE, TOGETHER = 1.5, 0.15, 256
#: Cells of the table of items by words; beyond it their pairs are searched.
TABLE = 1 << 23
#: A word that an item has so many times, or more, counts as often as a text has it.
ENDLESS = 255
#: Bytes of items that are searched together.
BLOCK_BYTES = 1 << 20
_PARTS = 32
#: Top bits of a word's hash by which its feature is looked up.
SLOT_BITS = 16


class Items:
    """The words of a block of items, as features 0.. in order of their hashes."""

    def __init__(self, ids: list, texts: list[str]):
        found = [(i, t, self._hashes(t)) for i, t in zip(ids, texts)]
        found = [(i, t, h) for i, t, h in found if len(h)]
        self.ids, self.words = [f[0] for f in found], [f[2] for f in found]
        self.answers = [self._hashes(self._answer(f[1])) for f in found]
        self.known = np.unique(np.concatenate(self.words)) if found else np.zeros(0, np.uint64)
        # a word's slot holds the first feature there; only where a slot has several is the rest searched
        slot = (self.known >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        used, first, many = np.unique(slot, return_index=True, return_counts=True)
        self.slots, self.crowded = np.zeros(1 << SLOT_BITS, np.int32), np.zeros(1 << SLOT_BITS, bool)
        self.slots[used], self.crowded[used] = first, many > 1

    @staticmethod
    def _hashes(text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        return hashed(plain_words(raw, np.array([0, len(raw)])))

    @staticmethod
    def _answer(text: str) -> str:
        """The last sentence that has words."""
        parts = [p for p in re.split(r"[.!?\n]+", text) if re.search(r"\w", p)]
        return parts[-1] if parts else ""

    def features(self, h: np.ndarray) -> np.ndarray:
        """The feature of each word, -1 for words that no item has."""
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
        at = self.slots[slot].astype(np.int64)
        missed = self.known[at] != h
        rest = np.flatnonzero(missed & self.crowded[slot])
        at[missed] = -1
        found = np.minimum(np.searchsorted(self.known, h[rest]), len(self.known) - 1)
        at[rest] = np.where(self.known[found] == h[rest], found, -1)
        return at


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, Words]]:
    data, offsets = text_buffer(batch.column(column))
    for a, b in slices(offsets):
        yield a, b, plain_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


def _passages(w: Words) -> np.ndarray:
    """The passage of each word: ``PASSAGE`` words of one row."""
    place = np.arange(len(w.start)) - np.repeat(w.first[:-1], w.counts)
    row = w.row_of()
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] % PASSAGE == 0)
    return np.cumsum(new) - 1


def _distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values, by a sort: faster here than a table of hashes."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def _row_sums(values: np.ndarray, at: np.ndarray, cut: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The sum of ``values[at]`` over each stretch of ``many`` places from ``cut`` on; no stretch is longer than a passage."""
    by = np.argsort(-many, kind="stable")
    start, left = cut[by], -many[by]
    rows = values[at[start]]
    for k in range(1, -int(left[0])):
        go_on = np.searchsorted(left, -k)
        rows[:go_on] += values[at[start[:go_on] + k]]
    out = np.empty_like(rows)
    out[by] = rows
    return out


def _summed(df: DataFrame, run, size: int) -> np.ndarray:
    """The sum over all tasks of the vector of ``size`` numbers that ``run`` makes of a task's batches."""

    def each(batches):
        total = run(batches)
        if total is not None:
            yield from payload_batches((i, x.tobytes()) for i, x in enumerate(np.array_split(total.astype("<f8").ravel(), _PARTS)))

    def add(batches):
        now, total = None, None
        for batch in batches:
            for b, p in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(p.as_buffer(), "<f8")
                if b != now:
                    if now is not None:
                        yield next(payload_batches([(now, total.tobytes())]))
                    now, total = b, x.copy()
                else:
                    total += x
        if now is not None:
            yield next(payload_batches([(now, total.tobytes())]))

    parts = {r["bucket"]: np.frombuffer(bytes(r["payload"]), "<f8") for r in by_bucket(df.mapInArrow(each, "bucket int, payload binary"), add, "bucket int, payload binary").collect()}
    return np.concatenate([parts[i] for i in range(_PARTS)]) if parts else np.zeros(size)


class Space:
    """Word vectors of a block of items: the right singular vectors of the passages' TF-IDF matrix, by words."""

    def __init__(self, texts: DataFrame, items: Items):
        spark = texts.sparkSession
        shared = spark.sparkContext.broadcast(items)
        d = len(items.known)

        def count(batches):
            fresh_worker()
            n, held = np.zeros(d + 1), False
            for batch in batches:
                for _, _, w in _slices(batch, "text"):
                    if not len(w.start):
                        continue
                    held = True
                    f, p = shared.value.features(hashed(w)), _passages(w)
                    n[d] += p[-1] + 1
                    pair = _distinct(p[f >= 0] * np.int64(d) + f[f >= 0])
                    n[:d] += np.bincount(pair % d, minlength=d)
            return n if held else None

        n = _summed(texts, count, d + 1)
        self.idf = np.log((n[d] + 1) / (n[:d] + 1)) + 1
        idf, width = self.idf, min(RANK + OVERSAMPLE, d)
        omega = np.random.default_rng(3).normal(size=(d, width)).astype(np.float32)
        weights = spark.sparkContext.broadcast((idf.astype(np.float32), omega))

        def sketch(batches):
            w_idf, om = weights.value
            scaled = om * w_idf[:, None]
            total, held = np.zeros((d, width)), False
            for batch in batches:
                for _, _, w in _slices(batch, "text"):
                    f = shared.value.features(hashed(w))
                    p = _passages(w)[f >= 0]
                    f = f[f >= 0]
                    if not len(f):
                        continue
                    held = True
                    cut = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
                    many = np.diff(np.r_[cut, len(f)])
                    rows = _row_sums(scaled, f, cut, many)
                    norm = np.add.reduceat(w_idf[f] ** 2, cut)  # rows of unit length, but for repeated words
                    rows /= norm[:, None]
                    order = np.argsort(f, kind="stable")
                    at = np.repeat(np.arange(len(cut)), many)[order]
                    g = f[order]
                    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
                    total[g[first]] += np.add.reduceat(rows[at], first, axis=0) * w_idf[g[first], None]
            return total if held else None

        y = _summed(texts, sketch, d * width).reshape(d, width)
        small = omega.T.astype(float) @ y
        small = (small + small.T) / 2
        values, vectors = np.linalg.eigh(small)
        keep = values > max(values.max(), 0) * 1e-5 if len(values) else np.zeros(0, bool)
        u, sizes, _ = np.linalg.svd(y @ (vectors[:, keep] / np.sqrt(values[keep])), full_matrices=False) if keep.any() else (np.zeros((d, 0)), np.ones(0), None)
        # every direction counts alike: left to their sizes, the commonest words would decide all cosines
        self.vectors = (u[:, :RANK] / np.maximum(sizes[:RANK], 1e-9) * idf[:, None]).astype(np.float32)
        self.vectors *= np.float32(1 / max(float(np.abs(self.vectors).max(initial=0)), 1e-9))


def _bit_lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, the rows of the table as bits of one integer."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for x in b:
        m = where.get(x)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - bin(row).count("1")


class Searcher:
    """Finds the items of a block in slices of texts."""

    def __init__(self, items: Items, vectors: np.ndarray, idf: np.ndarray):
        self.items = items
        self._look_up(idf)
        self.vectors = np.vstack([vectors, np.zeros((1, vectors.shape[1]), np.float32)])  # -1: no item's word
        z = np.array([vectors[items.features(h)].sum(axis=0) for h in items.words])
        sizes = np.array([len(h) for h in items.words])
        step = np.round(np.log(sizes) / np.log(GROW)).astype(int)
        self.classes = []
        for s in np.unique(step):
            at = np.flatnonzero(step == s)
            zi = z[at]
            norm = np.maximum(np.linalg.norm(zi, axis=1), 1e-9)
            self.classes.append((max(1, int(round(GROW ** s / GRAIN))), at, (zi / norm[:, None]).T.copy(), norm))
        self.features, self.sizes = len(items.known), sizes
        self.pairs, times = np.unique(np.concatenate([i * self.features + items.features(h) for i, h in enumerate(items.words)]), return_counts=True)
        self.times = np.minimum(times, ENDLESS).astype(np.uint8)  # of a word in an item
        self.table = None
        if len(items.words) * self.features <= TABLE:
            self.table = np.zeros((len(items.words), self.features), np.uint8)
            self.table.ravel()[self.pairs] = self.times
        self.lists = [h.tolist() for h in items.words]
        self.answer_lists = [h.tolist() for h in items.answers]

    def _look_up(self, idf: np.ndarray) -> None:
        """For groups of items: where the items of each word begin, and the items; only an item's rarest words count."""
        items = self.items
        sizes = np.array([len(h) for h in items.words])
        self.needed = np.ceil(LOOSE * sizes - 1e-9).astype(np.int64)  # least common subsequence of any hit
        self.span = np.maximum(1, (SPAN * sizes).astype(np.int64))
        self.grid = np.maximum(1, sizes // 2)
        # all but needed - 1 words (no hit is without them) and some more: a hit holds ``least`` of them
        kept = np.minimum(sizes, sizes - self.needed + 1 + (MORE * sizes).astype(np.int64))
        self.least = kept - (sizes - self.needed)
        self.groups = []
        for a in range(0, len(sizes), TOGETHER):
            words = [items.features(h) for h in items.words[a:a + TOGETHER]]
            words = [np.unique(g[np.argsort(-idf[g], kind="stable")[:k]]) for g, k in zip(words, kept[a:a + TOGETHER])]
            of, word = np.repeat(np.arange(a, a + len(words)), [len(g) for g in words]), np.concatenate(words)
            order = np.argsort(word, kind="stable")
            self.groups.append((np.searchsorted(word[order], np.arange(len(items.known) + 1)), of[order]))

    def stretches(self, f: np.ndarray, w: Words) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, start, end): stretches of two lengths of the item that cover every shorter one with enough of its words."""
        sizes, row_of = self.sizes, w.row_of()
        known = np.flatnonzero(f >= 0)
        for begin, of in self.groups:
            many = begin[f[known] + 1] - begin[f[known]]
            at, many = known[many > 0], many[many > 0]
            if not len(at):
                continue
            item = of[np.repeat(begin[f[at]] - np.cumsum(many) + many, many) + np.arange(many.sum())]
            key = np.sort(item * len(f) + np.repeat(at, many))
            item, at = key // len(f), key % len(f)
            last = np.arange(len(key)) + self.least[item] - 1
            inside = last < len(key)
            k, last = np.flatnonzero(inside), last[inside]
            near = (item[last] == item[k]) & (row_of[at[last]] == row_of[at[k]]) & (at[last] - at[k] < self.span[item[k]])
            item, at, end = item[k[near]], at[k[near]], at[last[near]]
            if not len(item):
                continue
            row = row_of[at]
            step, top = self.grid[item], w.first[row]
            low = np.maximum(0, end - top - self.span[item] + 1) // step
            looks = (at - top) // step - low + 1
            q = np.repeat(low - np.cumsum(looks) + looks, looks) + np.arange(looks.sum())
            wide = int(q.max()) + 1
            key = _distinct((np.repeat(item, looks) * w.rows + np.repeat(row, looks)) * wide + q)
            item, row, q = key // wide // w.rows, key // wide % w.rows, key % wide
            start = w.first[row] + q * self.grid[item]
            # up to the step beyond the span: what begins before the next look ends within this one
            end = np.minimum(start + self.span[item] + self.grid[item], w.first[row + 1])
            for a, b in self._blocks(end - start):
                width = np.arange(int((end[a:b] - start[a:b]).max()))
                words = f[np.minimum(start[a:b, None] + width, len(f) - 1)]
                found = self._has(item[a:b], words) & (width < (end - start)[a:b, None])
                enough = np.flatnonzero(found.sum(axis=1) >= self.needed[item[a:b]])
                if not len(enough):
                    continue
                most = self._in_common(item[a + enough], np.where(found[enough], words[enough], self.features))
                for x in a + enough[most >= self.needed[item[a + enough]]]:
                    yield int(row[x]), int(item[x]), int(start[x]), int(end[x])

    @staticmethod
    def _blocks(width: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of looks whose words fit a bounded table."""
        step = max(1, CELLS // max(1, int(width.max())))
        for a in range(0, len(width), step):
            yield a, min(a + step, len(width))

    def candidates(self, f: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(start, window length, item) over the words of a slice."""
        n = -(-len(f) // GRAIN)
        padded = np.full(n * GRAIN, -1)
        padded[:len(f)] = f
        last = max(c[0] for c in self.classes)
        run = np.zeros((n + 1 + last, self.vectors.shape[1]), np.float32)  # windows that reach beyond the end end there
        parts, own = padded.reshape(n, GRAIN), run[1:n + 1]
        own[:] = self.vectors[parts[:, 0]]
        for k in range(1, GRAIN):
            own += self.vectors[parts[:, k]]
        np.cumsum(run[:n + 1], axis=0, out=run[:n + 1])
        run[n + 1:] = run[n]
        for size, at, unit, norm in self.classes:
            move = max(1, size // STEPS)
            start = np.arange(0, max(1, n - size + 1 + move), move)
            step = max(1, CELLS // len(at))
            for lo in range(0, len(start), step):
                s = start[lo:lo + step]
                a, b = int(s[0]), int(s[-1]) + 1
                z = run[a + size:b + size:move] - run[a:b:move]
                dot = z @ unit
                length = np.sqrt(np.einsum("ij,ij->i", z, z))
                i, j = np.divmod(np.flatnonzero(dot >= (COSINE * length)[:, None]), len(at))
                held = dot[i, j] >= SHARE * norm[j]
                i, j = i[held], j[held]
                i, j = s[i] * GRAIN, at[j]
                for c in range(0, len(i), 1 << 12):
                    yield from self._holding(padded, i[c:c + (1 << 12)], j[c:c + (1 << 12)], size * GRAIN)

    def _has(self, item: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Whether the item of a row has each of the row's words."""
        if self.table is not None:
            return (self.table[item[:, None], words] > 0) & (words >= 0)
        key = item[:, None] * self.features + words
        return (self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key) & (words >= 0)

    def _in_common(self, item: np.ndarray, words: np.ndarray) -> np.ndarray:
        """How many words each item and its row have in common, whatever their order; a row's words are the item's, or ``features`` for none."""
        words = np.sort(words, axis=1)
        at = np.arange(words.shape[1])
        new = np.ones(words.shape, bool)
        new[:, 1:] = words[:, 1:] != words[:, :-1]
        number = at - np.maximum.accumulate(np.where(new, at, 0), axis=1)
        word = np.minimum(words, self.features - 1)
        key = item[:, None] * self.features + word
        times = self.table[item[:, None], word] if self.table is not None else self.times[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)]
        return ((words < self.features) & ((number < times) | (times == ENDLESS))).sum(axis=1)

    def _holding(self, f: np.ndarray, start: np.ndarray, item: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
        """The candidates whose window holds enough words of the item, whatever their order."""
        words = f[np.minimum(start[:, None] + np.arange(size), len(f) - 1)]
        keep = self._has(item, words).sum(axis=1) >= LOOSE * HELD * self.sizes[item]
        yield from zip(start[keep].tolist(), [size] * int(keep.sum()), item[keep].tolist())

    def verify(self, words: list[int], item: int, known: list[int] | None = None) -> float:
        """The part of the item's words in the common subsequence with a text, 0 if that is no hit; with ``known``, ``words`` may be only the item's."""
        whole, answer = self.lists[item], self.answer_lists[item]
        part = _bit_lcs(whole, words) / len(whole)
        if part >= SAME or part >= LOOSE and answer and _bit_lcs(answer, words if known is None else known) >= ANSWER * len(answer):
            return part
        return 0.0

    def _part(self, h: np.ndarray, f: np.ndarray, item: int) -> float:
        """``verify`` for a text's hashes and features: words that the item doesn't have can't be part of a common subsequence."""
        own = h[self._has(np.array([item]), f[None])[0]]
        return self.verify(own.tolist(), item, h[f >= 0].tolist()) if len(own) >= LOOSE * self.sizes[item] else 0.0

    def hits(self, w: Words) -> dict[tuple[int, int], tuple[float, int, int]]:
        """(row, item): (part found, first and end word of where) for the words of a slice."""
        h = hashed(w)
        if not len(h):
            return {}
        f = self.items.features(h)
        out: dict[tuple[int, int], tuple[float, int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        for start, size, item in self.candidates(f):
            m = len(self.lists[item])
            for row in {int(np.searchsorted(w.first, x, "right")) - 1 for x in (start, min(start + size, len(h)) - 1)}:
                lo, hi = max(int(w.first[row]), start - m // 2), min(int(w.first[row + 1]), start + size + m // 2)
                if hi <= lo or done.get((row, item), -1) >= lo + m // 4:  # the last look covered this place
                    continue
                done[row, item] = lo
                part = self._part(h[lo:hi], f[lo:hi], item)
                if part > out.get((row, item), (0.0, 0, 0))[0]:
                    out[row, item] = (part, lo - int(w.first[row]), hi - int(w.first[row]))
        for row, item, lo, hi in self.stretches(f, w):
            part = self._part(h[lo:hi], f[lo:hi], item)
            if part > out.get((row, item), (0.0, 0, 0))[0]:
                out[row, item] = (part, lo - int(w.first[row]), hi - int(w.first[row]))
        return out


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks of about ``limit`` bytes."""
    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // limit))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for i in range(blocks):
        found = rows.where(part == i).orderBy("item_id", "text").collect()
        items = Items([r["item_id"] for r in found], [r["text"] for r in found])
        if len(items.ids):
            yield items


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", extra: list[str] = ()) -> DataFrame:
    """doc_id, item_id, part, start, end of every item found in every row: the words between ``start`` and ``end`` hold
    ``part`` of the item's words in order.  With ``extra`` these columns of the row come along as a struct."""
    held = [F.struct(*[F.col(c) for c in extra]).alias("extra")] if extra else []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *held)
    item_kind = dict(benchmark.dtypes)[item_col]
    kinds = dict(rows.dtypes)
    spark = rows.sparkSession
    schema = f"doc_id {kinds['doc_id']}, item_id {item_kind}, part double, start int, end int" + (f", extra {kinds['extra']}" if extra else "")
    found = None
    for items in item_blocks(benchmark, item_col, item_text_col):
        space = Space(rows.select("text"), items)
        shared = spark.sparkContext.broadcast(Searcher(items, space.vectors, space.idf))

        def search(batches, shared=shared):
            item_type = None
            for batch in batches:
                at, ids, parts, starts, ends = [], [], [], [], []
                for a, _, w in _slices(batch, "text"):
                    for (row, item), (part, lo, hi) in sorted(shared.value.hits(w).items()):
                        at.append(a + row)
                        ids.append(shared.value.items.ids[item])
                        parts.append(part)
                        starts.append(lo)
                        ends.append(hi)
                item_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(item_kind)
                rows_at = pa.array(at, pa.int64())
                yield pa.record_batch([batch.column("doc_id").take(rows_at), pa.array(ids, item_type), pa.array(parts, pa.float64()), pa.array(starts, pa.int32()),
                                       pa.array(ends, pa.int32()), *([batch.column("extra").take(rows_at)] if extra else [])],
                                      names=["doc_id", "item_id", "part", "start", "end", *(["extra"] if extra else [])])

        hits = rows.mapInArrow(search, schema)
        found = hits if found is None else found.union(hits)
    return found if found is not None else spark.createDataFrame([], schema)


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, in whose text no item is found."""
    spark, names = docs.sparkSession, docs.columns
    kept = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    text = f"c{names.index(text_col)}"
    for items in item_blocks(benchmark, item_col, item_text_col):
        space = Space(docs.select(F.col(text_col).alias("text")), items)
        shared = spark.sparkContext.broadcast(Searcher(items, space.vectors, space.idf))

        def keep(batches, shared=shared):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for a, _, w in _slices(batch, text):
                    for row, _ in shared.value.hits(w):
                        clean[a + row] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(keep, kept.schema)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
