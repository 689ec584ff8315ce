"""Toxicity by multiple-instance learning: a text is toxic if any of its sentences is.

A sentence's score is a logistic function of its words (hashed, each counted
once); a text's score is the leaky noisy-or of its sentences, one minus the
product of what each leaves and of a constant leak, which takes up the labels
that no sentence explains.  Only texts carry labels, so the words are fitted
through the noisy-or: every sentence of a positive text shares the push in
proportion to its own score, and every sentence of a negative text is pushed
down.  Words whose presence goes with the label no more than chance allows are
left out first (Fisher's exact test, which holds for empty cells and for any
number of texts, with a bound on the share of false finds); a sentence without
any other word is all but innocent, however many of them a long text has.

The sample that is fitted is bounded (``FIT_DOCS`` labelled rows, by hash of
their id); scoring covers every text whole.

Defined results: a null text is an empty text; a text without words scores
the leak; labels that are null, or whose id
is null, are not learnt from; a document with several label rows is learnt from
once, as positive if any row says so; repeated document rows are scored alike;
without any label of one of the kinds every score is 0; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_worker, pack, saved, unpack
from .words import find_words, grams, hash_spans, mix, slices, text_buffer

#: Buckets of hashed words; labelled texts that are fitted at most; passes over them.
BITS, FIT_DOCS, PASSES = 18, 7_000, 150
#: Step of the fit, and the pull of every weight towards zero (for each text and pass).
RATE, DECAY = 0.3, 1e-5
#: Logit of a sentence that holds no word the model knows: nearly innocent, so that thousands of them stay so.
START = -10.0
#: Share of the words let in that may go with the label by chance alone, and texts that must hold a word.
FALSE, TEXTS = 0.05, 5

_OTHER = np.uint64(0xA0761D6478BD642F)
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63, 10]] = True  # . ! ? and line ends close a sentence
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True


def sentences(column: pa.Array):
    """Yield, for slices of a text column: (word bucket, sentence of each word, sentences, row of each sentence, rows).

    Words are runs of letters, digits and non-ASCII bytes in lower case; a word
    counts once a sentence; sentences without words are left out.
    """
    data, offsets = text_buffer(column)
    for a, b in slices(offsets):
        off = offsets[a:b + 1] - offsets[a]
        raw = data[offsets[a]:offsets[b]]
        plain = np.where(_WORD[raw], raw, 32).astype(np.uint8)
        w = find_words(plain, off, lower=True)
        stops = np.concatenate([[0], np.cumsum(_STOP[raw], dtype=np.int64)])
        row = w.row_of()
        n = len(row)
        if not n:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64), 0, np.zeros(0, np.int64), b - a
            continue
        seg = stops[w.start]
        new = np.ones(n, bool)
        new[1:] = (row[1:] != row[:-1]) | (seg[1:] != seg[:-1])
        sent = np.cumsum(new) - 1
        word = (mix(hash_spans(w.data, w.start, w.end)) >> np.uint64(64 - BITS)).astype(np.int64)
        both = np.unique(sent << BITS | word)
        yield both & ((1 << BITS) - 1), both >> BITS, int(sent[-1]) + 1, row[new], b - a


def sketch(column: pa.Array) -> np.ndarray:
    """Two hashes for each text, the same for copies with a few changed words: the smallest of its 6-word grams (or of its words) in two orders."""
    out = []
    data, offsets = text_buffer(column)
    for a, b in slices(offsets):
        w = find_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], lower=True)
        h = hash_spans(w.data, w.start, w.end)
        g = grams(h, 6)
        for x, z in zip(w.first[:-1], w.first[1:]):
            held = g[x:z - 5] if z - x >= 6 else h[x:z]
            out.append((held.min(), mix(held ^ _OTHER).min()) if len(held) else (0, 0))
    return np.array(out, np.uint64).reshape(-1, 2)


@dataclass
class Model:
    """Word weights, and the leak: the score of a text in which no sentence says anything."""

    weights: np.ndarray
    leak: float

    def rows(self, word, sent, n_sent, row, n_rows) -> np.ndarray:
        """The noisy-or score of each row of a slice."""
        x = np.bincount(sent, self.weights[word], n_sent) + START
        left = np.bincount(row, -np.logaddexp(0, x), n_rows)
        return 1 - (1 - self.leak) * np.exp(left)


def by_chance(held: np.ndarray, with_pos: np.ndarray, pos: int, n: int) -> np.ndarray:
    """For words in ``held`` of ``n`` texts, ``with_pos`` of them among the ``pos`` positive ones: the probability of a
    split at least as uneven to the same side if labels were dealt at random, doubled (Fisher's exact test)."""
    log = np.r_[0.0, np.cumsum(np.log(np.arange(1, n + 1)))]
    pairs, of = np.unique(np.stack([held, with_pos], axis=1), axis=0, return_inverse=True)
    out = np.ones(len(pairs))
    for i, (m, k) in enumerate(pairs):
        x = np.arange(max(0, m - (n - pos)), min(m, pos) + 1)
        chance = np.exp(log[pos] - log[x] - log[pos - x] + log[n - pos] - log[m - x] - log[n - pos - m + x] - log[n] + log[m] + log[n - m])
        out[i] = min(1.0, 2 * min(chance[x >= k].sum(), chance[x <= k].sum()))
    return out[of.ravel()]


def telling(chance: np.ndarray, false: float = FALSE) -> np.ndarray:
    """Whether each probability is so small that at most ``false`` of those let in are expected to be chance (Benjamini and Hochberg)."""
    low = np.sort(chance)
    good = np.flatnonzero(low <= false * np.arange(1, len(low) + 1) / max(len(low), 1))
    return chance <= low[good[-1]] if len(good) else np.zeros(len(chance), bool)


def fitted(word: np.ndarray, sent: np.ndarray, row: np.ndarray, plain: np.ndarray, y: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """(weights, leak) by full-batch gradient through the noisy-or, with step sizes for each word.

    ``word`` and ``sent`` are the words the model knows and their sentences, ``row`` the text of each such sentence;
    ``plain`` counts a text's other sentences, which are all alike."""
    n, w, gain, leak = len(y), start.copy(), np.full(len(start), 1e-12), float(y.mean()) / 2
    alike = -np.logaddexp(0, START) * plain
    for _ in range(PASSES if len(start) else 0):
        x = np.bincount(sent, w[word], len(row)) + START
        p = 1 / (1 + np.exp(-x))
        rest = np.exp(np.bincount(row, -np.logaddexp(0, x), n) + alike)  # what the sentences leave
        q = 1 - (1 - leak) * rest
        # d log-likelihood / d x of a sentence: positive text p (1 - q) / q, negative text -p
        g = p * np.where(y[row] > 0, (1 - q[row]) / q[row], -1.0)
        push = np.bincount(word, g[sent], len(w)) - DECAY * n * w
        gain = np.maximum(gain, push * push)
        w += RATE * push / np.sqrt(gain)
        # the leak takes its share of each positive text (one step of expectation maximisation)
        leak = float(np.clip((y * leak / q).sum() / n, 1e-4, .4))
    return w, leak


def let_in(word: np.ndarray, held: np.ndarray, with_pos: np.ndarray, pos: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(words that tell, in order, their first weights) from how many of ``n`` texts hold each, and of the ``pos`` positive ones."""
    enough = held >= TEXTS
    word, held, with_pos = word[enough], held[enough], with_pos[enough]
    tells = telling(by_chance(held, with_pos, pos, n)) if len(word) else np.zeros(0, bool)
    order = np.argsort(word[tells])
    word, held, with_pos = (x[tells][order] for x in (word, held, with_pos))
    cells = [with_pos + .5, pos - with_pos + .5, held - with_pos + .5, (n - pos) - (held - with_pos) + .5]
    return word, np.maximum(0, np.log(cells[0] * cells[3] / (cells[1] * cells[2])) - np.sqrt(sum(1 / c for c in cells)))


def modelled(word: np.ndarray, start: np.ndarray, text: np.ndarray, sent: np.ndarray, at: np.ndarray, sentences_of: np.ndarray, y: np.ndarray) -> Model:
    """The model of ``word``, fitted on where they stand: text, sentence within it, place in ``word``."""
    order = np.lexsort((at, sent, text))  # the fit adds up in one order
    text, sent, at = text[order], sent[order], at[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (sent[1:] != sent[:-1])
    w, leak = fitted(at, np.cumsum(new) - 1, text[new], sentences_of - np.bincount(text[new], minlength=len(y)), y, start)
    weights = np.zeros(1 << BITS)
    weights[word] = w
    return Model(weights, leak)


def fit(column: pa.Array, label: np.ndarray) -> Model:
    """As ``train``, for a few texts at hand."""
    first = np.sort(np.unique(sketch(column), axis=0, return_index=True)[1])
    y, texts, n_sent, base = label.astype(float)[first], [], [], 0
    for word, sent, _, row, n in sentences(column):
        texts.append(np.stack([row[sent] + base, sent - np.searchsorted(row, row[sent]), word]))
        n_sent.append(np.bincount(row, minlength=n))
        base += n
    text, sent, word = np.concatenate(texts, axis=1)
    at = np.minimum(np.searchsorted(first, text), len(first) - 1)
    keep = first[at] == text
    text, sent, word = at[keep], sent[keep], word[keep]
    pair = np.unique(word * len(y) + text)
    every, of = np.unique(pair // len(y), return_inverse=True)
    known, start = let_in(every, np.bincount(of), np.bincount(of, y[pair % len(y)]).astype(np.int64), int(y.sum()), len(y))
    at = np.minimum(np.searchsorted(known, word), max(len(known) - 1, 0))
    keep = known[at] == word if len(known) else np.zeros(len(word), bool)
    return modelled(known, start, text[keep], sent[keep], at[keep], np.concatenate(n_sent)[first], y)


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = FIT_DOCS, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """At most ``limit`` labelled texts outside the held-out fifth, a quarter of them positive where there are enough."""
    ids = F.col(id_col).cast("long")
    marks = (labels.select(ids.alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y is not null")
             .groupBy("doc_id").agg(F.max("y").alias("y")).where(~held_out("doc_id")))
    half = limit // 4
    picked = marks.where("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(half).union(
        marks.where("y <> 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit - half))
    texts = docs.select(ids.alias("doc_id"), F.col(text_col).alias("text"))
    # one row for each picked document, the first text in order where an id repeats
    return picked.join(texts, "doc_id").groupBy("doc_id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))


def held_out(column: str):
    """Whether a document id is kept from training (a fifth of all ids)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, limit: int = FIT_DOCS, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Fit the model.  Texts are hashed where they lie: the driver gets a few numbers for each of the sample's texts, the
    counts of words by label, and the places of the words that tell."""
    nothing = Model(np.full(1 << BITS, 10 * START), 0.0)  # nothing is known to be toxic
    sample = saved(labelled_sample(docs, labels, limit, id_col, text_col, label_col), "labelled")

    def read(batches):
        fresh_worker()
        for batch in batches:
            ids, y, at = batch.column("doc_id"), batch.column("y"), 0
            sketches = sketch(batch.column("text")).view(np.int64)
            for word, sent, n_sent, row, n in sentences(batch.column("text")):
                first = np.searchsorted(row, np.arange(n + 1))  # a text's sentences
                cut = np.searchsorted(sent, first)
                held = [pack([word[a:b].astype("<i4"), (sent[a:b] - f).astype("<i4")]) for a, b, f in zip(cut[:-1], cut[1:], first[:-1])]
                yield pa.record_batch([ids.slice(at, n), y.slice(at, n), pa.array(sketches[at:at + n, 0]), pa.array(sketches[at:at + n, 1]), pa.array(np.diff(first)),
                                       pa.array(held, pa.binary())], names=["doc_id", "y", "a", "b", "sentences", "words"])
                at += n

    texts = saved(sample.mapInArrow(read, "doc_id long, y int, a long, b long, sentences long, words binary"), "sentences")
    heads = texts.select("doc_id", "y", "a", "b", "sentences").toArrow().sort_by("doc_id")
    if not heads.num_rows:
        return nothing
    # copies of one text are one witness: only the first text of each sketch counts
    first = np.sort(np.unique(np.stack([heads.column("a").to_numpy(), heads.column("b").to_numpy()]), axis=1, return_index=True)[1])
    ids, y = heads.column("doc_id").to_numpy()[first], (heads.column("y").to_numpy()[first] > 0).astype(float)
    if y.all() or not y.any():
        return nothing

    def places(batches):
        """(place in ``ids``, words, sentences) of the texts that count."""
        for batch in batches:
            doc = batch.column("doc_id").to_numpy()
            at = np.minimum(np.searchsorted(ids, doc), len(ids) - 1)
            for i in np.flatnonzero(ids[at] == doc):
                yield int(at[i]), *unpack(batch.column("words")[int(i)].as_buffer().to_pybytes(), ["<i4", "<i4"])

    def count(batches):
        fresh_worker()
        held = np.zeros((1 << BITS, 2), np.int64)
        for i, word, _ in places(batches):
            held[np.unique(word)] += (1, int(y[i]))
        some = np.flatnonzero(held[:, 0])
        yield pa.record_batch([pa.array(some), pa.array(held[some, 0]), pa.array(held[some, 1])], names=["word", "n", "pos"])

    counted = texts.mapInArrow(count, "word long, n long, pos long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).where(F.col("n") >= TEXTS).toArrow()
    word, held, with_pos = (counted.column(c).to_numpy().astype(np.int64) for c in ("word", "n", "pos"))
    n, pos = len(y), int(y.sum())
    word, start = let_in(word, held, with_pos, pos, n)

    def known(batches):
        for i, w, sent in places(batches):
            at = np.minimum(np.searchsorted(word, w), len(word) - 1)
            keep = word[at] == w
            if keep.any():
                yield pa.record_batch([pa.array(np.full(keep.sum(), i)), pa.array(sent[keep].astype(np.int64)), pa.array(at[keep])], names=["text", "sent", "word"])

    found = texts.mapInArrow(known, "text long, sent long, word long").toArrow() if len(word) else pa.table({c: pa.array([], pa.int64()) for c in ("text", "sent", "word")})
    return modelled(word, start, *(found.column(c).to_numpy() for c in ("text", "sent", "word")), heads.column("sentences").to_numpy()[first], y)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text in one more column, ``to``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def rate(texts: pa.Array) -> pa.Array:
        fresh_worker()
        parts = [shared.value.rows(*s) for s in sentences(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(to, rate(F.col(text_col)))


def offending_sentences(text: str | None, model: Model, threshold: float = 0.5) -> list[tuple[int, int, float]]:
    """(start, end, score) of a text's sentences at or above ``threshold``, as byte places in its UTF-8 form."""
    raw = np.frombuffer((text or "").encode("utf-8"), np.uint8)
    if not len(raw):
        return []
    out = []
    edges = np.flatnonzero(_STOP[raw]) + 1
    for a, b in zip(np.r_[0, edges], np.r_[edges, len(raw)]):
        found = next(iter(sentences(pa.array([raw[a:b].tobytes()], pa.binary()))), None) if b > a else None
        if found is None or not found[2]:
            continue
        p = float(model.rows(*found)[0])
        if p >= threshold:
            out.append((int(a), int(b), p))
    return out
