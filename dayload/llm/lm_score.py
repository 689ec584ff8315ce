"""Language-model scores of whole texts by a log-bilinear model.

The model predicts the next token from the two before it: the vectors of the
context words add up to a query.  Words are dealt into classes of ``CLASS`` by
frequency; the query's product with a class's vector plus its bias scores the
class, its product with a word's vector plus the word's bias scores the word
within its class.  Both are trained by noise-contrastive estimation in numpy and
normalised exactly when a text is scored, by batched products with all
classes and with the words of the token's class.  So a token costs classes plus
``CLASS`` products, not the vocabulary, and no table of contexts is kept.

Every word that occurs ``LEAST`` times has vectors, up to the ``VOCABULARY`` most
frequent ones; one sign stands for all others, which share its probability by
their smoothed counts.

The model doesn't depend on the number of tasks.  Training texts are dealt by a
hash of id and text into shards of about ``SHARD_TOKENS`` tokens, each in a fixed order; a
shard is passed once from a common start, and the shards' parameters are
averaged row by row, weighted by the squared gradients the row has seen.

Counts of all words come from all training texts.  The most frequent
``COMMON`` words are broadcast (a fixed 2 MB), as are the vectors (5 MB at
most); the other words meet their counts in a packed shuffle, so nothing depends
on how many different words there are.

Defined results: a null text is an empty text (its end alone); a null id is
held out and not learnt from; repeated rows are scored alike and each is learnt
from; without training texts every probability is the smoothing's alone; an
empty table gives an empty result; other columns are not read.  Words are
compared by a 64-bit hash.  Single precision may move the last digits of a
score when texts are batched otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PAYLOAD, bucket_bits, bucket_of, by_bucket, count_locally, each_bucket, pack, partitions, payload_batches, saved, scatter, sums_by_hash, unpack
from .words import Words, batches_of, hashed

#: Most words with vectors of their own, least occurrences of one, words of a class, length of a vector.
VOCABULARY, LEAST, CLASS, WIDTH = 1 << 14, 8, 128, 24
#: Words whose counts are broadcast.
COMMON = 1 << 17
#: Noise classes and noise words of a batch, tokens of a batch, first step of the fit.
NOISE, DRAWS, BATCH, RATE = 16, 64, 1 << 12, 0.05
#: Tokens of a training shard; tokens that are sorted by class together, rows of one product.
SHARD_TOKENS, TOGETHER, AT_ONCE = 4_000_000, 1 << 15, 1 << 10
#: Added to every count.
SMOOTH = 0.1
#: Tokens a task groups together before it sends them.
CHUNK_TOKENS = 1_000_000
#: Parts that the parameters are cut into to be averaged.
BLOCKS = 32
OTHER, END, BEGIN = 0, 1, 2


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(True))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("held_out", held)


def word_counts(rows: DataFrame) -> DataFrame:
    """(hash, count) payloads of all words of the training texts, summed, one row for each bucket."""
    bits = bucket_bits(rows.sparkSession)

    def count(batches):
        held, n = [], 0

        def parts():
            nonlocal held, n
            for batch in batches:
                for _, _, w in batches_of(batch, "text", lower=True):
                    held.append(hashed(w))
                    n += len(held[-1])
                    if n > CHUNK_TOKENS:
                        yield from ((b, p) for b, p in count_locally(held, bits, 1) if b >= 0)
                        held, n = [], 0
            yield from ((b, p) for b, p in count_locally(held, bits, 1) if b >= 0)

        yield from payload_batches(parts())

    def add(batches):
        def parts():
            for keys, counts in sums_by_hash(batches):
                yield int(keys[0] >> np.uint64(64 - bits)), pack([keys, counts.astype("<i8")])

        yield from payload_batches(parts(), 8)

    sent = rows.where("not held_out").select("text").mapInArrow(count, "bucket int, payload binary")
    return saved(by_bucket(sent, add, "bucket int, payload binary"), "counts")


def _totals(counts: DataFrame) -> tuple[int, int]:
    """(tokens, different words) of the training texts, without ends."""

    def total(batches):
        for batch in batches:
            n = [unpack(p.as_buffer().to_pybytes(), ["<u8", "<i8"])[1] for p in batch.column(1)]
            yield pa.record_batch([pa.array([sum(int(c.sum()) for c in n)]), pa.array([sum(len(c) for c in n)])], names=["n", "v"])

    row = counts.mapInArrow(total, "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    return row["n"] or 0, row["v"] or 0


def _level(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale that keeps their order: exact below 4,096, 64 steps for each doubling above."""
    return np.where(counts < 4096, counts, 4096 + np.floor((np.log2(np.maximum(counts, 1)) - 12) * 64)).astype(np.int64)


def most_frequent(counts: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The words (hash, count) above a count threshold, the lowest that at most ``n`` words pass; most frequent first.

    A histogram of the counts gives the threshold, so no more than ``n`` rows are collected however many partitions there are."""

    def levels(batches):
        for batch in batches:
            for p in batch.column(1):
                at, many = np.unique(_level(unpack(p.as_buffer().to_pybytes(), ["<u8", "<i8"])[1]), return_counts=True)
                yield pa.record_batch([pa.array(at), pa.array(many)], names=["level", "n"])

    histogram = sorted(((r["level"], r["n"]) for r in counts.mapInArrow(levels, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()), reverse=True)
    least, held = 1 << 62, 0
    for level, many in histogram:
        held += many
        if held > n:
            break
        least = level

    def above(batches):
        for batch in batches:
            for p in batch.column(1):
                h, c = unpack(p.as_buffer().to_pybytes(), ["<u8", "<i8"])
                keep = _level(c) >= least
                yield pa.record_batch([pa.array(h[keep].view(np.int64)), pa.array(c[keep])], names=["h", "c"])

    found = counts.mapInArrow(above, "h long, c long").toArrow()
    h, c = found.column("h").to_numpy().view(np.uint64), found.column("c").to_numpy()
    order = np.lexsort((h, -c))
    return h[order], c[order]


class Vocabulary:
    """Words with vectors: id 3 and up by frequency; 0 any other word, 1 the end, 2 what stands before a text."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, tokens: int, texts: int):
        by = np.argsort(hashes)
        self.hashes, self.ids = hashes[by], (by + 3).astype(np.int32)
        self.size = len(hashes) + 3
        self.classes = -(-self.size // CLASS)
        self.counts = np.r_[tokens - counts.sum(), texts, 0, counts].astype(float)

    def encode(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(h), np.int32)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.ids[at], OTHER)


def _stream(w: Words, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the words, token ids with ends, first token of each row, one before, two before)."""
    h = hashed(w)
    ids = np.insert(vocabulary.encode(h), w.first[1:], END)
    first = w.first + np.arange(w.rows + 1)
    one = np.empty_like(ids)
    one[1:] = ids[:-1]
    one[first[:-1]] = BEGIN
    two = np.empty_like(ids)
    two[1:] = one[:-1]
    two[first[:-1]] = BEGIN
    return h, ids, first, one, two


def _step(x: np.ndarray, gains: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """An adaptive step of the rows ``at`` of ``x``, equal places summed; other rows are not touched."""
    at = at.astype(np.uint16)  # ids are below 2 ** 16, which sort by radix
    order = np.argsort(at, kind="stable")
    held = at[order]
    cut = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
    g, held = np.add.reduceat(rows[order], cut, axis=0), held[cut]
    gains[held] += g * g
    x[held] += RATE * g / np.sqrt(gains[held])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # 1 / inf is the 0 it stands for
        return 1 / (1 + np.exp(-x))


class Model:
    """Parts: context vectors one before and two before; word vectors and class vectors, each with its bias last."""

    def __init__(self, vocabulary: Vocabulary, width: int = WIDTH):
        rng = np.random.default_rng(7)
        v, self.width = vocabulary.size, width
        p = vocabulary.counts + SMOOTH
        p[BEGIN] = 0  # never a next token
        self.p = p / p.sum()
        self.mass = np.add.reduceat(self.p, np.arange(0, v, CLASS))
        out, cls = np.zeros((v, width + 1), np.float32), np.zeros((vocabulary.classes, width + 1), np.float32)
        out[:, -1] = np.log(np.maximum(self.p, 1e-30) / self.mass[np.arange(v) // CLASS])
        cls[:, -1] = np.log(self.mass)
        self.parts = [*(rng.normal(0, .1, (v, width)).astype(np.float32) for _ in range(2)), out, cls]
        self.gains = [np.full(x.shape, 1e-3, np.float32) for x in self.parts]

    def _query(self, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        q = np.ones((len(c1), self.width + 1), np.float32)
        q[:, :-1] = self.parts[0][c1] + self.parts[1][c2]
        return q

    def fit(self, streams: Iterator[tuple]) -> int:
        """One pass of noise-contrastive estimation; the number of tokens seen."""
        one, two, out, cls = self.parts
        rng, seen = np.random.default_rng(11), 0
        cum = np.cumsum(self.p)
        log_class = np.log(NOISE * self.mass).astype(np.float32)
        log_word = np.log(DRAWS * np.maximum(self.p, 1e-30)).astype(np.float32)
        for _, ids, _, before, before2 in streams:
            for a in range(0, len(ids), BATCH):
                w, c1, c2 = ids[a:a + BATCH], before[a:a + BATCH], before2[a:a + BATCH]
                k, q = w // CLASS, self._query(c1, c2)
                # classes: one draw of noise for the batch
                noise = rng.choice(len(self.mass), NOISE, p=self.mass)
                good = 1 - _sigmoid(np.einsum("ij,ij->i", q, cls[k]) - log_class[k])
                bad = -_sigmoid(q @ cls[noise].T - log_class[noise])
                dq = bad @ cls[noise] + good[:, None] * cls[k]
                class_rows = np.concatenate([good[:, None] * q, bad.T @ q])
                # words: those of the batch's draws that are of the token's class, so a word w is noise DRAWS * p(w) times
                draws = np.minimum(np.searchsorted(cum, rng.random(DRAWS) * cum[-1], side="right"), len(cum) - 1)
                goodw = 1 - _sigmoid(np.einsum("ij,ij->i", q, out[w]) - log_word[w])
                badw = -_sigmoid(q @ out[draws].T - log_word[draws]) * (k[:, None] == draws // CLASS)
                dq += badw @ out[draws] + goodw[:, None] * out[w]
                word_rows = np.concatenate([goodw[:, None] * q, badw.T @ q])
                _step(cls, self.gains[3], np.concatenate([k, noise]), class_rows)
                _step(out, self.gains[2], np.concatenate([w, draws]), word_rows)
                _step(one, self.gains[0], c1, dq[:, :-1])
                _step(two, self.gains[1], c2, dq[:, :-1])
                seen += len(w)
        return seen

    def log_probabilities(self, ids: np.ndarray, before: np.ndarray, before2: np.ndarray) -> np.ndarray:
        """The natural logarithm of each token's probability after its context, normalised over all tokens."""
        out, cls = self.parts[2:]
        total = np.empty(len(ids))
        for a in range(0, len(ids), TOGETHER):
            w = ids[a:a + TOGETHER]
            k, q = w // CLASS, self._query(before[a:a + TOGETHER], before2[a:a + TOGETHER])
            order = np.argsort(k, kind="stable")
            cut = np.flatnonzero(np.r_[True, k[order][1:] != k[order][:-1]])
            logp = np.empty(len(w))
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(w)]):
                start = int(k[order[lo]]) * CLASS
                words = np.ascontiguousarray(out[start:start + CLASS].T)
                for i in range(lo, hi, AT_ONCE):
                    at = order[i:min(i + AT_ONCE, hi)]
                    logp[at] = _log_softmax(q[at] @ words, w[at] - start)
            for lo in range(0, len(w), AT_ONCE):
                part = slice(lo, lo + AT_ONCE)
                logp[part] += _log_softmax(q[part] @ cls.T, k[part])
            total[a:a + TOGETHER] = logp
        return total


def _log_softmax(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    own = x[np.arange(len(x)), at].astype(np.float64)
    with np.errstate(over="ignore"):
        total = np.exp(x).sum(axis=1)
    if not (total.min() > 1e-30 and total.max() < 1e30):  # near the ends of single precision: from the largest score
        top = x.max(axis=1)
        return own - top - np.log(np.exp(x - top[:, None]).sum(axis=1).astype(np.float64))
    return own - np.log(total.astype(np.float64))


def _blocks(rows: int) -> np.ndarray:
    return np.linspace(0, rows, BLOCKS + 1).astype(int)


def train(rows: DataFrame, vocabulary: Vocabulary, tokens: int, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Fit on all training texts: a pass over each shard, parameters averaged by what their rows have seen."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    shards = max(1, round(tokens / shard_tokens))
    place = F.xxhash64("doc_id", "text")
    dealt = (rows.where("not held_out").select(F.pmod(place, F.lit(shards)).cast("int").alias("shard"), place.alias("place"), "text")
             .repartitionById(shards, "shard").sortWithinPartitions("shard", "place"))

    def run(batches):
        v = shared.value
        now, model = None, None

        def sent(n):
            # each row times its weight, and the weight: sums of them make the average
            if n:
                weights = [g.sum(axis=1, keepdims=True) for g in model.gains]
                for i in range(BLOCKS):
                    held = [np.hstack([w[a:b], x[a:b] * w[a:b]]).ravel() for x, w in zip(model.parts, weights) for a, b in [_blocks(len(x))[i:i + 2]]]
                    yield pa.record_batch([pa.array([i], pa.int32()), pa.array([now], pa.int32()), pa.array([np.concatenate(held).astype("<f4").tobytes()], pa.binary())],
                                          names=["bucket", "shard", "payload"])

        seen = 0
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cut = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(shard)]):
                if shard[lo] != now:
                    yield from sent(seen)
                    now, model, seen = int(shard[lo]), Model(v), 0
                seen += model.fit(_stream(w, v) for _, _, w in batches_of(batch.slice(lo, hi - lo), "text", lower=True))
        yield from sent(seen)

    def average(batches):
        now, total = None, None
        for batch in batches:
            for b, p in zip(batch.column("bucket").to_pylist(), batch.column("payload")):
                x = np.frombuffer(p.as_buffer(), "<f4")
                if b != now:
                    if now is not None:
                        yield next(payload_batches([(now, total.astype("<f4").tobytes())]))
                    now, total = b, x.astype(np.float64)
                else:
                    total += x
        if now is not None:
            yield next(payload_batches([(now, total.astype("<f4").tobytes())]))

    sums = dealt.select("shard", "text").mapInArrow(run, "bucket int, shard int, payload binary")
    sums = sums.repartition(min(BLOCKS, partitions(spark)), "bucket").sortWithinPartitions("bucket", "shard").mapInArrow(average, PAYLOAD)
    model = Model(vocabulary)
    for r in sums.collect():
        flat, at = np.frombuffer(bytes(r["payload"]), "<f4"), 0
        for x in model.parts:
            a, b = _blocks(len(x))[r["bucket"]:r["bucket"] + 2]
            held = flat[at:at + (b - a) * (x.shape[1] + 1)].reshape(b - a, x.shape[1] + 1)
            x[a:b] = held[:, 1:] / held[:, :1]
            at += held.size
    return model


_ROW = ["<i8", "u1", "u1", "<i8", "<i8", "<i8", "<f8", "<f8"]


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    rows = _rows(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    spark = rows.sparkSession
    bits = bucket_bits(spark)
    counts = word_counts(rows)
    words, different = _totals(counts)
    texts = rows.where("not held_out").count()
    n, v = words + texts, different + (texts > 0)
    common_h, common_c = most_frequent(counts, COMMON)
    own = min(VOCABULARY - 3, int((common_c >= LEAST).sum()))
    vocabulary = Vocabulary(common_h[:own], common_c[:own], words, texts)
    model = train(rows, vocabulary, n, shard_tokens)
    model.gains = None  # not sent to the tasks
    by = np.argsort(common_h)
    all_words = n + SMOOTH * (v + 1)
    others = float(vocabulary.counts[OTHER]) + SMOOTH * (different - (vocabulary.size - 3) + 1)
    shared = spark.sparkContext.broadcast((vocabulary, model, common_h[by], common_c[by]))
    end_base = np.log10((texts + SMOOTH) / all_words)

    def run(batches):
        vocab, model, hot, hot_n = shared.value
        held, size, chunk = [], 0, TaskContext.get().partitionId() << 24

        def flush():
            nonlocal chunk
            table = [np.concatenate(c) for c in zip(*(h[0] for h in held))]
            yield -1, chunk, pack([c.astype(k) for c, k in zip(table, _ROW)])
            rare = np.concatenate([h[1] for h in held])
            row = np.concatenate([h[2] + at for h, at in zip(held, np.cumsum([0] + [len(h[0][0]) for h in held]))])
            for bucket, p in scatter(bucket_of(rare, bits), [rare, row.astype("<u4")]):
                yield bucket, chunk, p
            chunk += 1

        def parts():
            nonlocal held, size
            for batch in batches:
                doc = batch.column("doc_id")
                null = doc.is_null().to_numpy(zero_copy_only=False)
                doc = doc.fill_null(0).to_numpy()
                out = batch.column("held_out").to_numpy(zero_copy_only=False)
                for x, y, w in batches_of(batch, "text", lower=True):
                    h, ids, first, one, two = _stream(w, vocab)
                    logp = model.log_probabilities(ids, one, two) / np.log(10)
                    row = w.row_of()
                    at = np.minimum(np.searchsorted(hot, h), max(len(hot) - 1, 0))
                    known = hot[at] == h if len(hot) else np.zeros(len(h), bool)
                    other = vocab.encode(h) == OTHER
                    log_c = np.log10(np.where(known, hot_n[at] if len(hot) else 0, 1) + SMOOTH)
                    log_c[~known] = 0
                    rows_n = w.rows
                    base = np.bincount(row, log_c - np.log10(all_words), rows_n) + end_base
                    score = np.add.reduceat(logp, first[:-1]) + np.bincount(row, np.where(other, log_c - np.log10(others), 0), rows_n)
                    tokens = w.counts + 1
                    held.append(([doc[x:y], null[x:y].astype(np.uint8), out[x:y].astype(np.uint8), tokens, np.bincount(row, known, rows_n).astype(np.int64) + (texts > 0),
                                  np.zeros(rows_n, np.int64), base, score], h[~known], row[~known]))
                    size += len(h) + rows_n
                    if size > CHUNK_TOKENS:
                        yield from flush()
                        held, size = [], 0
            if held:
                yield from flush()

        for bucket, c, p in parts():
            yield pa.record_batch([pa.array([bucket], pa.int32()), pa.array([c], pa.int64()), pa.array([p], pa.binary())], names=["bucket", "chunk", "payload"])

    sent = saved(rows.mapInArrow(run, "bucket int, chunk long, payload binary"), "scores")

    def answer(batches):
        """The log counts of rare words, summed for each text of a chunk."""

        def asked(held):
            keys, n_of, ask = [], [], []
            for c, p in held:
                if c < 0:
                    k, m = unpack(p, ["<u8", "<i8"])
                    keys.append(k)
                    n_of.append(m)
                else:
                    ask.append((c, *unpack(p, ["<u8", "<u4"])))
            keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            n_of = np.concatenate(n_of) if n_of else np.zeros(0, np.int64)
            for c, h, row in ask:
                at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                found = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                log_c = np.log10(np.where(found, n_of[at] if len(keys) else 0, 0) + SMOOTH)
                order = np.argsort(row, kind="stable")
                r = row[order]
                cut = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                yield c, pack([r[cut].astype("<u4"), np.add.reduceat(log_c[order], cut), np.add.reduceat(found[order].astype("<i8"), cut).astype("<u4")])

        now, held = None, []
        for batch in batches:
            for b, c, p in zip(batch.column("bucket").to_pylist(), batch.column("chunk").to_pylist(), batch.column("payload")):
                if b != now:
                    yield from _answers(asked(held))
                    now, held = b, []
                held.append((c, p.as_buffer().to_pybytes()))
        yield from _answers(asked(held))

    size = partitions(spark)
    known = counts.select("bucket", F.lit(-1).cast("long").alias("chunk"), "payload")
    asks = sent.where("bucket >= 0").union(known).repartition(size, "bucket").sortWithinPartitions("bucket")
    answers = asks.mapInArrow(answer, "chunk long, kind int, payload binary")
    both = answers.union(sent.where("bucket < 0").select("chunk", F.lit(0).alias("kind"), "payload"))

    def finish(batches):
        now, table = None, None

        def done():
            doc, null, out, tokens, found, _, base, score = table
            return pa.record_batch([pa.array(doc, mask=null.astype(bool)), pa.array(out.astype(bool)), pa.array(tokens), pa.array(found),
                                    pa.array(np.full(len(doc), n)), pa.array(base), pa.array(score)],
                                   names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for batch in batches:
            for c, kind, p in zip(batch.column("chunk").to_pylist(), batch.column("kind").to_pylist(), batch.column("payload")):
                raw = p.as_buffer().to_pybytes()
                if kind == 0:
                    if now is not None:
                        yield done()
                    now, table = c, [x.copy() for x in unpack(raw, _ROW)]
                    continue
                row, log_c, found = unpack(raw, ["<u4", "<f8", "<u4"])
                table[4][row] += found
                table[6][row] += log_c
                table[7][row] += log_c
        if now is not None:
            yield done()

    dealt = both.repartition(size, "chunk").sortWithinPartitions("chunk", "kind")
    return dealt.mapInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _answers(found) -> Iterator[pa.RecordBatch]:
    for c, p in found:
        yield pa.record_batch([pa.array([c], pa.int64()), pa.array([1], pa.int32()), pa.array([p], pa.binary())], names=["chunk", "kind", "payload"])
