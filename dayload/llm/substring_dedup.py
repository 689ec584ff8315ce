"""Repeated word spans by De Bruijn compaction.

Every window of ``k`` words is an edge of a De Bruijn graph over words.  An
edge that occurs in a document with a smaller id is a repeat there; repeats
that advance together in the document and in the source they repeat form one
nonbranching path, and paths are what is stored, joined and removed.

How the work is dealt:

* a window goes to the bucket of its minimizer, the smallest hash among its
  ``m``-word grams, so that consecutive windows travel together; grams that
  very many places share come last in that order, so they route only windows
  that consist of nothing else;
* a task first decides what it can by itself: of the windows it has read, only
  those of the smallest document are shuffled, the others are repeats already.
  A passage that a third of all documents share costs a bucket one entry for
  each task;
* a bucket finds the smallest document of each edge and compacts consecutive
  repeats; Spark joins the pieces of a path that lie in different buckets;
* a window is told from others by a 64-bit hash of its words, and the words of
  every path are compared with those at its source coordinates by a 128-bit
  digest.  Should two different windows ever share a hash, the comparison finds
  it, and the windows are sent again with 128 bits each.

Defined results: a null text has no words; a row with a null id repeats nothing
and is repeated by nobody; rows that share an id are never each other's source,
each row is judged by itself; equal rows get equal results; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_bits, bucket_of, count_locally, fresh_worker, heavy_hashes, partitions, payload_batches, planes, saved
from .words import batches_of, gram_starts, grams, hashed, mix

#: Words of a window, and of the grams that route it.
WINDOW, ROUTE = 13, 4
#: Windows that a task decides together.
CHUNK_WINDOWS = 500_000
#: A run of windows in one entry of a payload.
LONGEST_RUN = 255
#: Bits of a window's hash in the first try, and tries: the later ones have other hashes, of 128 bits.
NARROW, TRIES = 64, 4

SPANS = "doc_id long, disc long, start int, windows int, src_id long, src_disc long, src_start int"
_SPAN_NAMES = [c.split()[0] for c in SPANS.split(", ")]
_SPAN_KINDS = [np.dtype("<i8"), np.dtype("<i8"), np.dtype("<i4"), np.dtype("<i4"), np.dtype("<i8"), np.dtype("<i8"), np.dtype("<i4")]


def _unplanes(raw: np.ndarray, n: int, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(raw[:n * kind.itemsize].reshape(kind.itemsize, n).T).view(kind).ravel()


def _entries(docs, discs, pos, run, hashes: list[np.ndarray]) -> bytes:
    """One payload: count, then the columns of its runs, then the window hashes of all runs."""
    return b"".join([np.array([len(docs)], "<u4").tobytes(), planes(docs), planes(discs), planes(pos.astype("<i4")), run.astype(np.uint8).tobytes(),
                     *(h.astype("<u8").tobytes() for h in hashes)])


def _open_entries(payload: bytes):
    """docs, discs, pos, run, and as many hash columns as were packed."""
    raw = np.frombuffer(payload, np.uint8)
    n, at, out = int(np.frombuffer(payload, "<u4", 1)[0]), 4, []
    for kind in (np.dtype("<i8"), np.dtype("<i8"), np.dtype("<i4")):
        out.append(_unplanes(raw[at:], n, kind))
        at += n * kind.itemsize
    out.append(raw[at:at + n].astype(np.int64))
    hashes = np.frombuffer(raw[at + n:].tobytes(), "<u8")
    m = int(out[-1].sum())
    return out + [hashes[i:i + m] for i in range(0, len(hashes), m)]


def _identity(hashes: list[np.ndarray]) -> np.ndarray:
    """One value for each different window: the hash, or the rank of a pair of hashes."""
    if len(hashes) == 1:
        return hashes[0]
    order = np.lexsort(hashes[::-1])
    new = np.zeros(len(order), np.uint64)
    for h in hashes:
        held = h[order]
        new[1:] |= held[1:] != held[:-1]
    out = np.empty(len(order), np.uint64)
    out[order] = np.cumsum(new, dtype=np.uint64)
    return out


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        a = np.minimum(a[:len(a) - step], a[step:])
        have += step
    return a


def _paths(doc, disc, pos, src, src_disc, src_pos) -> list[np.ndarray]:
    """Runs in which the document's and the source's coordinate advance together (input in document order)."""
    if not len(doc):
        return [np.zeros(0, k) for k in _SPAN_KINDS]
    new = np.ones(len(doc), bool)
    new[1:] = ((pos[1:] != pos[:-1] + 1) | (src_pos[1:] != src_pos[:-1] + 1) | (doc[1:] != doc[:-1]) | (src[1:] != src[:-1])
               | (disc[1:] != disc[:-1]) | (src_disc[1:] != src_disc[:-1]))
    at = np.flatnonzero(new)
    n = np.diff(np.r_[at, len(doc)])
    return [a[at] if a is not None else n for a in (doc, disc, pos, None, src, src_disc, src_pos)]


def _span_batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c.astype(k)) for c, k in zip(columns, _SPAN_KINDS)], names=_SPAN_NAMES)


def _smallest(ident: np.ndarray, doc: np.ndarray, disc: np.ndarray, pos: np.ndarray):
    """For each window: the smallest document with the same window, and where the window starts there."""
    order = np.argsort(ident, kind="stable")
    held = ident[order]
    cut = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
    group = np.empty(len(ident), np.int64)
    group[order] = np.repeat(np.arange(len(cut)), np.diff(np.r_[cut, len(held)]))
    d = doc[order]
    least = np.minimum.reduceat(d, cut)
    sizes = np.diff(np.r_[cut, len(held)])
    # the first place among those of the smallest document, by (disc, position)
    first = d == np.repeat(least, sizes)
    big = np.int64(np.iinfo(np.int64).max)
    disc_of = np.minimum.reduceat(np.where(first, disc[order], big), cut)
    first &= disc[order] == np.repeat(disc_of, sizes)
    pos_of = np.minimum.reduceat(np.where(first, pos[order], big), cut)
    return least[group], disc_of[group], pos_of[group]


class _Chunk:
    """Windows of whole rows, decided as far as one task can, and packed by bucket."""

    def __init__(self, bits: int):
        self.bits, self.parts, self.n = bits, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.n += len(columns[0])

    def flush(self) -> Iterator[tuple[int, bytes]]:
        """Payloads: entries at bucket >= 0; local repeats at -1 - (some bucket)."""
        if not self.n:
            return
        doc, disc, pos, key, *hashes = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.n = [], 0
        src, src_disc, src_pos = _smallest(_identity(hashes), doc, disc, pos)
        gone = src < doc
        if gone.any():
            paths = _paths(*(a[gone] for a in (doc, disc, pos, src, src_disc, src_pos)))
            to = bucket_of(mix(paths[0].view(np.uint64)), self.bits)
            order = np.argsort(to, kind="stable")
            cut = np.flatnonzero(np.r_[True, to[order][1:] != to[order][:-1]])
            for lo, hi in zip(cut, np.r_[cut[1:], len(order)]):
                at = order[lo:hi]
                yield -1 - int(to[at[0]]), b"".join(planes(c[at].astype(k)) for c, k in zip(paths, _SPAN_KINDS))
        keep = ~gone
        doc, disc, pos, key, *hashes = (a[keep] for a in (doc, disc, pos, key, *hashes))
        if not len(doc):
            return
        new = np.ones(len(doc), bool)
        new[1:] = (key[1:] != key[:-1]) | (pos[1:] != pos[:-1] + 1) | (doc[1:] != doc[:-1]) | (disc[1:] != disc[:-1])
        at = np.flatnonzero(new)
        within = np.arange(len(doc)) - np.repeat(at, np.diff(np.r_[at, len(doc)]))
        at = np.flatnonzero(within % LONGEST_RUN == 0)
        run = np.diff(np.r_[at, len(doc)])
        to = bucket_of(mix(key[at]), self.bits)
        order = np.argsort(to, kind="stable")
        cut = np.flatnonzero(np.r_[True, to[order][1:] != to[order][:-1]])
        for lo, hi in zip(cut, np.r_[cut[1:], len(order)]):
            e = order[lo:hi]
            sizes = run[e]
            where = np.arange(sizes.sum()) + np.repeat(at[e] - (np.cumsum(sizes) - sizes), sizes)
            yield int(to[e[0]]), _entries(doc[at[e]], disc[at[e]], pos[at[e]], sizes, [h[where] for h in hashes])


def _rows(docs: DataFrame, id_col: str, text_col: str, extra: list[str] = ()) -> DataFrame:
    """doc_id, text, disc (and ``extra`` columns as one struct); ``disc`` tells rows of one id apart (0 where no id repeats)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       *([F.struct(*[F.col(c) for c in extra]).alias("extra")] if extra else []))
    again = rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    return rows.withColumn("disc", F.xxhash64(F.coalesce("text", F.lit(""))) if again else F.lit(0).cast("long"))


def route_heavy(rows: DataFrame, m: int, bits: int) -> np.ndarray:
    """The ``m``-grams that very many places share (all rows are counted)."""

    def count(batches):
        fresh_worker()
        held, n = [], 0

        def parts():
            nonlocal held, n
            for batch in batches:
                for _, _, w in batches_of(batch, "text"):
                    g = grams(hashed(w), m)[gram_starts(w, m)]
                    held.append(g)
                    n += len(g)
                    if n > 2 * CHUNK_WINDOWS:
                        yield from count_locally(held, bits, 2)
                        held, n = [], 0
            yield from count_locally(held, bits, 2)

        yield from payload_batches(parts())

    return heavy_hashes(rows.select("text").mapInArrow(count, "bucket int, payload binary"))


def repeated_pieces(rows: DataFrame, k: int = WINDOW, m: int = ROUTE, salt: int = 0) -> DataFrame:
    """Path pieces (``SPANS``): windows that also start in a document with a smaller id, compacted within a bucket."""
    spark = rows.sparkSession
    bits = bucket_bits(spark) + 1
    first = np.uint64((1 << NARROW) - 1)
    heavy = spark.sparkContext.broadcast(np.sort(route_heavy(rows, m, bits)))
    turn, second = np.uint64(0x9E3779B97F4A7C15 * salt % (1 << 64)), np.uint64(0x94D049BB133111EB)

    def send(batches):
        fresh_worker()
        chunk = _Chunk(bits)
        hot = heavy.value

        def parts():
            for batch in batches:
                ids, discs = batch.column("doc_id"), batch.column("disc").to_numpy()
                null = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                for a, _, w in batches_of(batch, "text"):
                    h = mix(hashed(w) ^ turn) if salt else hashed(w)
                    good = gram_starts(w, k)
                    if not len(good):
                        continue
                    small = grams(hashed(w) if salt else h, m)
                    rank = mix(small ^ turn) >> np.uint64(1)
                    if len(hot):
                        at = np.minimum(np.searchsorted(hot, small), len(hot) - 1)
                        rank |= (hot[at] == small).astype(np.uint64) << np.uint64(63)
                    key = _sliding_min(rank, k - m + 1)
                    row = w.row_of()[:len(good)]
                    good &= ~null[a + row]
                    row = row[good]
                    pos = np.flatnonzero(good) - w.first[row]
                    window = grams(h, k)[good]
                    hashes = [window, grams(mix(h ^ second), k)[good]] if salt else [window & first]
                    chunk.add(ids[a + row], discs[a + row], pos, key[good], *hashes)
                    if chunk.n >= CHUNK_WINDOWS:
                        yield from chunk.flush()
            yield from chunk.flush()

        yield from payload_batches(parts())

    def decide(held: list[bytes]):
        doc, disc, pos, run, *hashes = (np.concatenate(c) for c in zip(*(_open_entries(p) for p in held)))
        ident = _identity(hashes)
        within = np.arange(len(ident)) - np.repeat(np.cumsum(run) - run, run)
        doc, disc, pos = np.repeat(doc, run), np.repeat(disc, run), np.repeat(pos.astype(np.int64), run) + within
        src, src_disc, src_pos = _smallest(ident, doc, disc, pos)
        gone = src < doc
        return _span_batch(_paths(*(a[gone] for a in (doc, disc, pos, src, src_disc, src_pos))))

    def receive(batches):
        now, held = None, []
        for batch in batches:
            for b, p in zip(batch.column("bucket").to_pylist(), batch.column("payload")):
                p = p.as_buffer().to_pybytes()
                if b < 0:
                    n = len(p) // sum(k.itemsize for k in _SPAN_KINDS)
                    raw, at, out = np.frombuffer(p, np.uint8), 0, []
                    for kind in _SPAN_KINDS:
                        out.append(_unplanes(raw[at:], n, kind))
                        at += n * kind.itemsize
                    yield _span_batch(out)
                    continue
                if b != now:
                    if held:
                        yield decide(held)
                    now, held = b, []
                held.append(p)
        if held:
            yield decide(held)

    sent = rows.mapInArrow(send, "bucket int, payload binary")
    dealt = sent.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(receive, SPANS)


def joined_paths(pieces: DataFrame) -> DataFrame:
    """Path pieces that continue each other in the document and in the source become one path."""
    along = Window.partitionBy("doc_id", "disc", "src_id", "src_disc", F.col("start") - F.col("src_start")).orderBy("start")
    marked = pieces.withColumn("new", F.when(F.lag(F.col("start") + F.col("windows")).over(along) == F.col("start"), 0).otherwise(1))
    numbered = marked.withColumn("path", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    by = ["doc_id", "disc", "src_id", "src_disc", (F.col("start") - F.col("src_start")).alias("shift"), "path"]
    paths = numbered.groupBy(*by).agg(F.min("start").alias("start"), F.sum("windows").cast("int").alias("windows"), F.min("src_start").alias("src_start"))
    return paths.select(*_SPAN_NAMES)


def _digest(words: list[bytes], start: int, n: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[start:start + n]), digest_size=16).digest()


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
_SEEN = pa.list_(pa.struct([("id", pa.int64()), ("disc", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("digest", pa.binary())]))


def without_repeats(docs: DataFrame, render: Callable, schema: str, extra: list[str] = (), k: int = WINDOW,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``render(text, words, kept)`` of every row (``kept``: a flag for each word, None if all stay), beside its id.

    Runs the whole operator: finds the paths, marks their words, and compares
    every path with its source in the same pass over the texts.  ``extra``
    columns come back as one struct of that name.
    """
    fields = [c.split() for c in schema.split(", ")]
    rows = _rows(docs, id_col, text_col, extra)
    for salt in range(TRIES):
        paths = saved(joined_paths(repeated_pieces(rows.select("doc_id", "disc", "text"), k, min(ROUTE, k), salt)), "paths")
        own = paths.groupBy("doc_id", "disc").agg(F.collect_list(F.struct("start", "windows", "src_id", "src_disc", "src_start")).alias("own"))
        asked = (paths.select(F.col("src_id").alias("doc_id"), F.col("src_disc").alias("disc"), "src_start", "windows").distinct()
                 .groupBy("doc_id", "disc").agg(F.collect_list(F.struct("src_start", "windows")).alias("asked")))
        joined = rows.join(own.join(asked, ["doc_id", "disc"], "full_outer"), ["doc_id", "disc"], "left")
        kept_extra = [f"extra {dict(rows.dtypes)['extra']}"] if extra else []

        def apply(batches):
            for batch in batches:
                ids, discs = batch.column("doc_id").to_pylist(), batch.column("disc").to_pylist()
                owns, asks, texts = batch.column("own").to_pylist(), batch.column("asked").to_pylist(), batch.column("text")
                out, seen = [], []
                for i, (mine, ask) in enumerate(zip(owns, asks)):
                    text = texts[i].as_py()
                    words = (text or "").encode("utf-8").split()
                    kept, notes = None, []
                    if mine:
                        gone = np.zeros(len(words) + 1, np.int32)
                        for p in mine:
                            n = p["windows"] + k - 1
                            gone[p["start"]] += 1
                            gone[p["start"] + n] -= 1
                            notes.append((p["src_id"], p["src_disc"], p["src_start"], p["windows"], _digest(words, p["start"], n)))
                        kept = np.cumsum(gone)[:-1] == 0
                    notes += [(ids[i], discs[i], p["src_start"], p["windows"], _digest(words, p["src_start"], p["windows"] + k - 1)) for p in ask or ()]
                    out.append(render(text, words, kept))
                    seen.append([dict(zip(("id", "disc", "start", "windows", "digest"), n)) for n in notes] or None)
                columns = [pa.array(c, _ARROW[t]) for c, (_, t) in zip(zip(*out), fields)] if out else [pa.array([], _ARROW[t]) for _, t in fields]
                yield pa.record_batch([batch.column("doc_id"), *([batch.column("extra")] if extra else []), *columns, pa.array(seen, _SEEN)],
                                      names=["doc_id", *(["extra"] if extra else []), *(n for n, _ in fields), "seen"])

        result = ["doc_id long", *kept_extra, schema, "seen array<struct<id:bigint,disc:bigint,start:int,windows:int,digest:binary>>"]
        done = saved(joined.mapInArrow(apply, ", ".join(result)), "deduped")
        checks = done.where("seen is not null").select(F.inline("seen"))
        wrong = (checks.groupBy("id", "disc", "start", "windows").agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
                 .where("a <> b").limit(1).count())
        if not wrong:
            return done.drop("seen")
    raise RuntimeError("paths and their sources differ under every hash")


def _counts(text, words, kept):
    left = words if kept is None else list(compress(words, kept))
    return len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()


def kept_digests(docs: DataFrame, k: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) of every row."""
    return without_repeats(docs, _counts, "n_words long, n_removed long, kept_sha256 string", k=k, id_col=id_col, text_col=text_col)


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _cut(text, words, kept):
    """The text without its repeats: kept runs of words as they stood, joined by one space; untouched if nothing repeats."""
    if text is None or kept is None or kept.all():
        return (text,)
    raw = text.encode("utf-8")
    spans = [m.span() for m in _WORD.finditer(raw)]
    edge = np.flatnonzero(np.diff(np.r_[False, kept, False].astype(np.int8)))
    runs = [raw[spans[a][0]:spans[b - 1][1]] for a, b in zip(edge[::2], edge[1::2])]
    return (b" ".join(runs).decode("utf-8"),)


def dedup_texts(docs: DataFrame, k: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its repeats cut out of the text; the other columns as they were."""
    names = docs.columns
    safe = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    extra = [c for c in safe.columns if c != text]
    done = without_repeats(safe, _cut, "kept_text string", extra, k, key, text)
    return done.select(*[F.col("kept_text" if f"c{i}" == text else f"extra.c{i}").alias(c) for i, c in enumerate(names)])
