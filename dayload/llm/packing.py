"""Best-fit packing of documents into sequences by hierarchical residual packing.

Every document becomes its token ids and one end id.  Only documents longer
than a sequence are cut, into whole sequences; the first piece takes the rest.
Pieces are packed in rounds:

* a task packs what it has read by best fit, largest piece first, in groups of
  bounded size; bins that are nearly full leave;
* bins that are not nearly full are items of the next round: they keep what
  they hold and are dealt by hash into fewer, again bounded, groups, where best
  fit puts whole bins together;
* before a round, bins leave that no remaining item fits into (one minimum over
  all of them decides); the tree ends with one group, or when a round of as
  many groups as the last one joins hardly anything.

A bin carries its pieces, so a round shuffles the underfull bins once and there
is no join back.  Within a group best fit leaves at most one bin that is half
empty, so few items are left after the first rounds, whatever the input.

Defined results: a null text is an empty text (one piece, the end id alone); a
null id stays null; rows that repeat an id or a text are documents of their own;
ties go to the earlier piece of the group; an empty table gives no rows; other
columns are not read.  Sequence ids are unique, not dense.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_lexicon import Merges, _joined_rows, _slices, units_of
from .common import WORKER_CACHES, fresh_worker, partitions, saved
from .unit_cache import UnitCache

#: Tokens of a sequence.
CAPACITY = 2048
#: A bin with no more free tokens than this leaves at once.
SLACK = 8
#: Pieces, and bytes of bins, that are packed together.
GROUP_ITEMS, GROUP_BYTES = 1 << 16, 48 << 20
#: Groups that meet in one of the next round.
FAN = 8
#: Units that go through the tokenizer as one text.
JOINED = 256

ITEM = np.dtype([("doc", "<i8"), ("null", "u1"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")])
BINS = "sequence_id long, fill int, done boolean, items binary, ids binary"
_BINS = pa.schema([("sequence_id", pa.int64()), ("fill", pa.int32()), ("done", pa.bool_()), ("items", pa.binary()), ("ids", pa.binary())])
_ENCODERS: dict[str, tuple[Merges, UnitCache]] = {}
WORKER_CACHES["packing"] = _ENCODERS.clear


def library_encoder(tokenizer_path: str) -> tuple[Merges, UnitCache]:
    """The worker's cache over the tokenizers library, and the file's vocabulary."""
    if tokenizer_path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        merges, tok = Merges(tokenizer_path), Tokenizer.from_file(tokenizer_path)
        tok.no_truncation()
        tok.no_padding()
        opens = np.zeros(max(merges.token) + 1, bool)  # tokens that start with a space
        opens[[i for i, t in merges.token.items() if t[:1] == b" "]] = True

        def encode(units: list[bytes]) -> list[list[int]]:
            """A space and ASCII letters are one piece, so many of them go through the library as one text."""
            out: list = [None] * len(units)
            runs = [i for i, u in enumerate(units) if u[:1] == b" " and u[1:].isalpha()]
            for a in range(0, len(runs), JOINED):
                at = runs[a:a + JOINED]
                ids = np.array(tok.encode(b"".join([units[i] for i in at]).decode(), add_special_tokens=False).ids, np.int64)
                begins = np.flatnonzero(opens[ids])
                if len(begins) == len(at) and begins[0] == 0:
                    flat, cuts = ids.tolist(), [*begins.tolist(), len(ids)]
                    for i, x, y in zip(at, cuts, cuts[1:]):
                        out[i] = flat[x:y]
            rest = [i for i, ids in enumerate(out) if ids is None]
            for i, e in zip(rest, tok.encode_batch([units[i].decode("utf-8") for i in rest], add_special_tokens=False)):
                out[i] = e.ids
            return out

        _ENCODERS[tokenizer_path] = merges, UnitCache(encode)
    return _ENCODERS[tokenizer_path]


def encoded_rows(column: pa.Array, tokenizer_path: str, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, ids of each row) of slices of a text column, each row closed by ``end_id``."""
    merges, cache = library_encoder(tokenizer_path)
    for words, off in _slices(column):
        start, end, first = units_of(words, off)
        bad = np.flatnonzero(_joined_rows(words, merges))
        if not len(bad):
            ids, sizes = cache.gather(cache.index(words.data, start, end))
            ends = np.concatenate([[0], np.cumsum(sizes)])[first]
            yield np.insert(ids, ends[1:], end_id).astype("<u4"), np.diff(ends) + 1
            continue
        odd, parts = set(bad.tolist()), []  # rows whose units can't be taken apart go through the library whole
        for r in range(words.rows):
            if r in odd:
                ids = cache.encode([words.data[off[r]:off[r + 1]].tobytes()])[0]
            else:
                ids = cache.gather(cache.index(words.data, start[first[r]:first[r + 1]], end[first[r]:first[r + 1]]))[0]
            parts.append(np.append(np.asarray(ids, "<u4"), np.uint32(end_id)))
        yield np.concatenate(parts).astype("<u4"), np.array([len(p) for p in parts], np.int64)


def cut_pieces(ids: np.ndarray, sizes: np.ndarray, docs: list, capacity: int = CAPACITY) -> np.ndarray:
    """The pieces (``ITEM``) of rows of ``sizes`` ids each; only a first piece is shorter than ``capacity`` where a row is cut."""
    n = -(-sizes // capacity)
    row = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    head = sizes - (n - 1) * capacity
    out = np.zeros(len(row), ITEM)
    out["doc"] = np.array([0 if d is None else d for d in docs], np.int64)[row]
    out["null"] = np.array([d is None for d in docs], np.uint8)[row]
    out["piece"] = piece
    out["start"] = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
    out["length"] = np.where(piece > 0, capacity, head[row])
    raw, at = memoryview(ids.tobytes()), (np.cumsum(sizes) - sizes)[row] + out["start"]
    out["crc"] = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + out["length"]).tolist())]
    return out


def best_fit(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of items: each item, largest first, goes where it leaves the least room; ties to the earlier item."""
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_bins, bins = 0, []  # bit f of open_bins: a bin with f free tokens is open
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        fits = open_bins >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            held = by_free[free].pop()
            if not by_free[free]:
                open_bins ^= 1 << free
            bins[held].append(i)
        else:
            held, free = len(bins), capacity
            bins.append([i])
        if free > size:
            by_free[free - size].append(held)
            open_bins |= 1 << (free - size)
    return bins


class _Packer:
    """Groups of items of one task, packed and handed on as ``BINS`` rows."""

    def __init__(self, level: int, capacity: int, slack: int):
        self.base = level << 57 | TaskContext.get().partitionId() << 32
        self.capacity, self.slack, self.bins = capacity, slack, 0
        self.clear()

    def clear(self) -> None:
        self.sizes: list[int] = []
        self.items: list[bytes] = []
        self.ids: list[bytes] = []
        self.held = 0

    def add(self, size: int, item: bytes, ids: bytes) -> None:
        self.sizes.append(size)
        self.items.append(item)
        self.ids.append(ids)
        self.held += len(item) + len(ids)

    def full(self) -> bool:
        return len(self.sizes) >= GROUP_ITEMS or self.held >= GROUP_BYTES

    def packed(self) -> Iterator[pa.RecordBatch]:
        bins = best_fit(self.sizes, self.capacity)
        for a in range(0, len(bins), 2048):
            some = bins[a:a + 2048]
            fill = [sum(self.sizes[i] for i in b) for b in some]
            yield pa.record_batch([
                pa.array([self.base + self.bins + j for j in range(len(some))], pa.int64()), pa.array(fill, pa.int32()),
                pa.array([self.capacity - f <= self.slack for f in fill]),
                pa.array([b"".join([self.items[i] for i in b]) for b in some], pa.binary()),
                pa.array([b"".join([self.ids[i] for i in b]) for b in some], pa.binary())], schema=_BINS)
            self.bins += len(some)
        self.clear()


def local_bins(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, carry: bool, slack: int = SLACK,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first round: every task encodes, cuts and packs what it reads (``BINS`` rows)."""

    def run(batches):
        fresh_worker("packing")
        packer = _Packer(0, capacity, slack)
        for batch in batches:
            docs_of, row = batch.column(0).to_pylist(), 0
            for ids, sizes in encoded_rows(batch.column(1), tokenizer_path, end_id):
                pieces = cut_pieces(ids, sizes, docs_of[row:row + len(sizes)], capacity)
                row += len(sizes)
                raw, at, w = pieces.tobytes(), 0, ITEM.itemsize
                for j, n in enumerate(pieces["length"].tolist()):
                    packer.add(n, raw[w * j:w * j + w], ids[at:at + n].tobytes() if carry else b"")
                    at += n
                if packer.full():
                    yield from packer.packed()
        yield from packer.packed()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, BINS)


def merged_bins(bins: DataFrame, groups: int, level: int, capacity: int, slack: int = SLACK) -> DataFrame:
    """A later round: bins are items, dealt by hash into ``groups`` and packed group by group."""

    def run(batches):
        packer, now = _Packer(level, capacity, slack), None
        for batch in batches:
            for group, size, item, ids in zip(*(batch.column(c).to_pylist() for c in ("group", "fill", "items", "ids"))):
                if now is not None and (group != now or packer.full()):
                    yield from packer.packed()
                now = group
                packer.add(size, item, ids)
        yield from packer.packed()

    dealt = bins.select(F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("group"), "fill", "items", "ids")
    n = min(groups, partitions(bins.sparkSession))
    return dealt.repartition(n, "group").sortWithinPartitions("group", "fill", "items").mapInArrow(run, BINS)


def packed_bins(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, carry: bool = False,
                group_items: int = GROUP_ITEMS, slack: int = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All bins (``BINS``) of the tree of rounds."""
    bins = saved(local_bins(docs, tokenizer_path, capacity, end_id, carry, slack, id_col, text_col), "bins")
    left, finished = bins.where("not done"), [bins.where("done")]
    before, level = None, 0
    while True:
        n, least, size = left.agg(F.count("*"), F.min("fill"), F.sum(F.length("items") + F.length("ids"))).first()
        if not n:
            break
        # no item is smaller than the least one, so these can't be joined any more
        finished.append(left.where(F.col("fill") > capacity - least))
        left = left.where(F.col("fill") <= capacity - least)
        if before is not None and (before[0] == 1 or n > 0.999 * before[1] and before[0] == before[2]):
            finished.append(left)
            break
        floor = max(1, -(-n // group_items), -(-size // GROUP_BYTES))
        groups = max(floor, (before[0] if before else max(floor, partitions(docs.sparkSession))) // FAN)
        level += 1
        bins = saved(merged_bins(left, groups, level, capacity, slack), "bins")
        before = groups, n, floor
        left = bins.where("not done")
        finished.append(bins.where("done"))
    return reduce(DataFrame.union, finished)


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, group_items: int = GROUP_ITEMS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece (``PLACED``): where it lies in its document, and its sequence and place there."""

    def rows(batches):
        for batch in batches:
            raw = [np.frombuffer(p, ITEM) for p in batch.column("items").to_pylist()]
            if not raw:
                continue
            n = np.array([len(r) for r in raw], np.int64)
            all_, seq = np.concatenate(raw), np.repeat(batch.column("sequence_id").to_numpy(), n)
            length = all_["length"].astype(np.int64)
            ends = np.cumsum(length)
            offset = ends - length - np.repeat((ends - length)[np.cumsum(n) - n], n)
            yield pa.record_batch([pa.array(all_["doc"], mask=all_["null"].astype(bool)), pa.array(all_["piece"]), pa.array(all_["start"]), pa.array(length),
                                   pa.array(all_["crc"].astype(np.int64)), pa.array(seq), pa.array(offset)], names=[c.split()[0] for c in PLACED.split(", ")])

    bins = packed_bins(docs, tokenizer_path, capacity, end_id, False, group_items, SLACK, id_col, text_col)
    return bins.select("sequence_id", "items").mapInArrow(rows, PLACED)


def packed_sequences(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sequences themselves: sequence_id, ids (array of int), doc_ids and lengths of the pieces in their order."""

    def rows(batches):
        for batch in batches:
            held = [np.frombuffer(p, ITEM) for p in batch.column("items").to_pylist()]
            ids = [np.frombuffer(p, "<u4").astype(np.int32) for p in batch.column("ids").to_pylist()]
            docs_ = [[None if z else int(d) for d, z in zip(h["doc"], h["null"])] for h in held]
            yield pa.record_batch([batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(docs_, pa.list_(pa.int64())),
                                   pa.array([h["length"] for h in held], pa.list_(pa.int32()))], names=["sequence_id", "ids", "doc_ids", "lengths"])

    bins = packed_bins(docs, tokenizer_path, capacity, end_id, True, id_col=id_col, text_col=text_col)
    return bins.select("sequence_id", "items", "ids").mapInArrow(rows, "sequence_id long, ids array<int>, doc_ids array<long>, lengths array<int>")
