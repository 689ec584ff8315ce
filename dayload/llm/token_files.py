"""Token-id files: flat unsigned integers, 64-bit document offsets, memory-mapped.

Layout of a written corpus (one pair of files for each partition, partitions
in ascending document order):

* ``part-00000.ids``: the ids of the partition's documents one after the
  other, little-endian, two bytes each when the vocabulary fits, else four;
* ``part-00000.idx``: ``b"TOKIDX01"``, the id width and the number of
  documents ``n`` as unsigned 64-bit integers, ``n + 1`` offsets into the ids
  (unsigned 64-bit), ``n`` document ids (signed 64-bit), ``n`` bytes that are
  1 where the document id is null.

A document's global start is its partition's base plus its local offset; bases
are the prefix sums of the partitions' sizes, so no task needs another's ids.

Defined results: a null text is an empty text (it has the end id alone); a null
id sorts first and stays null; rows that repeat an id are separate documents,
ordered by text (null first); no rows give no files' rows; other columns are
not read.  A retried task writes the same bytes and replaces its files whole.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORKER_CACHES, fresh_worker, partitions, saved
from .files import read_bytes, replace_file
from .unit_cache import UnitCache
from .words import find_words, lowered, slices, split_plain, text_buffer

MAGIC = b"TOKIDX01"
#: Letter runs that go through the tokenizer as one text.
JOINED = 256
_ENCODERS: dict[str, UnitCache] = {}
WORKER_CACHES["token_files"] = _ENCODERS.clear


def word_cache(tokenizer_path: str) -> UnitCache:
    """The worker's cache over a tokenizer of the tokenizers library whose ids never span white space."""
    if tokenizer_path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(tokenizer_path)
        tok.no_truncation()
        tok.no_padding()

        last = np.zeros(tok.get_vocab_size(with_added_tokens=True), bool)  # tokens that end a piece
        for t, i in tok.get_vocab(with_added_tokens=False).items():
            last[i] = t.endswith("</w>")

        def one_by_one(units: list[bytes]) -> list[list[int]]:
            return [e.ids for e in tok.encode_batch([u.decode("utf-8") for u in units], add_special_tokens=False)]

        def encode(units: list[bytes]) -> list[list[int]]:
            """Runs of letters are one piece each, so many go through the tokenizer as one text."""
            out: list = [None] * len(units)
            runs = [i for i, u in enumerate(units) if u.decode("utf-8").isalpha()]
            for a in range(0, len(runs), JOINED):
                at = runs[a:a + JOINED]
                ids = np.array(tok.encode(b" ".join([units[i] for i in at]).decode(), add_special_tokens=False).ids, np.int64)
                ends = np.flatnonzero(last[ids]) + 1
                if len(ends) == len(at) and ends[-1] == len(ids):
                    ids, ends = ids.tolist(), ends.tolist()
                    for i, x, y in zip(at, [0, *ends], ends):
                        out[i] = ids[x:y]
            rest = [i for i, ids in enumerate(out) if ids is None]
            for i, ids in zip(rest, one_by_one([units[i] for i in rest])):
                out[i] = ids
            return out

        _ENCODERS[tokenizer_path] = UnitCache(encode)
    return _ENCODERS[tokenizer_path]


def encode_column(column: pa.Array, cache: UnitCache, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, ids of each row) of slices of a text column, each row closed by ``end_id``."""
    data, offsets = text_buffer(column)
    for a, b in slices(offsets):
        words = find_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        raw = words.data
        if b"<|" not in raw.tobytes():  # the tokenizer ignores case but in special tokens
            raw = lowered(raw)
        start, end, first = split_plain(raw, words.start, words.end, words.first)
        ids, sizes = cache.gather(cache.index(raw, start, end))
        ends = np.concatenate([[0], np.cumsum(sizes)])[first]
        per_row = np.diff(ends)
        out = np.insert(ids, ends[1:], end_id)
        yield out, per_row + 1


def _index_bytes(width: int, offsets: np.ndarray, ids: list, null: list) -> bytes:
    head = MAGIC + np.array([width, len(ids)], "<u8").tobytes()
    return head + offsets.astype("<u8").tobytes() + np.array([0 if x is None else x for x in ids], "<i8").tobytes() + bytes(null)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, vocabulary: int, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the corpus under ``folder`` and return its manifest: part, path, n_docs, n_ids, base.

    The manifest has one row for each partition.  Documents are dealt by range
    of their id, so file order is document order.
    """
    spark = docs.sparkSession
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    kind = np.dtype(f"<u{width}")

    def write(batches):
        fresh_worker("token_files")
        part = TaskContext.get().partitionId()
        cache, doc_ids, sizes = word_cache(tokenizer_path), [], [np.zeros(1, np.int64)]
        path = f"{folder}/part-{part:05d}"

        def chunks():
            for batch in batches:
                doc_ids.extend(batch.column(0).to_pylist())
                for ids, per_row in encode_column(batch.column(1), cache, end_id):
                    sizes.append(per_row)
                    yield ids.astype(kind).tobytes()

        replace_file(f"{path}.ids", chunks())
        if not doc_ids:
            return
        offsets = np.cumsum(np.concatenate(sizes))
        replace_file(f"{path}.idx", [_index_bytes(width, offsets, doc_ids, [x is None for x in doc_ids])])
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([path]), pa.array([len(doc_ids)], pa.int64()),
                               pa.array([int(offsets[-1])], pa.int64())], names=["part", "path", "n_docs", "n_ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = saved(dealt.mapInArrow(write, "part int, path string, n_docs long, n_ids long"), "manifest").orderBy("part").collect()
    sizes = [r["n_ids"] for r in manifest]
    bases = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[:len(sizes)]
    return spark.createDataFrame([(r["part"], r["path"], r["n_docs"], r["n_ids"], int(b)) for r, b in zip(manifest, bases)],
                                 "part int, path string, n_docs long, n_ids long, base long")


def open_part(path: str) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, offsets, ids) of one partition; the ids are memory-mapped where the store allows."""
    head = read_bytes(f"{path}.idx")
    if bytes(head[:8]) != MAGIC:
        raise ValueError(f"{path}.idx is no token index")
    width, n = (int(x) for x in np.frombuffer(head, "<u8", 2, 8))
    offsets = np.frombuffer(head, "<u8", n + 1, 24).astype(np.int64)
    doc_ids = np.frombuffer(head, "<i8", n, 24 + 8 * (n + 1))
    null = np.frombuffer(head, np.uint8, n, 24 + 8 * (2 * n + 1))
    ids = np.frombuffer(read_bytes(f"{path}.ids"), f"<u{width}") if offsets[-1] else np.zeros(0, "<u4")
    return [None if z else int(x) for x, z in zip(doc_ids, null)], offsets, ids


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row for each stored document: doc_id, start, n_tokens, ids_crc32 (of its ids as 32-bit integers)."""
    spark: SparkSession = manifest.sparkSession

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                doc_ids, offsets, ids = open_part(path)
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(base + offsets[:-1]), pa.array(np.diff(offsets)),
                                       pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.repartition(partitions(spark)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
