"""What the operators share: partition counts, scratch tables, packed shuffles.

A packed shuffle moves numpy columns instead of one row per element: a task
sorts its elements by bucket and emits one row ``(bucket, payload)`` for each
bucket it has elements of; Spark shuffles those rows by bucket, and the
receiving task concatenates the payloads of one bucket at a time.  The number
of buckets follows the session's shuffle partitions, so a bucket keeps its size
when data and partitions grow together.  Elements are aggregated inside the
sending task first, so a hot key costs one element per task.
"""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

PAYLOAD = "bucket int, payload binary"
_PAYLOAD = pa.schema([("bucket", pa.int32()), ("payload", pa.binary())])


#: What operators keep in a Python worker between tasks: name, and how to drop it.
WORKER_CACHES: dict[str, Callable[[], object]] = {}


def give_back() -> None:
    """Return what this worker has freed to the system; the C heap and Arrow's pool keep it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library than glibc
        pass


def fresh_worker(keep: str = "") -> None:
    """At the start of a task: drop what other operators left in this worker, which outlives their stages."""
    held = [drop for name, drop in WORKER_CACHES.items() if name != keep]
    for drop in held:
        drop()
    if held:
        gc.collect()
    give_back()


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver found it.

    Needed when the driver added the repository to its own path; a package
    installed on the executors or passed with ``--py-files`` works without it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([*have, root])
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_bits(spark: SparkSession) -> int:
    """log2 of the bucket count: about four buckets for a shuffle partition."""
    return max(4, (4 * partitions(spark) - 1).bit_length())


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unique_names(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, or a variant of it that none of ``taken`` has (case folded)."""
    low = {t.lower() for t in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def planes(a: np.ndarray) -> bytes:
    """The bytes of an array by significance, which compresses where values are small or close."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def pack(arrays: Iterable[np.ndarray]) -> bytes:
    """Columns of equal length as one payload."""
    return b"".join(planes(a) for a in arrays)


def unpack(payload: bytes, dtypes: list) -> list[np.ndarray]:
    kinds = [np.dtype(d) for d in dtypes]
    n, at, out = len(payload) // sum(k.itemsize for k in kinds), 0, []
    for k in kinds:
        raw = np.frombuffer(payload, np.uint8, n * k.itemsize, at)
        out.append(np.ascontiguousarray(raw.reshape(k.itemsize, n).T).view(k).ravel())
        at += n * k.itemsize
    return out


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """The top ``bits`` of 64-bit hashes."""
    return (keys >> np.uint64(64 - bits)).astype(np.int32)


def scatter(bucket: np.ndarray, arrays: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed columns) for each bucket that has elements."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    held = bucket[order]
    cut = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
    arrays = [a[order] for a in arrays]
    for lo, hi in zip(cut, np.r_[cut[1:], len(held)]):
        yield int(held[lo]), pack([a[lo:hi] for a in arrays])


def payload_batches(parts: Iterable[tuple[int, bytes]], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ``PAYLOAD`` rows."""
    ids, data = [], []
    for b, p in parts:
        ids.append(b)
        data.append(p)
        if len(ids) == rows:
            yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(data, pa.binary())], schema=_PAYLOAD)
            ids, data = [], []
    if ids:
        yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(data, pa.binary())], schema=_PAYLOAD)


def each_bucket(batches: Iterator[pa.RecordBatch], dtypes: list) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(bucket, its columns) from ``PAYLOAD`` rows that come sorted by bucket; one bucket is held at a time."""
    now, held = None, []

    def joined() -> list[np.ndarray]:
        columns = zip(*(unpack(p, dtypes) for p in held))
        return [np.concatenate(c) for c in columns]

    for batch in batches:
        for b, p in zip(batch.column(0).to_pylist(), batch.column(1)):
            if b != now:
                if held:
                    yield now, joined()
                now, held = b, []
            held.append(p.as_buffer().to_pybytes())
    if held:
        yield now, joined()


def by_bucket(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Shuffle ``PAYLOAD`` rows by bucket and run ``fn`` over each partition, sorted by bucket."""
    n = partitions(df.sparkSession)
    return df.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(fn, schema)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 1 << 15) -> Iterator[pa.Table]:
    """Tables that hold only whole groups of equal ``key`` from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        last = np.flatnonzero(keys != keys[-1])
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        size = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def sums_by_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct hashes, their summed counts) of each bucket of (hash, count) payloads."""
    for _, (keys, counts) in each_bucket(batches, ["<u8", "<u4"]):
        order = np.argsort(keys)
        keys = keys[order]
        cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        yield keys[cut], np.add.reduceat(counts[order].astype(np.int64), cut)


def heavy_hashes(counted: DataFrame, shift: int = 20, least: int = 8) -> np.ndarray:
    """The hashes that many rows hold, most frequent last, from (hash, count) payloads.

    ``counted`` may leave out hashes that a task saw once; totals come as hash
    0 rows of bucket -1.  A hash is heavy from ``total >> shift`` occurrences
    on, so at most ``2 ** shift`` hashes (8 MB) reach the driver whatever the
    input size.  The list only orders work: results never depend on it.
    """
    counted = saved(counted, "counted")
    spark = counted.sparkSession

    def total(batches):
        n = 0
        for batch in batches:
            for p in batch.column(1):
                n += int(unpack(p.as_buffer().to_pybytes(), ["<u8", "<u4"])[1].sum())
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    n = counted.where("bucket < 0").mapInArrow(total, "n long").agg(F.sum("n")).first()[0] or 0
    floor = max(least, n >> shift)

    def heavy(batches):
        for keys, counts in sums_by_hash(batches):
            keep = counts >= floor
            if keep.any():
                yield pa.record_batch([pa.array(keys[keep].view(np.int64)), pa.array(counts[keep])], names=["h", "n"])

    found = by_bucket(counted.where("bucket >= 0"), heavy, "h long, n long").toArrow()
    keys = found.column("h").to_numpy().view(np.uint64) if found.num_rows else np.zeros(0, np.uint64)
    counts = found.column("n").to_numpy() if found.num_rows else np.zeros(0, np.int64)
    return keys[np.lexsort((keys, counts))]


def count_locally(hashes: list[np.ndarray], bits: int, least: int) -> Iterator[tuple[int, bytes]]:
    """(hash, count) payloads of what a task has gathered, and the total as bucket -1."""
    if not hashes:
        return
    keys = np.concatenate(hashes)
    if not len(keys):
        return
    keys.sort()
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.diff(np.r_[cut, len(keys)]).astype("<u4")
    yield -1, pack([np.zeros(1, "<u8"), np.array([len(keys)], "<u4")])
    keep = counts >= least
    keys = keys[cut][keep]
    yield from scatter(bucket_of(keys, bits), [keys, counts[keep]])
