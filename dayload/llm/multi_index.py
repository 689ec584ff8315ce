"""Nearest neighbours by inner product through an inverted multi-index.

Both halves of a vector are quantised by a codebook of their own, so a pair of
centroids names a cell.  A query ranks the centroids of each half and walks
centroid pairs by their summed score with a heap, best pair first, until the
cells it has met hold the share of all vectors that the index was calibrated
to; the vectors of those cells are reranked by the exact inner product.

The codebooks are fitted on a bounded sample; every vector is indexed.  The
share is calibrated on the same sample: what it takes there to find ``RECALL``
of the true neighbours.  Data with clusters needs few cells; data without any
structure needs many, and then the search is wide rather than wrong.

Cells lie in units of about ``UNIT`` vectors (a larger cell has several units);
a query is sent, with its list of cells, to the units that hold any of them,
and each unit returns its nearest few; queries pass a unit's vectors in blocks.
Equal vectors are indexed once, with
their smallest ids (no more can be among the nearest), and equal queries are
searched once.

Defined results: vectors that are null, all zero, hold a null or non-finite
component, or have another length than most take no part, and neither do rows
with a null id; a vec_id with several different vectors counts with its
smallest one; vectors of one component are searched like any other; repeated rows count once; fewer candidates than asked for are all
returned; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import importable, partitions, saved, whole_groups

#: Neighbours asked for; every how manieth id is a query.
NEAREST, EVERY = 20, 20
#: Vectors and queries of the sample; recall that the share is calibrated to, and the least share.
SAMPLE, PROBES, RECALL, LEAST = 20_000, 200, 0.97, 0.02
#: Vectors of a unit; a cell's vectors on average; centroids of a half at most.
UNIT, CELL, MOST = 4_000, 50, 1024
ROUNDS = 12


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v of the vectors that take part, one for each id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    good = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(good)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """h, v, ids: each different vector with its ``keep`` smallest ids, ascending."""
    by = Window.partitionBy("h", "v").orderBy("vec_id")
    ranked = rows.withColumn("h", F.xxhash64("v")).withColumn("r", F.row_number().over(by)).where(F.col("r") <= keep)
    return ranked.groupBy("h", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def by_hash(points: DataFrame, n: int) -> DataFrame:
    """The points of the least hashes, a few more than ``SAMPLE`` of the ``n``, so that no partition sends a sample of its own."""
    share = 1.1 * SAMPLE / n
    return points if share >= 1 else points.where(F.xxhash64("h") < int(-(1 << 63) + share * (1 << 64)))


def _kmeans(x: np.ndarray, k: int) -> np.ndarray:
    rng = np.random.default_rng(5)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        at = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        for i in range(k):
            held = x[at == i]
            if len(held):
                c[i] = held.mean(0)
    return c


def _walk(a: np.ndarray, b: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells (i * len(b) + j) by falling a[i] + b[j] until they hold ``enough`` vectors; empty cells are passed by."""
    order_a, order_b = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
    sa, sb, k = a[order_a].tolist(), b[order_b].tolist(), len(b)
    heap, reached, out, have = [(-(sa[0] + sb[0]), 0, 0)], [0] * len(a), [], 0
    while heap and have < enough:
        _, i, j = heapq.heappop(heap)
        cell = order_a[i] * k + order_b[j]
        if counts[cell]:
            out.append(cell)
            have += counts[cell]
        # a pair follows when both pairs before it have been met, so each is pushed once
        reached[i] = j + 1
        if i + 1 < len(sa) and reached[i + 1] == j:
            heapq.heappush(heap, (-(sa[i + 1] + sb[j]), i + 1, j))
        if j + 1 < k and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (-(sa[i] + sb[j + 1]), i, j + 1))
    return out


class Codebooks:
    def __init__(self, sample: np.ndarray, n: int, nearest: int):
        """Fit on ``sample`` for ``n`` vectors in all, and find the share of vectors to visit."""
        x = sample.astype(np.float64)
        k = int(min(MOST, max(2, round((n / CELL) ** 0.5)), len(x)))
        self.cut = x.shape[1] // 2
        self.first, self.second = _kmeans(x[:, :self.cut], k), _kmeans(x[:, self.cut:], k)
        probes = x[np.linspace(0, len(x) - 1, min(PROBES, len(x))).astype(int)]
        truth = np.argsort(-(probes @ x.T), axis=1)[:, :nearest + 1]
        cells = self.cells(x)
        counts = np.bincount(cells, minlength=k * k)
        a, b = probes[:, :self.cut] @ self.first.T, probes[:, self.cut:] @ self.second.T
        needed, place = [], np.empty(k * k, np.int64)
        for i in range(len(probes)):  # one row of k * k cells at a time
            order = np.argsort(-(a[i][:, None] + b[i][None, :]).ravel(), kind="stable")
            place[order] = np.arange(k * k)
            needed.append(np.cumsum(counts[order])[place[cells[truth[i]]]])
        self.share = float(min(1.0, max(LEAST, np.quantile(needed, RECALL) / len(x))))

    def cells(self, x: np.ndarray) -> np.ndarray:
        near = lambda v, c: np.argmin((c * c).sum(1) - 2 * v @ c.T, axis=1)
        return near(x[:, :self.cut], self.first) * len(self.second) + near(x[:, self.cut:], self.second)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten() if not isinstance(column, pa.ChunkedArray) else pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit_vectors(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, list[list[int]], np.ndarray]:
    """Vectors of a unit, the cell, all ids and the least id of each."""
    ids = table.column("ids").to_pylist()
    return _matrix(table.column("v"), width), np.array([c[0] for c in table.column("cells").to_pylist()]), ids, np.array([i[0] for i in ids])


def _nearest_in_unit(unit: tuple[np.ndarray, np.ndarray, list[list[int]], np.ndarray], queries: pa.RecordBatch, width: int, k: int) -> pa.RecordBatch:
    """The ``k`` + 1 nearest of each query among the unit's vectors in the query's cells."""
    x, cell, ids, least = unit
    y, met, who = _matrix(queries.column("v"), width), queries.column("cells").to_pylist(), [i[0] for i in queries.column("ids").to_pylist()]
    reps, found, scores = [], [], []
    for a in range(0, len(y), 256):
        rough = y[a:a + 256] @ x.T
        for i in range(len(rough)):
            s = np.where(np.isin(cell, met[a + i]), rough[i], -np.inf)
            top = np.argpartition(-s, 2 * k)[:2 * k + 1] if len(s) > 2 * k + 1 else np.arange(len(s))
            # all that could tie with the last one kept, but for rounding
            top = np.flatnonzero(s >= np.partition(s[top], max(0, len(top) - k - 1))[max(0, len(top) - k - 1)] - 1e-9 * max(1.0, float(np.abs(rough[i]).max())))
            top = top[np.isfinite(s[top])]
            exact = (x[top] * y[a + i]).sum(axis=1)
            order = np.lexsort((least[top], -exact))[:k + 1]
            pairs = sorted(((-exact[o], j) for o in order for j in ids[top[o]]))[:k + 1]
            reps += [who[a + i]] * len(pairs)
            found += [j for _, j in pairs]
            scores += [-e for e, _ in pairs]
    return pa.record_batch([pa.array(reps, pa.int64()), pa.array(found, pa.int64()), pa.array(scores, pa.float64())], names=["rep", "vec_id", "score"])


def nearest(vectors: DataFrame, k: int = NEAREST, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for every id divisible by ``every``."""
    spark = importable(vectors.sparkSession)
    out_schema = "query_id long, rank int, vec_id long, score double"
    rows = saved(usable(vectors, id_col, vector_col).withColumn("h", F.xxhash64("v")), "vectors")
    points = saved(distinct_vectors(rows.select("vec_id", "v"), k + 1), "points")
    n = points.count()
    if not n:
        return spark.createDataFrame([], out_schema)
    sample = np.array([r["v"] for r in by_hash(points, n).orderBy(F.xxhash64("h"), "h").limit(SAMPLE).select("v").collect()])
    width = sample.shape[1]
    books = spark.sparkContext.broadcast(Codebooks(sample, n, k))

    def place(batches):
        for batch in batches:
            cells = books.value.cells(_matrix(batch.column("v"), width)) if batch.num_rows else np.zeros(0, np.int64)
            yield batch.append_column("cell", pa.array(cells.astype(np.int32)))

    kind = dict(points.dtypes)["v"]
    placed = saved(points.mapInArrow(place, f"h long, v {kind}, ids array<long>, cell int"), "cells")
    held = placed.groupBy("cell").count().toArrow()  # at most MOST * MOST cells
    cells = len(books.value.first) * len(books.value.second)
    counts = np.zeros(cells, np.int64)
    counts[held.column("cell").to_numpy()] = held.column("count").to_numpy()
    # cells in order share units; a large cell has units of its own
    units_of = np.maximum(1, -(-counts // UNIT))
    start = np.cumsum(counts) - counts
    first_unit = start // UNIT + np.concatenate([[0], np.cumsum(np.where(units_of > 1, units_of, 0))])[:-1]
    layout = spark.sparkContext.broadcast((counts, first_unit, units_of))
    enough = int(np.ceil(books.value.share * n))

    def to_units(batches):
        _, first, many = layout.value
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            h = batch.column("h").to_numpy().view(np.uint64)
            unit = first[cell] + (h % many[cell].astype(np.uint64)).astype(np.int64)
            yield pa.record_batch([pa.array(unit), pa.array(np.zeros(len(cell), np.int32)), batch.column("h"), batch.column("v"), batch.column("ids"),
                                   pa.array([[c] for c in cell.tolist()], pa.list_(pa.int32()))], names=["unit", "kind", "h", "v", "ids", "cells"])

    def to_queries(batches):
        count, first, many = layout.value
        book = books.value
        for batch in batches:
            x = _matrix(batch.column("v"), width) if batch.num_rows else np.zeros((0, width))
            a, b = x[:, :book.cut] @ book.first.T, x[:, book.cut:] @ book.second.T
            for i in range(len(x)):
                met = np.array(_walk(a[i], b[i], count, enough), np.int64)
                at = np.repeat(met, many[met])
                unit = first[at] + np.concatenate([np.arange(m) for m in many[met]]) if len(at) else at
                order = np.argsort(unit, kind="stable")
                unit, at = unit[order], at[order]
                cut = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]) if len(unit) else np.zeros(0, int)
                lists = np.split(at, cut[1:]) if len(cut) else []
                m = len(cut)
                yield pa.record_batch([pa.array(unit[cut]), pa.array(np.ones(m, np.int32)), pa.array(np.full(m, batch.column("h")[i].as_py())),
                                       pa.array([batch.column("v")[i].as_py()] * m, batch.column("v").type), pa.array([batch.column("ids")[i].as_py()[:1]] * m, pa.list_(pa.int64())),
                                       pa.array([c.tolist() for c in lists], pa.list_(pa.int32()))], names=["unit", "kind", "h", "v", "ids", "cells"])

    asked = rows.where(F.col("vec_id") % every == 0).join(points.select("h", "v", F.col("ids")[0].alias("rep")), ["h", "v"]).select(F.col("vec_id").alias("query_id"), "rep")
    asked = saved(asked, "asked")
    queries = placed.withColumn("rep", F.col("ids")[0]).join(asked.select("rep").distinct(), "rep", "left_semi").drop("rep")
    schema = f"unit long, kind int, h long, v {kind}, ids array<long>, cells array<int>"
    size = partitions(spark)
    both = placed.select("h", "v", "ids", "cell").mapInArrow(to_units, schema).union(
        queries.select("h", "v", "ids", "cell").repartition(size).mapInArrow(to_queries, schema))

    def search(batches):
        """The nearest of each query in each unit: (rep, vec_id, score), by deterministic sums.

        A unit's vectors come first and are held; its queries pass by in blocks, however many they are."""
        unit, held, ready = None, [], None
        for batch in batches:
            units, kinds = batch.column("unit").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (units[1:] != units[:-1]) | (kinds[1:] != kinds[:-1])]) if len(units) else np.zeros(0, int)
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(units)]):
                part = batch.slice(lo, hi - lo)
                if units[lo] != unit:
                    unit, held, ready = units[lo], [], None
                if kinds[lo] == 0:
                    held.append(part)
                elif held:
                    ready = ready or _unit_vectors(pa.Table.from_batches(held), width)
                    yield _nearest_in_unit(ready, part, width, k)

    met = both.repartition(size, "unit").sortWithinPartitions("unit", "kind").mapInArrow(search, "rep long, vec_id long, score double")

    def best(batches):
        for table in whole_groups(batches, "rep"):
            rep, ids, score = (table.column(c).to_numpy() for c in ("rep", "vec_id", "score"))
            order = np.lexsort((ids, -score, rep))
            rep, ids, score = rep[order], ids[order], score[order]
            cut = np.flatnonzero(np.r_[True, rep[1:] != rep[:-1]])
            place = np.arange(len(rep)) - np.repeat(cut, np.diff(np.r_[cut, len(rep)]))
            keep = place <= k
            yield pa.record_batch([pa.array(rep[keep]), pa.array(place[keep].astype(np.int32)), pa.array(ids[keep]), pa.array(score[keep])], names=["rep", "place", "vec_id", "score"])

    top = met.repartition(size, "rep").sortWithinPartitions("rep").mapInArrow(best, "rep long, place int, vec_id long, score double")
    lists = top.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    per_query = asked.join(lists, "rep").select("query_id", F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k).alias("found"))
    return per_query.select("query_id", F.posexplode("found").alias("at", "f")).select("query_id", (F.col("at") + 1).alias("rank"), "f.vec_id", "f.score")
