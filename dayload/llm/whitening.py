"""Whitening of embeddings by mixed-precision refinement of eigenvectors.

Three passes over the vectors, each summed up in its tasks before anything is
shuffled: exact integer sums, the centred covariance, and the covariance of the
whitened columns; a fourth writes the result.  What reaches the driver is a
``d x d`` matrix for ``d`` dimensions, whatever the number of rows.

The eigenvectors start in float32 and are corrected in extended precision by
the matrix products of Ogita and Aishima: with ``R = I - X'X`` and
``S = X'AX`` the correction of column ``j`` along ``i`` is
``(S_ij + e_j R_ij) / (e_j - e_i)``.  Where two eigenvalues are too close for
that division (closer than the error that ``R`` and ``S`` show), the columns
form a cluster: they are only made orthonormal, and the cluster's own small
matrix, its mean eigenvalue taken off, is solved by itself and its columns are
turned; then the corrections go on.

Defined results: rows whose vector is null or empty, holds null or non-finite
entries, or has another length than most rows (ties to the shorter) are left
out; a null id and repeated rows pass through; ``floor(1024 c)`` beyond 2^60
becomes 2^60; ``deviation`` is null where it exceeds a long;
``whitened`` is null for components without variance, ``explained`` if there is
no variance at all; an empty table gives an empty result; other columns are not
read.  Signs are fixed by the largest entry of a component, which is positive.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Components returned.
COMPONENTS = 8
#: Rounds of corrections; each about squares the error.
ROUNDS = 12
#: Relative to the largest eigenvalue: what counts as no variance.
FLAT = 1e-13
OFFSET, SCALE = 100_000, 1024
#: What ``floor(1024 c)`` is bounded by, so that sums and differences stay whole.
LARGEST = float(1 << 60)
_LONG = 2.0 ** 63


def refined(a: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors in columns) of a symmetric matrix, from float32 ones."""
    d = len(a)
    scale = float(np.abs(a).max()) if d else 0.0
    if not scale:
        return np.zeros(d), np.eye(d)
    wide = np.longdouble
    high = a.astype(wide) / wide(scale)
    x = np.linalg.eigh((a / scale).astype(np.float32))[1].astype(wide)
    eye, norm, last = np.eye(d, dtype=wide), None, np.inf
    values = np.zeros(d, wide)
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ (high @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # else rounding, divided by a small gap, bends the columns
        values = np.diag(s) / (1 - np.diag(r))
        norm = np.abs(values).max() if norm is None else norm
        error = max(2 * (np.abs(s - np.diag(values)).sum(axis=0).max() + norm * np.abs(r).sum(axis=0).max()), FLAT * norm)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > error
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        size = float(np.abs(e).max())
        x = _clusters_solved(high, x, ~apart)
        if size < 1e-17 or (size >= last and size < 1e-15):
            break
        last = size
    values = np.einsum("ij,ij->j", x, high @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x / np.sqrt(np.einsum("ij,ij->j", x, x))
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(d)] < 0, -1, 1)
    return (values[order] * wide(scale)).astype(float), x.astype(float)


def _clusters_solved(a: np.ndarray, x: np.ndarray, close: np.ndarray) -> np.ndarray:
    """Each set of columns whose eigenvalues are close (linked by ``close``) turned by the solution of its own matrix."""
    d, seen, x = len(a), set(), x.copy()
    for i in range(d):
        if i in seen:
            continue
        held, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(close[todo.pop()]).tolist():
                if j not in held:
                    held.add(j)
                    todo.append(j)
        seen |= held
        if len(held) == 1:
            continue
        at = sorted(held)
        q = x[:, at]
        q = q + q @ (np.eye(len(at), dtype=q.dtype) - q.T @ q) / 2
        own = q.T @ (a @ q)
        own = (own + own.T) / 2
        own = own - np.eye(len(at), dtype=q.dtype) * np.diag(own).mean()
        top = np.abs(own).max()
        if top > 0:
            turn = np.linalg.eigh((own / top).astype(np.float64))[1].astype(q.dtype)
            q = q @ (turn + turn @ (np.eye(len(at), dtype=q.dtype) - turn.T @ turn) / 2)
        x[:, at] = q
    return x


@dataclass
class Whitening:
    """What the passes found: rows, integer sums, eigenvalues and components, total variance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    total: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def scaled(self, components: int) -> np.ndarray:
        """Directions that whiten, a column each; 0 where there is no variance."""
        e = self.values[:components]
        ok = e > FLAT * max(float(self.values[0]), 0) if len(e) else e > 0
        return self.vectors[:, :components] * np.where(ok, 1 / np.sqrt(np.where(ok, e, 1)), 0)


def _integers(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The x-vectors of a batch of complete vectors."""
    c = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * c), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def complete_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """(id, v) of the rows that take part, and their dimensions."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    bad = F.exists("v", lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    rows = rows.where("v is not null and size(v) > 0").where(~bad)
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = most["d"] if most else 0
    return rows.where(F.size("v") == dims), dims


def _summed(rows: DataFrame, dims: int, of, kind: str) -> dict[tuple[int, int], float]:
    """Sums over all tasks of the matrix ``of`` adds up for each batch (only entries i <= j)."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_integers(batch, dims))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(*total.shape[:1], m=total.shape[1])
            yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    sent = rows.select("v").mapInArrow(run, f"i int, j int, v {kind}")
    added = F.sum(F.col("v").cast("decimal(38,0)")) if kind == "long" else F.sum("v")
    return {(r["i"], r["j"]): r["v"] for r in sent.groupBy("i", "j").agg(added.alias("v")).collect()}


def _symmetric(entries: dict, d: int) -> np.ndarray:
    out = np.zeros((d, d))
    for (i, j), v in entries.items():
        out[i, j] = out[j, i] = v
    return out


def fit(rows: DataFrame, dims: int) -> Whitening | None:
    """Sums, covariance and components of complete vectors; None without rows."""
    def halves(x):  # high and low bits apart: no sum of a task leaves 64 bits
        return np.concatenate([[len(x)], (x >> 30).sum(axis=0), (x & (1 << 30) - 1).sum(axis=0)])[None]

    counted = _summed(rows, dims, halves, "long")
    if not counted:
        return None
    n = int(counted[0, 0])
    sums = [(int(counted[0, j + 1]) << 30) + int(counted[0, j + 1 + dims]) for j in range(dims)]
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])

    def products(x):
        c = (x - whole).astype(np.float64) - rest
        return c.T @ c

    cov = _symmetric(_summed(rows, dims, products, "double"), dims) / n
    values, vectors = refined(cov)
    return Whitening(n, sums, values, vectors, float(np.trace(cov)))


def identity_error(rows: DataFrame, dims: int, model: Whitening, components: int) -> float:
    """The largest entry of the whitened columns' covariance minus the identity (components with variance)."""
    w, k = model.scaled(components), min(components, dims)
    whole, rest = np.array([s // model.n for s in model.sums], np.int64), np.array([(s % model.n) / model.n for s in model.sums])

    def products(x):
        y = np.concatenate([np.ones((len(x), 1)), ((x - whole).astype(np.float64) - rest) @ w], axis=1)
        return y.T @ y

    both = _symmetric(_summed(rows, dims, products, "double"), k + 1) / model.n
    cov = both[1:, 1:] - np.outer(both[0, 1:], both[0, 1:])
    live = np.flatnonzero(np.any(w != 0, axis=0))
    return float(np.abs(cov - np.eye(k))[np.ix_(live, live)].max()) if len(live) else 0.0


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row for each complete vector and component (``OUTPUT``)."""
    rows, dims = complete_vectors(table, id_col, vec_col)
    model = fit(rows, dims) if dims else None
    if model is None:
        return table.sparkSession.createDataFrame([], OUTPUT)
    k, w, n = min(components, dims), model.scaled(components), model.n
    error = identity_error(rows, dims, model, components)
    whole, rest = np.array([s // n for s in model.sums], np.int64), np.array([(s % n) / n for s in model.sums])
    left = np.array([s % n for s in model.sums], np.int64)  # n x - S = n (x - whole) - left
    flat = ~np.any(w != 0, axis=0)
    share = [float(e / model.total) if model.total > 0 else None for e in model.values[:k]]
    names = [c.split()[0] for c in OUTPUT.split(", ")]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _integers(batch, dims) - whole
            y = (x.astype(np.float64) - rest) @ w
            if (np.abs(x).max().astype(float) * n + n) ** 2 * dims < _LONG / 2:
                deviation = ((n * x - left) ** 2).sum(axis=1).tolist()
            else:
                deviation = [sum((n * a - b) ** 2 for a, b in zip(v, left.tolist())) for v in x.tolist()]
                deviation = [v if v < 1 << 63 else None for v in deviation]
            m = len(x)
            yield pa.record_batch([
                batch.column("id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                pa.array([v for v in deviation for _ in range(k)], pa.int64()), pa.array(y.ravel(), mask=np.tile(flat, m)),
                pa.array(share * m, pa.float64()), pa.array(np.full(m * k, error))], names=names)

    return rows.mapInArrow(run, OUTPUT)


def components_of(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The components themselves: component, eigenvalue, explained, vector."""
    rows, dims = complete_vectors(table, id_col, vec_col)
    model = fit(rows, dims) if dims else None
    found = [] if model is None else [(i + 1, float(model.values[i]), float(model.values[i] / model.total) if model.total > 0 else None, model.vectors[:, i].tolist()) for i in range(dims)]
    return saved(table.sparkSession.createDataFrame(found, "component int, eigenvalue double, explained double, vector array<double>"), "components")
