"""Operator 11: whitening by an incremental eigendecomposition.

Every task keeps the spectrum (eigenvalues and eigenvectors) of the scatter
of the vectors it has read, about their mean, and brings it up to date by
rank-one updates: one per centred vector, or, for blocks of more vectors than
dimensions, one per row of the block's triangular factor, which has the same
scatter; and one for the shift of the mean. An update deflates eigenvalues
that are equal or stay as they are and finds the others as roots of the
secular equation. Spectra are combined in a tree in the same way, each
direction of one being a rank-one update of the other. A last distributed
pass projects all vectors on the combined basis and solves the projected
problem exactly (Rayleigh-Ritz), which takes away what rounding has left.

The spectrum, d x d numbers for d dimensions, is all that a task holds beside
a block of vectors, and all that the driver sees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.llm.common import load, materialise, only

SCALE, COMPONENTS = 256, 4
FAN_IN = 16
BLOCK_BYTES = 8 << 20
NO_VARIANCE = 1e-12  # of the trace: an eigenvalue below is taken for zero
_EPS = np.finfo(float).eps


# --- rank-one updates -------------------------------------------------------------------

def secular(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors (columns) of diag(d) + z zT; ``d`` ascends
    strictly, no z is zero. Roots are found by bisection as offsets from the
    nearer pole, so that small gaps keep their digits; z is then made to fit
    the roots exactly, which keeps the vectors orthogonal."""
    z2 = z * z
    upper = np.append(d[1:], d[-1] + z2.sum())
    half = (upper - d) / 2
    f = 1 + (z2 / (d[None, :] - d[:, None] - half[:, None])).sum(axis=1)
    left = f >= 0
    left[-1] = True
    origin = np.where(left, d, upper)
    lo, hi = np.where(left, 0.0, -half), np.where(left, half, 0.0)
    hi[-1] = 2 * half[-1]
    base = d[None, :] - origin[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(64):
            t = (lo + hi) / 2
            below = 1 + (z2 / (base - t[:, None])).sum(axis=1) < 0
            lo, hi = np.where(below, t, lo), np.where(below, hi, t)
    t = (lo + hi) / 2
    off = base - t[:, None]  # off[i, j] = d_j - root_i
    off[off == 0] = np.finfo(float).tiny
    apart = d[None, :] - d[:, None]
    np.fill_diagonal(apart, 1.0)
    fitted = np.exp((np.log(np.abs(off)).sum(axis=0) - np.log(np.abs(apart)).sum(axis=0)) / 2) * np.sign(z)
    vectors = (fitted[None, :] / off).T
    return origin + t, vectors / np.linalg.norm(vectors, axis=0)


def rank_one(e: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of q diag(e) qT + v vT; ``e`` ascends before and after."""
    z = q.T @ v
    size = float(np.linalg.norm(z))
    if size == 0 or not np.isfinite(size):
        return e, q
    tol = 8 * _EPS * max(float(e[-1]), size * size)
    q = q.copy()
    # equal eigenvalues: a reflection leaves one of them all of z's share
    ends = np.flatnonzero(np.append(np.diff(e) > tol, True)) + 1
    for lo, hi in zip(np.append(0, ends[:-1]), ends):
        share = float(np.linalg.norm(z[lo:hi]))
        if hi - lo > 1 and share > 0:
            u = z[lo:hi].copy()
            u[-1] += share if u[-1] >= 0 else -share
            u /= np.linalg.norm(u)
            z[lo:hi] -= 2 * (u @ z[lo:hi]) * u
            q[:, lo:hi] -= 2 * np.outer(q[:, lo:hi] @ u, u)
            z[lo:hi - 1] = 0
    active = np.abs(z) * size > tol
    if not active.any():
        return e, q
    roots, vectors = secular(e[active], z[active])
    e, q = np.concatenate((e[~active], roots)), np.hstack((q[:, ~active], q[:, active] @ vectors))
    order = np.argsort(e, kind="stable")
    return e[order], np.ascontiguousarray(q[:, order])


@dataclass
class Spectrum:
    """n vectors with their mean, and the spectrum of their scatter about it."""

    n: int
    mean: np.ndarray
    e: np.ndarray
    q: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d), np.zeros(d), np.eye(d))

    def _take(self, n: int, mean: np.ndarray, directions: np.ndarray) -> None:
        """Add n vectors of the given mean, whose scatter is the sum of v vT over ``directions``."""
        for v in directions:
            self.e, self.q = rank_one(self.e, self.q, v)
        if self.n and n:
            self.e, self.q = rank_one(self.e, self.q, (mean - self.mean) * np.sqrt(self.n / (self.n + n) * n))
        self.mean = self.mean + (mean - self.mean) * (n / max(self.n + n, 1))
        self.n += n

    def add(self, block: np.ndarray) -> None:
        mean = block.mean(axis=0)
        centred = block - mean
        self._take(len(block), mean, np.linalg.qr(centred, mode="r") if len(block) > block.shape[1] else centred)

    def merge(self, other: Spectrum) -> None:
        some = other.e > 0
        self._take(other.n, other.mean, (other.q[:, some] * np.sqrt(other.e[some])).T)


# --- vectors ----------------------------------------------------------------------------

def whole_vectors(vectors: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and x, the entries times 256 rounded down, of the rows whose
    vector is not null and holds no null or non-finite entry (nor one whose x
    is beyond a long)."""
    ok = F.expr(f"embedding IS NOT NULL AND NOT exists(embedding, c -> c IS NULL OR isnan(c) "
                f"OR abs(cast(c AS double)) >= {2.0 ** 63 / SCALE!r})")
    return only(vectors, *keep, "embedding").where(ok).select(
        *keep, F.expr(f"transform(embedding, c -> cast(floor({SCALE} * cast(c AS double)) AS long))").alias("x"))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    """The vectors in blocks of several times d, bounded by bytes."""
    rows, held, n = max(2 * d, BLOCK_BYTES // (8 * d)), [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(_matrix(batch, d))
            n += batch.num_rows
            if n >= rows:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of every dimension, as whole numbers."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for block in _blocks(batches, d):
            n += len(block)
            safe = int(np.abs(block.astype(float)).max()) < (1 << 62) // len(block)
            total = [a + int(b) for a, b in zip(total, (block if safe else block.astype(object)).sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n] * d, pa.int64()), pa.array(range(d), pa.int32()),
                                              pa.array([str(t) for t in total])], ["n", "dim", "total"])

    rows = (fit.mapInArrow(sums, "n long, dim int, total string").groupBy("dim")
            .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    by_dim = {r["dim"]: r for r in rows}
    return (by_dim[0]["n"] if rows else 0), [int(by_dim[i]["total"]) for i in range(d)] if rows else []


_SPECTRUM = "id long, n long, mean binary, e binary, q binary"


def _pack(i: int, s: Spectrum) -> pd.DataFrame:
    return pd.DataFrame({"id": [i], "n": [s.n], "mean": [s.mean.tobytes()], "e": [s.e.tobytes()], "q": [s.q.tobytes()]})


def _unpack(row) -> Spectrum:
    e = np.frombuffer(row.e)
    return Spectrum(int(row.n), np.frombuffer(row.mean), e, np.frombuffer(row.q).reshape(len(e), len(e)))


def _tree(rows: DataFrame, fold, schema: str) -> DataFrame:
    """One row from rows with an ``id``: ``FAN_IN`` rows at a time are folded in a task."""
    rows = materialise(rows, "whitening-partials")
    last = rows.agg(F.max("id")).first()[0] or 0
    while last:
        rows = rows.groupBy((F.col("id") / FAN_IN).cast("long").alias("up")).applyInPandas(fold, schema)
        last //= FAN_IN
    return rows


def combined_spectrum(fit: DataFrame, d: int) -> Spectrum:
    """The spectrum of all of ``fit`` by rank-one updates in the tasks and up a tree."""
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        s = Spectrum.empty(d)
        for block in _blocks(batches, d):
            s.add(block.astype(float))
        if s.n:
            yield pa.RecordBatch.from_pandas(_pack(TaskContext.get().partitionId(), s), preserve_index=False)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        some = [_unpack(r) for r in group.sort_values("id").itertuples()]
        for other in some[1:]:
            some[0].merge(other)
        return _pack(int(group["id"].iloc[0]) // FAN_IN, some[0])

    return _unpack(_tree(fit.mapInArrow(grow, _SPECTRUM), merge, _SPECTRUM).first())


def projected_scatter(fit: DataFrame, mean: np.ndarray, q: np.ndarray) -> np.ndarray:
    """qT S q for the scatter S of ``fit`` about ``mean``, summed over tasks."""
    d, k = q.shape

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total, seen = np.zeros((k, k)), False
        for block in _blocks(batches, d):
            y = (block - mean) @ q
            total += y.T @ y
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([total.tobytes()], pa.binary())], ["id", "t"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(t) for t in group.sort_values("id")["t"]], axis=0)
        return pd.DataFrame({"id": [int(group["id"].iloc[0]) // FAN_IN], "t": [total.tobytes()]})

    row = _tree(fit.mapInArrow(project, "id long, t binary"), add, "id long, t binary").first()
    return np.frombuffer(row["t"]).reshape(k, k)


@dataclass
class Whitening:
    """n fitted vectors, their exact sums, and the leading components: ``v``
    (columns), eigenvalues ``e`` (falling), the trace, and the largest entry
    of the whitened fit list's covariance minus the identity."""

    n: int
    sums: list[int]
    v: np.ndarray
    e: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fit_whitening(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``fit`` (x, each vector once, written); None for no
    vectors. Components without variance are left out, so there may be fewer."""
    n, sums = exact_sums(fit, d)
    if not n:
        return None
    mean = np.array([s / n for s in sums])
    basis = combined_spectrum(fit, d).q
    t = projected_scatter(fit, mean, basis) / n
    e, u = np.linalg.eigh((t + t.T) / 2)
    trace = float(e.sum())
    top = [i for i in range(d - 1, max(-1, d - 1 - components), -1) if e[i] > NO_VARIANCE * trace and e[i] > 0]
    v, e = basis @ u[:, top], e[top]
    error = 0.0
    if top:
        error = float(np.abs(projected_scatter(fit, mean, v / np.sqrt(e)) / n - np.eye(len(top))).max())
    return Whitening(n, sums, v, e, trace, error)


def apply_whitening(rows: DataFrame, key: str, w: Whitening) -> DataFrame:
    """One row per row of ``rows`` (key, x) and component: ``key``, component
    (from 1), n, deviation (null where it is beyond a long), whitened,
    explained, identity_error."""
    d, k = w.v.shape
    mean, scaled, explained = w.mean, w.v / np.sqrt(w.e), w.e / w.trace
    sums = np.array(w.sums, object)
    kind = rows.schema[key].dataType.simpleString()

    def deviations(x: np.ndarray) -> pa.Array:
        most = w.n * int(np.abs(x.astype(float)).max()) + max(abs(s) for s in w.sums)
        if d * most * most < 1 << 62:
            gap = w.n * x - sums.astype(np.int64)
            return pa.array((gap * gap).sum(axis=1))
        gap = w.n * x.astype(object) - sums
        return pa.array([v if v < 1 << 63 else None for v in (gap * gap).sum(axis=1).tolist()], pa.int64())

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = _matrix(batch, d), batch.num_rows
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(key).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, w.n)), deviations(x).take(each),
                pa.array(((x - mean) @ scaled).ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, w.identity_error))],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(whiten, f"{key} {kind}, component int, n long, deviation long, whitened double, "
                                   "explained double, identity_error double")


def op11_incremental_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every vector.

    Vectors that are null, or hold null or non-finite entries, are dropped.
    Those of another length than most of the table's vectors (of equally
    frequent lengths the longer) take no part either, nor do empty ones. A null
    vec_id is kept as it is, repeated rows give rows each, and count once in the
    fit. Components without variance are not returned, so a table of one
    distinct vector, like an empty one, gives no rows.
    """
    rows = whole_vectors(load(spark, sf_dir, "embeddings"), "vec_id")
    usual = (rows.groupBy(F.size("x").alias("d")).count().where("d > 0")
             .orderBy(F.desc("count"), F.desc("d")).first())
    d = usual["d"] if usual else 1
    rows = rows.where(F.size("x") == d)
    fit = materialise(rows.select("x").distinct(), "whitening-fit")
    w = fit_whitening(fit, d)
    if w is None or not len(w.e):
        w, rows = Whitening(1, [0] * d, np.zeros((d, 0)), np.zeros(0), 1.0, 0.0), rows.limit(0)
    return apply_whitening(rows, "vec_id", w)
