"""Embedding whitening: principal components by Chebyshev-filtered subspace iteration.

Entries become integers ``x = floor(64 c) + 1000000``, so means and deviations
are exact. With the covariance ``V`` of the fitted vectors (divisor n, centred
before multiplying), the leading eigenvectors come from passes over the
distributed vectors: each pass multiplies ``V`` with a block of ``k + guard``
columns without forming ``V`` (a task sums ``Xc' (Xc Q)`` over its rows, Spark
sums the tasks' cells). A few Lanczos passes bound the spectrum; then the
three-term Chebyshev recurrence on the unwanted interval damps it, QR
orthonormalises the block, Rayleigh-Ritz rotates it, and the residuals
``|V q - e q|`` certify the leading k pairs. A block that converges too slowly is
doubled; one that spans the whole space needs a single Rayleigh-Ritz step.

What reaches the driver is the dimension times the block's columns, whatever
the number of vectors. Every task holds one Arrow batch and one block.

Defined results: vectors that are null, empty, hold null or non-finite
entries, or an entry beyond ``2**40`` in absolute value are left out; so are
vectors whose length is not the most common one (the shorter of equally
common). Repeated rows count as often as they occur, a null id is kept.
Components with no variance beyond rounding are not given. Equal eigenvalues
leave their components free within their space. A deviation that does not fit
a long is null. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

COMPONENTS, GUARD, DEGREE, LANCZOS = 32, 12, 8, 10
TOLERANCE, ACCEPTED, PATIENCE = 2e-14, 1e-12, 8
SCALE, SHIFT, LARGEST = 64, 1_000_000, float(1 << 40)


def _integers(batches):
    """``(vec_id, dim, x)``: the vectors that can be used, as integers."""
    for b in batches:
        ids, rows = [], []
        for vec_id, v in zip(b.column("vec_id").to_pylist(), b.column("embedding")):
            v = v.values
            if v is None or len(v) == 0 or v.null_count:
                continue
            c = v.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(c).all() and np.abs(c).max() <= LARGEST:
                ids.append(vec_id)
                rows.append((np.floor(SCALE * c).astype(np.int64) + SHIFT).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(r) // 8 for r in rows], pa.int32()), pa.array(rows, pa.binary())],
            ["vec_id", "dim", "x"])


def _matrix(batch, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), np.int64).reshape(-1, dim)


def _cells(values: np.ndarray) -> pa.RecordBatch:
    values = np.ascontiguousarray(values).ravel()
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int64)), pa.array(values)], ["cell", "value"])


def _sums(dim: int):
    def run(batches):
        total = np.zeros(dim, np.int64)
        for b in batches:
            total += _matrix(b, dim).sum(axis=0)
        yield _cells(total)
    return run


class Vectors:
    """The fitted vectors: a written table of integers, with exact count and sums."""

    def __init__(self, table: DataFrame, dim: int, n: int):
        self.table, self.dim, self.n = table, dim, n
        rows = table.select("x").mapInArrow(_sums(dim), "cell long, value long") \
            .groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
        self.sums = [int(r["value"]) for r in sorted(rows, key=lambda r: r["cell"])]
        self.base = [s // n for s in self.sums]         # n x - S = n (x - base) - rest, without overflow
        self.rest = [s - n * m for s, m in zip(self.sums, self.base)]

    def centred(self):
        """A function from a batch to its rows less the mean."""
        dim, base, part = self.dim, np.array(self.base), np.array([r / self.n for r in self.rest])
        return lambda batch: (_matrix(batch, dim) - base) - part

    def total(self, per_batch, size: int) -> np.ndarray:
        """Sum over all rows of ``per_batch(centred rows)``, an array of ``size`` cells: one pass."""
        centred = self.centred()

        def run(batches):
            acc = np.zeros(size)
            for b in batches:
                if b.num_rows:
                    acc += np.ravel(per_batch(centred(b)))
            yield _cells(acc)

        rows = self.table.select("x").mapInArrow(run, "cell long, value double") \
            .groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(size)
        out[rows["cell"].to_numpy()] = rows["value"].to_numpy()
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """``V q`` by one pass."""
        return self.total(lambda x: x.T @ (x @ q), q.size).reshape(q.shape) / self.n

    def trace(self) -> float:
        return float(self.total(lambda x: np.einsum("ij,ij->j", x, x), self.dim).sum()) / self.n


def lanczos_bounds(times, dim: int, steps: int, rng) -> tuple[float, float]:
    """Estimates of the ends of the spectrum (``steps`` passes with one column)."""
    q = [rng.normal(size=dim)]
    q[0] /= np.linalg.norm(q[0])
    alpha, beta = [], []
    for _ in range(min(steps, dim)):
        w = times(q[-1][:, None])[:, 0]
        alpha.append(float(q[-1] @ w))
        for _ in range(2):
            w -= np.array(q).T @ (np.array(q) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(abs(a) for a in alpha):
            beta[-1] = 0.0
            break
        q.append(w / beta[-1])
    theta = np.linalg.eigvalsh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
    return max(0.0, float(theta[0])), float(theta[-1]) + beta[-1]


def chebyshev(times, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The block after a polynomial that is small on ``[low, high]``, scaled at ``top``."""
    centre, half = (high + low) / 2, (high - low) / 2
    sigma = first = half / (top - centre)
    before, now = q, (times(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, 2 * (following / half) * (times(now) - centre * now) - (sigma * following) * before
        sigma = following
    return now


def leading_pairs(times, dim: int, k: int, guard: int = GUARD, degree: int = DEGREE, seed: int = 13):
    """The ``k`` largest eigenvalues of a symmetric positive semidefinite operator, with vectors, and the largest residual.

    ``times(block)`` multiplies the operator with a block of columns. Iterates
    until every residual is at rounding level (``TOLERANCE`` times the largest
    eigenvalue and the root of the dimension), or no longer falls and lies
    below ``ACCEPTED``. Where a cluster of eigenvalues reaches across the
    block's edge that takes for ever, so after every ``PATIENCE`` rounds the
    block is doubled, at most to the whole space.
    """
    k = min(k, dim)
    width = min(dim, k + guard)
    rng = np.random.default_rng(seed)
    if width == dim:        # the block spans the space: Rayleigh-Ritz alone
        q = np.eye(dim)
    else:
        low, top = lanczos_bounds(times, dim, LANCZOS, rng)
        q = np.linalg.qr(rng.normal(size=(dim, width)))[0]
    best, stalled, rounds = np.inf, 0, 0
    while True:
        v = times(q)
        h = q.T @ v
        e, r = np.linalg.eigh((h + h.T) / 2)
        e, r = e[::-1], r[:, ::-1]
        q, v = q @ r, v @ r
        rounds += 1
        worst = float(np.linalg.norm(v[:, :k] - q[:, :k] * e[:k], axis=0).max())
        scale = max(float(e[0]), np.finfo(float).tiny)
        stalled = stalled + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if width == dim or worst <= TOLERANCE * np.sqrt(dim) * scale or (stalled >= 2 and worst <= ACCEPTED * scale):
            return e[:k], q[:, :k], worst
        if rounds % PATIENCE == 0:
            width = min(dim, 2 * width)
            q = np.linalg.qr(np.hstack([q, rng.normal(size=(dim, width - q.shape[1]))]))[0] if width < dim else np.eye(dim)
            best = np.inf
            continue
        high = float(e[-1])                 # the block's smallest Ritz value: what lies below is unwanted
        top = max(top, float(e[0]))
        if high <= 1e-15 * scale:           # the rest of the spectrum is zero
            q = np.linalg.qr(v)[0]
            continue
        floor = low if low < 0.999 * high else 0.0
        q = np.linalg.qr(chebyshev(times, q, floor, high, top, degree))[0]


def _project(vectors: Vectors, basis: np.ndarray, share: np.ndarray, error: float):
    """Rows of the result: every vector on every component."""
    centred, n, dim, k = vectors.centred(), vectors.n, vectors.dim, basis.shape[1]
    base, rest, exact_rest = np.array(vectors.base), np.array(vectors.rest), vectors.rest

    def deviations(x: np.ndarray) -> list[int | None]:
        y = x - base
        bound = n * int(np.abs(y).max(initial=0)) + n
        if dim * bound * bound < 1 << 63:
            d = n * y - rest
            return (d * d).sum(axis=1).tolist()
        exact = (sum((n * a - b) ** 2 for a, b in zip(row.tolist(), exact_rest)) for row in y)
        return [v if v < 1 << 63 else None for v in exact]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                m = part.num_rows
                w = centred(part) @ basis
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array(deviations(_matrix(part, dim)), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(w.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of every usable vector and component.

    ``whitened`` is the centred vector's coordinate on the component over the
    root of the component's variance, ``explained`` that variance's share,
    ``deviation`` the exact sum of ``(n x - S)**2`` over dimensions, and
    ``identity_error`` the largest absolute entry of the whitened vectors'
    covariance less the identity, measured by a pass.
    """
    spark = embeddings.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    table = materialise(embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
                        .mapInArrow(_integers, "vec_id long, dim int, x binary"), "vectors")
    lengths = table.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = lengths["dim"]
    vectors = Vectors(table.where(F.col("dim") == dim), dim, lengths["count"])
    e, q, _ = leading_pairs(vectors.times, dim, components)
    total = vectors.trace()
    held = int((e > 1e-12 * max(float(e[0]), 0.0)).sum()) if e[0] > 0 else 0
    if not held:
        return spark.createDataFrame([], schema)
    e, q = e[:held], q[:, :held]
    basis = q / np.sqrt(e)

    def moments(x):
        w = x @ basis
        return np.vstack([w.T @ w, w.sum(axis=0)])

    m = vectors.total(moments, (held + 1) * held).reshape(held + 1, held) / vectors.n
    error = float(np.abs(m[:-1] - np.outer(m[-1], m[-1]) - np.eye(held)).max())
    return vectors.table.select("vec_id", "x").mapInArrow(_project(vectors, basis, e / total, error), schema)
