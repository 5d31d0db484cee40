"""Whitening of embeddings along the leading eigenvectors of their covariance, found by FEAST.

Vectors become integers, so sums and squared distances are exact. On Spark: distinct vectors (equal
rows combine in the map tasks), their count and sums, the covariance of the centred vectors, the
covariance of the whitened ones, and the projection of every row. A task sends one matrix; the
driver gets sums of ``dim * dim`` numbers, whatever the number of rows.

``feast`` takes the covariance from there:

1. Inertia counts (signs of the pivots of the tridiagonal form minus a shift) say how many eigenvalues
   lie below a shift. By bisection they place the leading eigenvalues and cut the axis at wide
   gaps into intervals of a few eigenvalues.
2. Per interval a random block is projected on its eigenspace: the contour integral of
   ``(z - V)^-1 Y`` around the interval, by Gauss-Legendre quadrature with complex shifted solves.
3. Rayleigh-Ritz on the block gives the eigenpairs; 2 is repeated with them until their residuals are at
   rounding level. The pairs in an interval must be as many as its inertia count says: none is missed.

Equal eigenvalues are never cut apart, so a cluster is an interval of its own.

Defined results: rows whose vector is null, or has null or non-finite entries, are left out; so are
vectors of another length than the most frequent one (the greater of equally frequent ones) and empty
ones. A null id stays null, repeated rows are rows of their own (the fit counts equal vectors once).
Entries beyond 2**52 after scaling are cut there. Components whose variance is zero up to rounding have
no whitened value and are not returned: no rows come of an empty table or of one distinct vector. A squared
distance that does not fit 64 bits is null. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Quadrature nodes on the half circle, eigenvalues in an interval, rounds of the subspace iteration.
NODES, PER_INTERVAL, ROUNDS = 8, 8, 40
#: Eigenvalues closer than this share of the largest one are not parted.
CLOSE = 1e-11


# ---- eigenvectors on the driver -------------------------------------------------------------

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to the symmetric ``v`` (Householder)."""
    a = v.copy()
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size:
            u = x / size
            a[k + 1:, k:] -= 2 * np.outer(u, u @ a[k + 1:, k:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_below(tri, shift: np.ndarray) -> np.ndarray:
    """Inertia: how many eigenvalues lie below each shift, by the signs of the pivots."""
    diagonal, off = tri
    tiny = np.finfo(float).tiny ** .5
    pivot = np.asarray(diagonal[0] - shift)
    below = (pivot < 0).astype(int)
    for d, e in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - shift - e * e / pivot
        below += pivot < 0
    return below


def leading_values(tri, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection on inertia counts."""
    diagonal, off = tri
    n = len(diagonal)
    reach = np.abs(np.concatenate(([0], off))) + np.abs(np.concatenate((off, [0])))
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    want = n - np.arange(1, k + 1)
    for _ in range(80):
        mid = (low + high) / 2
        under = count_below(tri, mid) > want
        low, high = np.where(under, low, mid), np.where(under, mid, high)
    return (low + high) / 2


def intervals(tri, k: int) -> list[tuple[float, float, int]]:
    """(low, high, inertia count) of intervals that hold the ``k`` leading eigenvalues. They end in gaps that
    are wide for their length; values closer than rounding are kept together."""
    n = len(tri[0])
    look, end = k + PER_INTERVAL, None
    while end is None:
        values = leading_values(tri, min(n, look + 1))
        scale = max(abs(values[0]), abs(values[-1]), np.finfo(float).tiny)
        gaps = np.concatenate(([scale], values[:-1] - values[1:], [scale]))     # above value i, below the last
        last = len(values) if len(values) == n else len(values) - 1
        ends = np.arange(min(k, n), last + 1)
        best = int(ends[np.argmax(gaps[ends])])
        if gaps[best] > CLOSE * scale or last == n:
            end = best
        look *= 2
    parts, open_parts = [], [(0, end)]
    while open_parts:
        i, j = open_parts.pop()
        inner = gaps[i + 1:j]
        span, edge = values[i] - values[j - 1], min(gaps[i], gaps[j])
        wide = inner > CLOSE * scale
        if j - i > 1 and wide.any() and (j - i > PER_INTERVAL or span > 10 * edge):
            # Of the widest gaps the one next to the middle.
            good = np.flatnonzero(inner >= max(inner.max() / 2, CLOSE * scale))
            at = i + 1 + int(good[np.argmin(np.abs(good - (j - i) / 2))])
            open_parts += [(i, at), (at, j)]
        else:
            room = max(span, edge / 2)
            parts.append((values[j - 1] - min(gaps[j] / 2, room), values[i] + min(gaps[i] / 2, room)))
    parts.sort(reverse=True)
    below = count_below(tri, np.array(parts))
    if below[0, 1] != n or int((below[:, 1] - below[:, 0]).sum()) != end:
        raise ArithmeticError("the intervals miss eigenvalues")
    return [(low, high, int(c)) for (low, high), c in zip(parts, below[:, 1] - below[:, 0])]


def contour_projection(v: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """The block's part in the eigenspace of [low, high]: the integral of the resolvent around it."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for angle, weight in zip(np.pi / 2 * (nodes + 1), weights):
        turn = radius * np.exp(1j * angle)
        out += weight / 2 * (turn * np.linalg.solve((centre + turn) * np.eye(len(v)) - v, block.astype(complex))).real
    return out


def feast(v: np.ndarray, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    scale = float(np.abs(v).max(initial=0))
    if not scale:
        return np.zeros(min(k, len(v))), np.eye(len(v))[:, :k]
    v = v / scale
    norm = np.linalg.norm(v)
    random = np.random.default_rng(seed)
    values, vectors = [], []
    for low, high, count in intervals(tridiagonal(v), k):
        block = random.standard_normal((len(v), min(len(v), count + max(4, count // 2))))
        best = np.inf
        for _ in range(ROUNDS):
            q, _ = np.linalg.qr(contour_projection(v, low, high, block))
            small = q.T @ v @ q
            ritz, mix = np.linalg.eigh((small + small.T) / 2)
            block = q @ mix
            inside = (ritz > low) & (ritz < high)
            rest = np.linalg.norm(v @ block - block * ritz, axis=0)[inside].max(initial=0) / norm
            found = int(inside.sum()) == count
            if found and (rest < 1e-15 or rest < 1e-13 and rest > best / 2):
                break
            best = min(best, rest) if found else np.inf
        if not found or rest > 1e-10:
            raise ArithmeticError(f"{int(inside.sum())} of {count} eigenvalues in [{low * scale}, {high * scale}], residual {rest}")
        values.append(ritz[inside])
        vectors.append(block[:, inside])
    values, vectors = np.concatenate(values), np.concatenate(vectors, axis=1)
    order = np.argsort(-values)[:k]
    return values[order] * scale, vectors[:, order]


# ---- sums on Spark --------------------------------------------------------------------------

@dataclass
class Centre:
    """Count and exact sums: a vector is centred as ``(x - whole) - part``."""
    n: int
    sums: list[int]

    def shifted(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array([s // self.n for s in self.sums], np.int64)).astype(float) - np.array([s % self.n / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of ``(n * x - sums)**2``, exact."""
        near = x - np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        if len(x) and x.shape[1] * ((int(np.abs(near).max(initial=0)) + 1) * self.n) ** 2 < 1 << 63:
            return ((near * self.n - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((int(c) * self.n - r) ** 2 for c, r in zip(row, rest)) for row in near.tolist()]
        return [d if d < 1 << 63 else None for d in exact]


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """The rows that take part, with their integer vector ``x``, and its length."""
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(F.coalesce(fine, F.lit(False)))
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = most["dim"] if most else 0
    edge = float(1 << 52)
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(edge)), F.lit(-edge))).cast("long") + OFFSET)
    return rows.where(F.size("v") == dim).select("vec_id", x.alias("x")), dim


def _sums(batches, dim: int):
    n, high, low = 0, [0] * dim, [0] * dim
    for batch in batches:
        x = _matrix(batch.column(0), dim)
        n += len(x)
        high = [a + b for a, b in zip(high, (x >> 26).sum(axis=0).tolist())]
        low = [a + b for a, b in zip(low, (x & ((1 << 26) - 1)).sum(axis=0).tolist())]
    sums = [Decimal((h << 26) + l) for h, l in zip(high, low)]
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()), pa.array([Decimal(n), *sums], pa.decimal128(38, 0))], ["i", "s"])


def centre_of(vectors: DataFrame, dim: int) -> Centre | None:
    sums = vectors.select("x").mapInArrow(partial(_sums, dim=dim), "i int, s decimal(38,0)")
    total = {r["i"]: int(r["s"]) for r in sums.groupBy("i").agg(F.sum("s").alias("s")).collect()}
    return Centre(total[0], [total[i + 1] for i in range(dim)]) if total else None


def _means(batches, dim: int, centre: Centre, basis):
    total, seen = 0, False
    for batch in batches:
        total, seen = total + (centre.shifted(_matrix(batch.column(0), dim)) @ basis).sum(axis=0), True
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([[t] for t in total.tolist()], pa.list_(pa.float64()))], ["i", "row"])


def _products(batches, dim: int, centre: Centre, basis, mean):
    total, seen = 0, False
    for batch in batches:
        y = centre.shifted(_matrix(batch.column(0), dim))
        y = y if basis is None else y @ basis - mean
        total, seen = total + y.T @ y, True
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])


def _added(parts: DataFrame, shape) -> np.ndarray:
    """The tasks' matrices, added up entry by entry."""
    out = np.zeros(shape)
    for i, j, s in parts.select("i", F.posexplode("row").alias("j", "c")).groupBy("i", "j").agg(F.sum("c")).collect():
        out[i, j] = s
    return out


def covariance(vectors: DataFrame, dim: int, centre: Centre, basis=None) -> np.ndarray:
    """Covariance of the centred vectors, or of their projections on the columns of ``basis``."""
    size, mean = dim, None
    if basis is not None:
        size = basis.shape[1]
        sums = vectors.mapInArrow(partial(_means, dim=dim, centre=centre, basis=basis), "i int, row array<double>")
        mean = _added(sums, (size, 1))[:, 0] / centre.n
    parts = vectors.mapInArrow(partial(_products, dim=dim, centre=centre, basis=basis, mean=mean), "i int, row array<double>")
    return _added(parts, (size, size)) / centre.n


def _whiten(batches, dim: int, centre: Centre, basis, explained, error: float):
    k = basis.shape[1]
    for batch in batches:
        x = _matrix(batch.column(1), dim)
        rows = len(x)
        at = np.repeat(np.arange(rows), k)
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
            pa.array(np.full(rows * k, centre.n)), pa.array(centre.deviations(x), pa.int64()).take(pa.array(at)),
            pa.array((centre.shifted(x) @ basis).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
            ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row and component: id, component (from 1), n (distinct vectors), deviation (sum of the squares
    of ``n * x - sums``), whitened, explained (share of the variance), identity_error (largest
    entry of the whitened vectors' covariance minus the identity)."""
    vectors, dim = integer_vectors(rows, id_col, vector_col)
    kind = dict(vectors.dtypes)["vec_id"]
    schema = f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    none = rows.sparkSession.createDataFrame([], schema)
    if not dim:
        return none
    vectors = written(vectors, "whiten-vectors")
    fit = written(vectors.select("x").distinct(), "whiten-fit")
    centre = centre_of(fit, dim)
    v = covariance(fit, dim, centre)
    values, basis = feast(v, min(components, dim))
    kept = values > 8 * dim * np.finfo(float).eps * max(float(values[0]), 0)
    values, basis = values[kept], basis[:, kept]
    if not len(values):
        return none
    basis = basis / np.sqrt(values)
    error = float(np.abs(covariance(fit, dim, centre, basis) - np.eye(len(values))).max())
    found = vectors.select("vec_id", "x").mapInArrow(
        partial(_whiten, dim=dim, centre=centre, basis=basis, explained=values / np.trace(v), error=error),
        schema.replace(id_col, "vec_id", 1))
    return found.withColumnRenamed("vec_id", id_col)
