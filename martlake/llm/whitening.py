"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the
triangular factor.

Every component c of a vector becomes the integer floor(64 c) (plus ``SHIFT``, which neither the
scatter nor a deviation depends on). Partitions add up integer moments, Spark adds those, and the
driver holds d * d / 2 sums for vectors of length d: the scatter n * sum(x y) - sum(x) sum(y) is
exact, so centring cancels nothing. Its pivoted Cholesky factor is a triangle whose columns
one-sided Jacobi turns until they are orthogonal: their squared norms are the eigenvalues, the
normalised columns the components. Whitening is a scan with that bounded table.

Vectors that are null, empty or hold a null or non-finite entry are dropped; zero vectors stay.
Vectors of each length are a fit of their own. Rows that repeat a vec_id, or have none, each
count and are each returned. Directions without variance (a constant dimension, a single row,
fewer rows than dimensions) are no components: such a fit returns fewer of them, or no rows.
Equal eigenvalues leave the choice of their components open. Entries saturate at +-2^40 after
scaling; a deviation beyond a long is null. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import textkit as tk

SCALE = 64.0
SHIFT = 1_000_000
COMPONENTS = 32
_LIMIT = float(1 << 40)
_LIMB = 20
#: rows multiplied at once: products of 20-bit numbers then add up exactly in a double
_ROWS = 1 << (53 - 2 * _LIMB)


def whole(v: Column) -> Column:
    """Not null, not empty, and no null or non-finite entry."""
    x_ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(F.forall(v, x_ok), F.lit(False))


def vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col(vector_column).cast("array<double>")
    return table.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).filter(whole(F.col("v")))


def by_length(batch):
    """(dim, ids, matrix of doubles) for each vector length of an Arrow batch (id, v)."""
    v = batch.column("v")
    size = np.diff(v.offsets.to_numpy())
    for dim in np.unique(size).tolist():
        mask = pa.array(size == dim)
        rows = v.filter(mask)
        yield dim, batch.column("id").filter(mask), rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)


def scaled(m: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * m), -_LIMIT, _LIMIT).astype(np.int64)


def _products(y: np.ndarray) -> np.ndarray:
    """Exact y.T @ y as Python integers, for at most _ROWS rows."""
    low, high = (y & ((1 << _LIMB) - 1)).astype(float), (y >> _LIMB).astype(float)
    total = (low.T @ low).astype(np.int64).astype(object)
    if high.any():
        cross = (low.T @ high).astype(np.int64).astype(object)
        total += ((cross + cross.T) << _LIMB) + ((high.T @ high).astype(np.int64).astype(object) << 2 * _LIMB)
    return total


def _moments(batches):
    """One row for each sum of a partition: (dim, i, j, sum); i = -1 holds the plain sums, of
    which j = -1 is the number of rows."""
    held = {}
    for b in batches:
        for dim, _, m in by_length(b):
            n, sums, products = held.get(dim, (0, 0, 0))
            for k in range(0, len(m), _ROWS):
                y = scaled(m[k:k + _ROWS])
                n, sums, products = n + len(y), sums + y.sum(axis=0).astype(object), products + _products(y)
            held[dim] = n, sums, products
    for dim, (n, sums, products) in held.items():
        i, j = np.triu_indices(dim)
        values = [n, *sums, *products[i, j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(values), dim, np.int32)), pa.array(np.concatenate([np.full(dim + 1, -1), i]).astype(np.int32)),
             pa.array(np.concatenate([np.arange(-1, dim), j]).astype(np.int32)), pa.array(list(map(Decimal, values)), pa.decimal128(38, 0))],
            names=["dim", "i", "j", "total"])


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(l, order): a[order][:, order] = l @ l.T with l lower triangular, its columns as many as
    the rank; the largest diagonal element left is the next pivot."""
    d = len(a)
    order, left, l = np.arange(d), a.diagonal().copy(), np.zeros((d, d))
    least = d * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(d):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= least:
            return l[:, :k], order
        for x in (order, left, l):
            x[[k, p]] = x[[p, k]]
        l[k, k] = np.sqrt(left[k])
        l[k + 1:, k] = (a[order[k + 1:], order[k]] - l[k + 1:, :k] @ l[k, :k]) / l[k, k]
        left[k + 1:] -= l[k + 1:, k] ** 2
    return l, order


def orthogonal_columns(g: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """One-sided Jacobi: plane rotations of column pairs until all columns are orthogonal. A
    round turns disjoint pairs at once; a sweep's rounds meet every pair."""
    d, r = g.shape
    g = np.concatenate([g, np.zeros((d, r % 2))], axis=1)
    turn = np.arange(g.shape[1])
    half = len(turn) // 2
    for _ in range(sweeps if half else 0):
        worst = 0.0
        for _ in range(len(turn) - 1):
            a, b = turn[:half], turn[half:][::-1]
            x, y = g[:, a], g[:, b]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            size = np.sqrt(xx * yy)
            cosine = np.divide(np.abs(xy), size, out=np.zeros(half), where=size > 0)
            worst = max(worst, float(cosine.max()))
            bent = cosine > np.finfo(float).eps
            zeta = np.divide(yy - xx, 2 * xy, out=np.zeros(half), where=bent)
            t = np.where(bent, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            g[:, a], g[:, b] = c * x - c * t * y, c * t * x + c * y
            turn = np.concatenate([turn[:1], turn[-1:], turn[1:-1]])
        if worst <= d * np.finfo(float).eps:
            break
    return g[:, :r]


@dataclass
class Fit:
    """Of the vectors of one length: their number, sums, and the leading components."""
    n: int
    sums: list[int]
    values: np.ndarray  # falling eigenvalues of the covariance
    components: np.ndarray  # a unit column for each
    trace: float

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n * y - sums, exact: as longs where they fit, else Python integers."""
        if self.n * max(int(np.abs(y).max(initial=0)), 1) < 1 << 62:
            return self.n * y - np.array(self.sums, np.int64)
        return self.n * y.astype(object) - np.array(self.sums, object)

    def whiten(self, y: np.ndarray) -> np.ndarray:
        return (self.centred(y) / self.n).astype(float) @ (self.components / np.sqrt(self.values))

    def deviations(self, y: np.ndarray) -> pa.Array:
        """Each row's sum of (n * y - sums)^2."""
        c = self.centred(y)
        top = int(np.abs(c).max(initial=0))
        if top * top * c.shape[1] < 1 << 63:
            return pa.array((c * c).sum(axis=1).astype(np.int64))
        exact = (c.astype(object) ** 2).sum(axis=1)
        return pa.array([int(x) if x < 1 << 63 else None for x in exact], pa.int64())


def solve(n: int, sums: list[int], products: np.ndarray, components: int = COMPONENTS) -> Fit:
    """The fit from exact moments (Python integers)."""
    s = np.array(sums, object)
    scatter = n * products - np.outer(s, s)
    covariance = (scatter / (n * n)).astype(float)
    l, order = pivoted_cholesky(covariance)
    g = orthogonal_columns(l)
    norms = np.sqrt((g * g).sum(axis=0))
    first = np.argsort(-norms, kind="stable")[:components]
    units = np.zeros((len(sums), len(first)))
    units[order] = g[:, first] / norms[first]
    return Fit(n, sums, norms[first] ** 2, units, float(int(scatter.trace()) / (n * n)))


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The fits of ``rows`` (id, v) by vector length."""
    sums = rows.mapInArrow(_moments, "dim int, i int, j int, total decimal(38,0)").groupBy("dim", "i", "j").agg(F.sum("total").alias("total"))
    found = {}
    for r in sums.collect():  # d * (d + 3) / 2 + 1 rows for vectors of length d
        found.setdefault(r.dim, {})[r.i, r.j] = int(r.total)
    out = {}
    for dim, total in found.items():
        products = np.array([[total[min(i, j), max(i, j)] for j in range(dim)] for i in range(dim)], object)
        out[dim] = solve(total[-1, -1], [total[-1, j] for j in range(dim)], products, components)
    return out


def identity_errors(rows: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """For each length, the largest absolute entry of the whitened rows' covariance minus the
    identity, measured on the rows."""
    sent = rows.sparkSession.sparkContext.broadcast(fits)

    def run(batches):
        held = {}
        for b in batches:
            for dim, _, m in by_length(b):
                w = sent.value[dim].whiten(scaled(m))
                sums, products = held.get(dim, (0.0, 0.0))
                held[dim] = sums + w.sum(axis=0), products + w.T @ w
        for dim, (sums, products) in held.items():
            i, j = np.triu_indices(len(sums))
            k = len(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k + len(i), dim, np.int32)), pa.array(np.concatenate([np.full(k, -1), i]).astype(np.int32)),
                 pa.array(np.concatenate([np.arange(k), j]).astype(np.int32)), pa.array(np.concatenate([sums, products[i, j]]))],
                names=["dim", "i", "j", "total"])

    sums = rows.mapInArrow(run, "dim int, i int, j int, total double").groupBy("dim", "i", "j").agg(F.sum("total").alias("total"))
    found = {}
    for r in sums.collect():  # at most COMPONENTS * (COMPONENTS + 3) / 2 rows a length
        found.setdefault(r.dim, {})[r.i, r.j] = r.total
    return {dim: max(abs(v / fits[dim].n - t[-1, i] * t[-1, j] / fits[dim].n ** 2 - (i == j)) for (i, j), v in t.items() if i >= 0)
            for dim, t in found.items()}


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """A row for each row of ``rows`` (id, v) and component."""
    sent = rows.sparkSession.sparkContext.broadcast((fits, identity_errors(rows, fits)))

    def run(batches):
        fits, errors = sent.value
        for b in batches:
            for dim, ids, m in by_length(b):
                f = fits[dim]
                k = len(f.values)
                if not k:
                    continue
                y = scaled(m)
                each = pa.array(np.repeat(np.arange(len(y)), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))), pa.array(np.full(len(each), f.n)),
                     f.deviations(y).take(each), pa.array(f.whiten(y).ravel()), pa.array(np.tile(f.values / f.trace, len(y))),
                     pa.array(np.full(len(each), errors[dim]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, _OUT)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(tk.read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return whiten(rows, fit(rows))
