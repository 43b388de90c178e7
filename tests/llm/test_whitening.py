"""Whitening against exact rational moments and numpy's eigenvectors; awkward vectors."""

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martlake.llm import whitening

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, n string, component string, id int"


def rows_of(spark, data):
    frame = spark.createDataFrame([(i, v, 1, "n", "c", 3) for i, v in data], SCHEMA)
    return whitening.vectors(frame, "vec_id", "embedding")


def test_query_is_brute_force(spark):
    out = whitening.op13_whitening(spark, SF).toPandas()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in r.embedding] for r in table], object)
    n, s = len(x), x.sum(axis=0)
    mean = np.array([Fraction(int(v), n) for v in s])
    z = np.array([[float(Fraction(int(a)) - m) for a, m in zip(row, mean)] for row in x])
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    want = z @ u / np.sqrt(e)
    assert len(out) == n * 32 and (out.n == n).all() and out.identity_error.nunique() == 1 and out.identity_error[0] < 1e-10
    by_id = {r.vec_id: k for k, r in enumerate(table)}
    k = out.vec_id.map(by_id).to_numpy()
    c = out.component.to_numpy() - 1
    got = np.empty((n, 32))
    got[k, c] = out.whitened
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * sign).max() < 1e-7
    assert np.allclose(out.explained, (e / np.trace(v))[c], rtol=1e-9)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    assert (out.deviation.to_numpy() == np.array(deviation)[k]).all()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 9), st.integers(1, 30), st.integers(0, 10_000), st.sampled_from([0, 3, 39]))
def test_solve(dim, n, seed, bits):
    rng = np.random.default_rng(seed)
    y = rng.integers(-5, 6, (n, dim)) << bits
    y[:, rng.integers(dim)] = 7  # a constant dimension
    products = sum(whitening._products(y[k:k + 4]) for k in range(0, n, 4))
    exact = y.astype(object)
    assert (products == exact.T @ exact).all()
    f = whitening.solve(n, list(exact.sum(axis=0)), products, dim)
    z = (y - y.mean(axis=0)) / 2.0 ** bits
    v = z.T @ z / n
    rank = np.linalg.matrix_rank(v, tol=1e-9)
    assert len(f.values) == rank
    assert np.allclose(f.values / 4.0 ** bits, np.linalg.eigvalsh(v)[::-1][:rank], rtol=1e-9, atol=1e-9)
    assert np.allclose(f.components.T @ f.components, np.eye(rank), atol=1e-10)
    w = f.whiten(y)
    assert np.allclose(w.T @ w / n, np.eye(rank), atol=1e-8)


def test_small_eigenvalues_keep_their_digits():
    """Graded columns: Jacobi on the factor finds small eigenvalues to relative precision."""
    rng = np.random.default_rng(3)
    grade = 10.0 ** -np.arange(8)
    b = rng.standard_normal((8, 8)) * 0.1 + np.eye(8)
    a = grade[:, None] * (b @ b.T) * grade
    l, order = whitening.pivoted_cholesky(a)
    assert np.allclose(l, np.tril(l)) and np.allclose(l @ l.T, a[order][:, order], rtol=1e-12, atol=0)
    g = whitening.orthogonal_columns(l)
    got = np.sort((g * g).sum(axis=0))
    # determinant and trace fix the product and the sum; each value has the grade of its row
    assert np.prod(got) == pytest.approx(np.prod(grade ** 2) * np.linalg.det(b) ** 2, rel=1e-10)
    assert got.sum() == pytest.approx(np.trace(a), rel=1e-12)
    assert (got / grade[::-1] ** 2 > 1e-2).all() and (got / grade[::-1] ** 2 < 1e2).all()


def test_awkward_vectors(spark):
    one = [0.5, -0.25, 1.0]
    data = [(1, one), (1, one), (None, [0.1, 0.2, 0.3]), (2, [0.0, 0.0, 0.0]), (3, None), (4, []), (5, [1.0, None, 0.0]),
            (6, [float("nan"), 0.0, 1.0]), (7, [float("-inf"), 0.0, 1.0]), (8, [1.0, 2.0]), (9, [-1.0, 2.0]), (10, [3.0])]
    rows = rows_of(spark, data)
    fits = whitening.fit(rows)
    assert {d: f.n for d, f in fits.items()} == {3: 4, 2: 2, 1: 1}
    out = whitening.whiten(rows, fits).collect()
    # four rows, three of them different: two components; two rows: one; a single row: none
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in out) == [
        (False, 1, 1), (False, 1, 1), (False, 1, 2), (False, 1, 2), (False, 2, 1), (False, 2, 2), (False, 8, 1), (False, 9, 1),
        (True, 0, 1), (True, 0, 2)]
    assert all(r.identity_error < 1e-9 for r in out)
    assert all(abs(r.whitened) == pytest.approx(1.0) for r in out if r.vec_id in (8, 9))
    assert {r.deviation for r in out if r.vec_id == 8} == {128 ** 2}
    none = rows.filter("id > 100")
    assert whitening.fit(none) == {} and whitening.whiten(none, {}).count() == 0


def test_large_entries(spark):
    rows = rows_of(spark, [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [0.0, 5.0])])
    out = whitening.whiten(rows, whitening.fit(rows)).collect()
    assert {r.deviation for r in out if r.vec_id == 1} == {None} and all(np.isfinite(r.whitened) for r in out)
