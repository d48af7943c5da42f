import math

import numpy as np
import pytest

from tarmac.llm.whitening import deviations, one_sided_jacobi, pivoted_cholesky, whiten

SCHEMA = "vec_id long, embedding array<double>, x string, component int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 9) for i, v in vectors], SCHEMA).repartition(3)


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    for d, rank in ((1, 1), (7, 7), (12, 4), (30, 29)):
        b = rng.normal(size=(d, rank)) * np.logspace(0, -3, rank)
        a = b @ b.T
        factor = pivoted_cholesky(a)
        assert factor.shape[1] == rank and np.allclose(factor @ factor.T, a, atol=1e-13 * np.trace(a))
        values, columns = one_sided_jacobi(factor)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-6, atol=0)
        assert np.allclose(columns.T @ columns, np.eye(rank), atol=1e-12)
        assert np.allclose(a @ columns, columns * values, atol=1e-13 * np.trace(a))
    assert pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    assert len(one_sided_jacobi(np.zeros((3, 0)))[0]) == 0


def test_small_eigenvalues_keep_their_digits():
    q, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(5, 5)))
    factor = q * np.array([1, 1e-2, 1e-4, 1e-5, 1e-6])
    assert np.allclose(one_sided_jacobi(factor)[0], [1, 1e-4, 1e-8, 1e-10, 1e-12], rtol=1e-8)


def brute(x):
    fit = np.unique(x, axis=0).astype(float)
    y = fit - fit.mean(axis=0)
    cov = y.T @ y / len(fit)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    return len(fit), (x - fit.mean(axis=0)) @ vectors / np.sqrt(values), values / np.trace(cov)


def test_against_eigh(spark):
    rng = np.random.default_rng(7)
    c = rng.normal(size=(300, 9)) * np.linspace(3, 0.2, 9)
    c[40:140] = c[40]  # a third of all rows is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(c)] + [(3, c[3].tolist())]  # and a repeated row
    odd = [(900, None), (901, [1.0] * 8 + [None]), (902, [math.nan] * 9), (903, [math.inf] + [0.0] * 8),
           (904, [1e300] * 9), (905, []), (906, [1.0] * 8), (None, c[5].tolist())]
    got = whiten(frame(spark, rows + odd)).toPandas()
    x = np.floor(256 * c).astype(np.int64)
    n, white, explained = brute(x)
    assert len(got) == 4 * 302 and got.n.eq(n).all() and set(got.component) == {1, 2, 3, 4}
    sums = np.unique(x, axis=0).sum(axis=0)
    sign = None
    for vec_id, rows_ in got.sort_values("component").groupby("vec_id", dropna=False):
        at = 5 if vec_id != vec_id else int(vec_id)
        assert rows_.deviation.eq(((n * x[at] - sums) ** 2).sum()).all()
        values = rows_.whitened.to_numpy().reshape(-1, 4, order="F")
        sign = np.sign(values[0] * white[at]) if sign is None else sign
        assert np.allclose(values, sign * white[at], atol=1e-9)
    assert np.allclose(got.sort_values("component").explained.unique(), explained, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_rank_and_empty_cases(spark):
    same = whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert len(same) == 4 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {
        (1, 0, None, 0.0, None)}
    line = whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)])).collect()
    assert len(line) == 15
    for r in line:
        want = abs(r.vec_id - 2) / math.sqrt(2) if r.component == 1 else None
        assert r.whitened is None if want is None else abs(abs(r.whitened) - want) < 1e-12
        assert abs(r.explained - (r.component == 1)) < 1e-12 and r.identity_error < 1e-12
    assert whiten(frame(spark, [(1, None)])).count() == 0
    assert whiten(frame(spark, [(1, None)]).filter("false")).columns == list(line[0].asDict())


def test_deviation_is_exact_or_null():
    x = np.array([[3, -4], [2**40, 0]])
    assert deviations(x, 10, [5, 7]) == [25**2 + 47**2, None]
    assert deviations(x[:1] * 10**8, 10, [5, 7]) == [(3 * 10**9 - 5) ** 2 + (4 * 10**9 + 7) ** 2 if
                                                    (3 * 10**9 - 5) ** 2 + (4 * 10**9 + 7) ** 2 < 2**63 else None]


def test_too_many_dimensions(spark):
    with pytest.raises(ValueError, match="dimensions"):
        whiten(frame(spark, [(1, [0.0] * 3000)]))
