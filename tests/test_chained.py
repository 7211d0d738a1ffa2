"""Chained Bayesian ridge regressions against a plain row-by-row version."""

import numpy as np
import pytest

from riskloom.operators.impute import mice_imputation
from riskloom.plans import chained

RNG = np.random.default_rng(3)
FULL = RNG.normal(size=(300, 4)) @ RNG.normal(size=(4, 4)) + [5.0, -2.0, 0.0, 30.0]
HOLES = np.where(RNG.random(FULL.shape) < [0.05, 0.0, 0.2, 0.3], np.nan, FULL)


def plain_ridge(x, y, rounds=300, tol=1e-3, prior=1e-6):
    """Coefficients by the textbook updates on the centred rows."""
    noise, ridge, old = 1 / (np.var(y) + np.finfo(float).eps), 1.0, None
    values = np.linalg.svd(x, compute_uv=False) ** 2
    solve = lambda: np.linalg.solve(x.T @ x + ridge / noise * np.eye(x.shape[1]), x.T @ y)
    for _ in range(rounds):
        beta = solve()
        well = (noise * values / (ridge + noise * values)).sum()
        ridge = (well + 2 * prior) / ((beta**2).sum() + 2 * prior)
        noise = (len(y) - well + 2 * prior) / (((y - x @ beta) ** 2).sum() + 2 * prior)
        if old is not None and np.abs(old - beta).sum() < tol:
            break
        old = beta
    return solve()


def plain_imputer(holes, max_iter=10, tol=1e-3):
    null = np.isnan(holes)
    x = np.where(null, np.nanmean(holes, axis=0), holes)
    limit = tol * np.abs(holes[~null]).max()
    for _ in range(max_iter):
        before = x.copy()
        for c in sorted(range(x.shape[1]), key=lambda c: (null[:, c].sum(), c)):
            if null[:, c].any():
                others = [o for o in range(x.shape[1]) if o != c]
                a, b = x[~null[:, c]][:, others], x[~null[:, c], c]
                beta = plain_ridge(a - a.mean(0), b - b.mean())
                x[null[:, c], c] = b.mean() + (x[null[:, c]][:, others] - a.mean(0)) @ beta
        if np.abs(x - before).max() < limit:
            break
    return x


@pytest.fixture(scope="module")
def holes(spark):
    rows = [(i, "k", *(None if np.isnan(v) else float(v) for v in r)) for i, r in enumerate(HOLES)]
    return spark.createDataFrame(rows, "id string, `row` string, a double, b double, pattern double, c0 double").repartition(4)


def test_ridge_equals_the_textbook():
    x, y = HOLES[:, [1]], FULL[:, 0]
    x, y = np.column_stack([x - x.mean(), FULL[:, 2] - FULL[:, 2].mean()]), y - y.mean()
    assert np.allclose(chained.bayesian_ridge(len(y), x.T @ x, x.T @ y, float(y @ y)), plain_ridge(x, y), atol=1e-9)


@pytest.mark.parametrize("options", [{}, {"max_patterns": 2}, {"max_iter": 2}])
def test_mice_equals_the_plain_imputer(holes, options):
    got = np.array([list(r)[2:] for r in sorted(mice_imputation(holes, **options).collect(), key=lambda r: int(r.id))])
    want = plain_imputer(HOLES, options.get("max_iter", 10))
    assert np.allclose(got, want, atol=1e-6) and not np.allclose(want, plain_imputer(HOLES, 1), atol=1e-4)


def test_mice_of_odd_tables(spark, holes):
    assert mice_imputation(holes.where("false")).collect() == []
    full = holes.na.drop()
    assert sorted(mice_imputation(full).collect()) == sorted(full.collect())
    lone = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert all(r.b == 0.0 for r in mice_imputation(lone).collect())
