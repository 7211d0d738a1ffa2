"""k-NN imputation over many small leaves against brute force."""

import numpy as np
import pytest

from riskloom.plans.knn import Boxes, grow, knn_impute


def brute(x, k):
    """The imputed table, a row at a time; ties to the smaller row number."""
    n, p = x.shape
    out = x.copy()
    for i, j in zip(*np.nonzero(np.isnan(x)), strict=True):
        donors = np.flatnonzero(~np.isnan(x[:, j]))
        gap = x[donors] - x[i]
        shared = (~np.isnan(gap)).sum(1)
        donors, gap, shared = donors[shared > 0], gap[shared > 0], shared[shared > 0]
        d = np.sqrt(p / shared * np.nansum(gap ** 2, axis=1))
        near = donors[np.argsort(d, kind="stable")[:k]]
        out[i, j] = x[near, j].mean() if len(near) else np.nanmean(x[:, j])
    return out


def table(kind, n=500, p=4, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, p)) + 8 * rng.integers(0, 4, (n, 1))
    if kind == "levels":  # most distances are tied
        x = np.round(x / 4)
    if kind == "hot":  # a third of the rows is one vector, and far rows have no neighbours
        x[: n // 3] = 1.0
        x[-3:] = 1e6 * rng.standard_normal((3, p))
    x[rng.random((n, p)) < 0.12] = np.nan
    x[10] = np.nan
    return x


@pytest.mark.parametrize("kind", ["plain", "levels", "hot"])
def test_small_leaves_equal_brute_force(spark, kind):
    x = table(kind)
    cols = ["a", "b", "c", "d"]
    rows = [(i, *(None if np.isnan(v) else float(v) for v in r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double").repartition(7)
    got = np.array([list(r[1:]) for r in sorted(knn_impute(df, "id", cols, 3, leaf=32, block=16).collect())])
    assert np.allclose(got, brute(x, 3), rtol=1e-12, atol=1e-12)


def test_a_column_of_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, None), (3, None, 4.0)], "id long, a double, b double")
    assert sorted(map(tuple, knn_impute(df, "id", ["a", "b"]).collect())) == [(1, None, 2.0), (2, None, 3.0), (3, None, 4.0)]
    assert knn_impute(df.where("false"), "id", ["a", "b"]).collect() == []


def test_boxes_leave_out_no_neighbour_and_most_of_the_rest():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 3))
    x[rng.random(x.shape) < 0.05] = np.nan
    x = x[~np.isnan(x).all(1)]
    tree = grow(x, 64, 7)
    leaf = tree.leaves(x, False)
    assert set(leaf) == set(tree.leaf[tree.coord < 0]) and leaf.min() == 7
    names = np.unique(leaf)
    full = np.array([~np.isnan(x[leaf == m]).any(0) for m in names])
    low, high = (np.array([f(x[leaf == m], axis=0) for m in names]) for f in (np.min, np.max))
    some = np.array([(~np.isnan(x[leaf == m])).any(0) for m in names], dtype=float)
    boxes = Boxes(names, np.where(full, low, np.nan), np.where(full, high, np.nan), some)
    ask, r = x[:200], np.full(200, 0.3)
    met = 0
    for row, found in zip(ask, boxes.within(ask, r), strict=True):
        gap = x - row
        shared = (~np.isnan(gap)).sum(1)
        d = np.sqrt(3 / np.maximum(shared, 1) * np.nansum(gap ** 2, axis=1))
        assert set(leaf[(shared > 0) & (d <= 0.3)]) <= set(found)
        met += len(found)
    assert met < 0.4 * 200 * len(names)


def test_a_tree_ends_on_equal_and_infinite_values():
    x = np.array([[np.inf, 1.0]] * 50 + [[-np.inf, 1.0]] * 50 + [[0.0, 1.0]] * 3)
    assert len(np.unique(grow(x, 4, 0).leaves(x, False))) == 3
