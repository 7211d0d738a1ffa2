"""Nearest rows by the pivot index against brute force."""

import numpy as np
import pytest

from riskloom.plans import pivots

RNG = np.random.default_rng(5)


def brute(keys, x, k):
    out = {}
    for i, a in enumerate(x):
        d = np.sqrt(((x - a) ** 2).sum(1))
        order = sorted((d[j], keys[j]) for j in range(len(x)) if j != i)[:k]
        out[keys[i]] = [n for _, n in order]
    return out


def found(spark, keys, x, k, **options):
    kind = "string" if isinstance(keys[0], str) else "long"
    frame = spark.createDataFrame([(n, v.tolist()) for n, v in zip(keys, x, strict=True)], f"key {kind}, x array<double>").repartition(5)
    out: dict = {}
    at = dict(zip(keys, x, strict=True))
    for r in sorted(pivots.nearest_rows(frame, "key", "x", k, **options).collect(), key=lambda r: r.nbr_rank):
        assert (np.array(r.nbr_features) == at[r.nbr_key]).all()
        out.setdefault(r.key, []).append(r.nbr_key)
    return out


@pytest.mark.parametrize("size", [16, 1024])
def test_nearest_rows_of_clusters_ties_and_copies(spark, size):
    centres = RNG.normal(scale=20, size=(6, 5))
    x = np.vstack([c + RNG.normal(size=(40, 5)) for c in centres] + [np.round(RNG.normal(size=(40, 5))), np.tile(centres[0], (60, 1))])
    keys = RNG.permutation(len(x)).tolist()
    assert found(spark, keys, x, 5, size=size) == brute(keys, x, 5)


def test_few_rows_and_text_keys(spark):
    x = np.array([[0.0, 0.0], [0.0, 1.0], [5.0, 5.0]])
    assert found(spark, ["a", "b", "c"], x, 2) == {"a": ["b", "c"], "b": ["a", "c"], "c": ["b", "a"]}


def test_far_blocks_are_not_compared(spark, monkeypatch):
    """Of well separated clusters only the blocks of one cluster meet."""
    centres = np.eye(8) * 1000
    x = np.vstack([c + RNG.normal(size=(64, 8)) for c in centres])
    seen = []
    real = pivots.written
    monkeypatch.setattr(pivots, "written", lambda df: seen.append(df.columns) or (seen.append(df.count()) if df.columns == ["block", "other"] else None) or real(df))
    keys = list(range(len(x)))
    assert found(spark, keys, x, 3, size=32) == brute(keys, x, 3)
    pairs = next(n for n in seen if isinstance(n, int))
    assert pairs < 16 * 16 / 2
