"""Second-order boosting against a plain numpy version, and searches that share their scans."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from riskloom.operators import tune
from riskloom.operators.boost import SecondOrderBoosting, SharedSearch
from riskloom.plans import boosting as B

RNG = np.random.default_rng(7)
X = np.round(RNG.normal(size=(600, 4)), 1)
Y = ((X[:, 0] + 0.5 * X[:, 1] * X[:, 2] + RNG.normal(scale=0.4, size=600)) > 0).astype(int)
FOLD = np.arange(600) % 3
CUTS = [np.array([-1.0, -0.5, 0.0, 0.5, 1.0])] * 4


@pytest.fixture(scope="module")
def rows(spark):
    data = [(Vectors.dense(x), int(y), int(f)) for x, y, f in zip(X.tolist(), Y, FOLD, strict=True)]
    data.append((Vectors.dense([0.0] * 4), None, 0))
    return spark.createDataFrame(data, ["features", "label", "fold"]).repartition(5)


def plain_fit(x, y, s):
    """The same trees, node by node over single rows."""
    margin, trees = np.zeros(len(y)), []
    weight = np.where(y == 1, s.positive_weight, 1.0)
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - y) * weight, np.maximum(p * (1 - p), 1e-16) * weight
        score = lambda r, g=g, h=h: g[r].sum() ** 2 / (h[r].sum() + s.reg_lambda)

        def grow(r, depth, g=g, h=h, score=score):
            best = (1e-6, None, None)
            for f in range(x.shape[1] if depth else 0):
                for cut in CUTS[f]:
                    left = r & (x[:, f] <= cut)
                    right = r & ~left
                    if h[left].sum() >= s.min_child_weight and h[right].sum() >= s.min_child_weight:
                        gain = score(left) + score(right) - score(r)
                        if gain > best[0] + 1e-9:
                            best = (gain, f, cut)
            gain, f, cut = best
            value = -s.rate * g[r].sum() / (h[r].sum() + s.reg_lambda)
            if f is None:
                return value
            left, right = grow(r & (x[:, f] <= cut), depth - 1), grow(r & (x[:, f] > cut), depth - 1)
            if gain < s.gamma and not isinstance(left, tuple) and not isinstance(right, tuple):
                return value
            return (f, cut, left, right)

        tree = grow(np.ones(len(y), bool), s.depth)
        trees.append(tree)

        def value(row, t):
            while isinstance(t, tuple):
                t = t[2] if row[t[0]] <= t[1] else t[3]
            return t

        margin += np.array([value(row, tree) for row in x])
    return margin


SETTINGS = [B.Setting(rounds=3, depth=2, rate=0.3), B.Setting(rounds=7, depth=3, min_child_weight=5, positive_weight=2.5),
            B.Setting(rounds=2, depth=4, gamma=3.0, reg_lambda=0.1)]


def test_all_jobs_of_one_scan_equal_plain_fits(rows):
    binned = B.bin_rows(rows, "features", "label", CUTS, "fold")
    jobs = B.fit(binned, [B.Job(s, f) for s in SETTINGS for f in (None, 1)])
    for job in jobs:
        seen = FOLD != job.fold if job.fold is not None else np.ones(600, bool)
        assert len(job.trees) == job.setting.rounds
        bins = np.array([np.searchsorted(c, X[:, i], "left") for i, c in enumerate(CUTS)], dtype=np.uint8)
        margin = sum(t.weight[t.places(bins, job.setting.depth)] for t in job.trees)
        assert np.allclose(margin[seen], plain_fit(X[seen], Y[seen], job.setting), atol=1e-8)


def test_draws_take_their_shares():
    job = B.Job(B.Setting(subsample=0.8, colsample=0.5))
    assert len(job.columns(10)) == 5 and abs(job.drawn(3, 100_000).mean() - 0.8) < 0.01
    assert (job.drawn(3, 1000) == job.drawn(3, 1000)).all() and (job.drawn(3, 1000) != job.drawn(4, 1000)).any()


def test_model_scores_rows(rows):
    est = SecondOrderBoosting(maxIter=6, maxDepth=3, subsamplingRate=1.0, colsampleByTree=1.0, stepSize=0.3)
    model = est.fit(rows)
    out = model.transform(rows.where("label is not null")).select("label", "prediction", "probability").collect()
    assert sum(r.label == r.prediction for r in out) > 0.8 * 600
    assert all((r.probability[1] > 0.5) == (r.prediction == 1) for r in out)
    shares = model.featureImportances.toArray()
    assert abs(shares.sum() - 1) < 1e-9 and shares.argmax() == 0


def test_early_stopping_keeps_the_best_round(rows):
    est = SecondOrderBoosting(maxIter=60, maxDepth=4, stepSize=0.8, patience=3, validationCol="held")
    model = est.fit(rows.selectExpr("*", "fold = 0 AS held"))
    assert 0 < model.rounds < 60 and model.losses[model.rounds] == min(model.losses)
    assert len(model.losses) == model.rounds + 4 and len(model.trees) == model.rounds


def test_search_scores_every_setting_and_fold(rows):
    data = rows.where("label is not null")
    est = SecondOrderBoosting(maxIter=4, maxDepth=2, subsamplingRate=1.0, colsampleByTree=1.0)
    maps = tune.grid(est, {"stepSize": [0.1, 0.5], "scalePosWeight": [1.0, 4.0]})
    found = tune.search(est, maps, data)
    assert isinstance(found, SharedSearch) and len(found.rows) == 4 * 3
    assert {"recall", "f1", "roc_auc"} <= set(found.rows[0])
    by_map = dict(zip([(m[est.stepSize], m[est.scalePosWeight]) for m in found.maps], found.avgMetrics, strict=True))
    assert by_map[0.5, 4.0] > by_map[0.5, 1.0]
    alone = []
    for f in range(3):
        model = est.copy(maps[0]).fit(data.where(f"fold <> {f}"))
        test = model.transform(data.where(f"fold = {f}")).collect()
        alone.append(sum(r.label == r.prediction == 1 for r in test) / sum(r.label for r in test))
    assert abs(found.avgMetrics[0] - np.mean(alone)) < 0.05  # cut points come from all rows there, from the folds' here
    assert len(found.bestModel.trees) == 4


def test_no_rows_and_no_features(spark, rows):
    assert B.fit(B.bin_rows(rows.where("false"), "features", "label", CUTS), [B.Job(B.Setting(rounds=2))])[0].trees != []
    model = SecondOrderBoosting(maxIter=2).fit(rows.where("false"))
    assert model.trees == [] and [r.prediction for r in model.transform(rows.limit(1)).collect()] == [0.0]


def test_every_metric_of_a_search_comes_from_the_same_fits(spark, rows):
    from riskloom.operators.metrics import evaluate
    from riskloom.operators.models import logistic_model, with_score

    data = rows.where("label is not null")
    est = logistic_model()
    maps = tune.grid(est, {"C": [0.001, 1.0]})
    found = tune.search_metrics(est, maps, data)
    assert len(found.rows) == 2 * 3
    model = est.copy(maps[1]).fit(data.where("fold <> 2"))
    scored = with_score(model.transform(data.where("fold = 2"))).selectExpr("label", "score", "cast(prediction as int) prediction")
    alone = evaluate(scored, "label", "prediction", "score").first()
    same = next(r for r in found.rows if r["setting"] == 1 and r["fold"] == 2)
    assert all(abs(same[m] - alone[m]) < 1e-9 for m in ("recall", "f1", "roc_auc"))
    table = tune.metric_table(spark, found).collect()
    assert len(table) == 6 and sum(r.best for r in table) == 3
    assert found.bestModel.coefficients.size == 4


def test_sums_of_a_job_need_no_table_of_all_values():
    """Gradients are summed a column at a time, over drawn rows and columns only; sums as of single rows."""
    import tracemalloc

    rng, n, features = np.random.default_rng(3), 2000, 90
    bins = rng.integers(0, 8, (features, n)).astype(np.uint8)
    label = (rng.random(n) < 0.3).astype(np.uint8)
    block = B.Block({"block": 1, "n": n, "bins": bins.tobytes(), "label": label.tobytes(), "fold": np.zeros(n, np.int16).tobytes(),
                     "held": np.zeros(n, np.uint8).tobytes(), "margins": b""}, features, 1)
    job = B.Job(B.Setting(subsample=0.7, colsample=0.5, positive_weight=2.0))
    job.begin()
    job.tree.feature[0], job.tree.bin[0], job.level, job.open = 4, 3, 1, [1, 2]
    tracemalloc.start()
    found = dict(B.job_sums(block, 0, job, np.arange(features + 1) * 8))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < features * n * 8
    weight = np.where(label == 1, 2.0, 1.0)
    for node, rows in ((1, bins[4] <= 3), (2, bins[4] > 3)):
        rows = rows & job.drawn(1, n)
        g, h = ([[(v * weight)[rows & (bins[f] == b)].sum() for b in range(8)] for f in job.columns(features)]
                for v in (0.5 - label, np.full(n, 0.25)))
        np.testing.assert_allclose(found[node].reshape(2, -1), [np.ravel(g), np.ravel(h)], rtol=1e-12, atol=1e-12)
