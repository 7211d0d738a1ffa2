"""Hand-computed micro-tables for the semantics traps."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom import config
from riskloom.functions.expr import cut, null_propagating_sum, null_skipping_sum, value_map, yes_no
from riskloom.operators import encode as EN
from riskloom.operators import impute as IM
from riskloom.operators import metrics as M
from riskloom.operators import models as MD
from riskloom.operators import quality as Q
from riskloom.plans.quantiles import exact_median, quantile_table


def test_half_open_bins(spark):
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 39.9, 40.0, 60.0, 100.0, None]], "v double")
    got = [r[0] for r in df.select(cut("v", [0, 40, 60, 100], ["0-40", "40-60", "60-100"])).collect()]
    assert got == [None, "0-40", "0-40", "40-60", "60-100", None, None]


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.2, 0.5, 1.0]], "v double")
    got = [r[0] for r in df.select(cut("v", config.RISK_LEVEL_BINS, config.RISK_LEVEL_LABELS, right=True)).collect()]
    assert got == [None, "Very Low", "Moderate", "Very High"]


def test_mode_tie_is_smallest(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "b", "a", None]], "v string")
    assert IM.mode_values(df, ["v"]) == {"v": "a"}


def test_even_median_interpolates(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0, None]], "v double")
    assert exact_median(df, ["v"]) == {"v": 2.5}


@pytest.mark.parametrize("rows_per_bucket", [1 << 20, 100])
def test_quantiles_match_numpy(spark, rows_per_bucket):
    import numpy as np

    vals = [float(x) for x in np.random.default_rng(1).normal(size=3000).round(3)]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(vals)], "g int, v double")
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))  # a null group is a group
    q = {r.g: r for r in quantile_table(df, ["v"], [0.1, 0.5, 0.9], ["g"], rows_per_bucket).collect()}
    for g in range(3):
        arr = np.array(vals[g::3])
        for i, p in enumerate((0.1, 0.5, 0.9)):
            assert q[g or None][f"q{i}"] == pytest.approx(float(np.quantile(arr, p)), abs=1e-12)


@pytest.mark.parametrize("rows_per_bucket", [1 << 20, 3])
def test_ranks_of_a_null_stratum(spark, rows_per_bucket):
    from riskloom.plans.running import exact_rank

    df = spark.createDataFrame([(None if i % 2 else 1, float(i)) for i in range(20)], "label int, v double")
    got = exact_rank(df, ["label"], [("v", True)], rows_per_bucket=rows_per_bucket).collect()
    for label in (None, 1):
        ranked = sorted((r.v, r["rank"]) for r in got if r.label == label)
        assert [n for _, n in ranked] == list(range(1, 11))


def test_null_slice_keeps_its_areas(spark):
    from riskloom.operators.fairness import compute_slice_metrics

    rows = [(i % 2, i % 3 % 2, i / 20, None if i < 10 else "a") for i in range(20)]
    df = spark.createDataFrame(rows, "label int, prediction int, score double, gender string")
    got = {r.slice_name: r for r in compute_slice_metrics(df, slice_features=["gender"]).collect()}
    assert got["gender_NaN"].slice_size == 10 and got["gender_NaN"].roc_auc is not None and got["gender_NaN"].pr_auc is not None


def test_nan_is_missing_in_imputers(spark):
    from riskloom.operators.impute import indicator_imputation, simple_imputation

    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "v double")
    assert sorted(r.v for r in simple_imputation(df).collect()) == [1.0, 2.0, 2.0, 3.0]
    assert sum(r.v_missing for r in indicator_imputation(df).collect()) == 2


@pytest.mark.parametrize("df,want", [(1, 12.706205), (4, 2.776445), (9, 2.262157), (29, 2.045230), (199, 1.971957)])
def test_t_quantile(df, want):
    from riskloom.operators.tune import t_quantile

    assert t_quantile(0.975, df) == pytest.approx(want, abs=1e-5)


def test_flat_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    out = EN.PopulationScaler(inputCols=["x"], outputCols=["z"]).fit(df).transform(df)
    assert [r.z for r in out.collect()] == [0.0, 0.0, 0.0]


def test_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    out = EN.PopulationScaler(inputCols=["x"], outputCols=["z"]).fit(df).transform(df)
    z = sorted(r.z for r in out.collect())
    assert z[2] == pytest.approx(1 / math.sqrt(2 / 3))


def test_unseen_level_all_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    test = spark.createDataFrame([("zz",), ("b",)], "c string")
    model = EN.preprocessing_pipeline([], ["c"]).fit(train)
    rows = model.transform(test).select("features").collect()
    assert rows[0].features.toArray().tolist() == [0.0, 0.0, 0.0]
    assert rows[1].features.toArray().tolist() == [0.0, 1.0, 0.0]


def _scored(spark, pairs):
    return spark.createDataFrame([(y, s, int(s >= 0.5)) for y, s in pairs],
                                 "label int, score double, prediction int")


def test_roc_pr_with_ties(spark):
    df = _scored(spark, [(1, .9), (0, .8), (1, .8), (0, .3), (1, .2), (0, .1)])
    r = M.evaluate(df).first()
    assert r.roc_auc == pytest.approx(0.722222, abs=1e-6)
    assert r.pr_auc == pytest.approx(0.794444, abs=1e-6)


def test_pr_anchor_top_mixed(spark):
    r = M.evaluate(_scored(spark, [(0, .9), (1, .9), (1, .7), (0, .1)])).first()
    assert r.pr_auc == pytest.approx(0.666667, abs=1e-6)


def test_pr_top_negative(spark):
    r = M.evaluate(_scored(spark, [(0, .9), (1, .8), (1, .7), (0, .1)])).first()
    assert r.pr_auc == pytest.approx(0.416667, abs=1e-6)


def test_no_positive_gives_zero_rates_and_null_auc(spark):
    r = M.evaluate(_scored(spark, [(0, .9), (0, .2), (0, .4)])).first()
    assert r.recall == 0.0 and r.precision == 0.0 and r.f1 == 0.0
    assert r.roc_auc is None and r.pr_auc is None


def test_constant_score_baseline_threshold(spark):
    low = _scored(spark, [(1, 0.0)] + [(0, 0.0)] * 4)       # positive share 0.2 < 0.21
    t, _ = M.find_optimal_threshold(low)
    assert t == 1.0
    high = _scored(spark, [(1, 0.0)] + [(0, 0.0)] * 3)      # share 0.25
    t, m = M.find_optimal_threshold(high)
    assert t == 0.0 and m["recall"] == 1.0 and m["min_precision_constraint"] == 0.21


def test_auc_invariant_under_monotone_transform(spark):
    pairs = [(1, .9), (0, .8), (1, .8), (0, .3), (1, .2), (0, .1), (1, .65)]
    a = M.evaluate(_scored(spark, pairs)).first().roc_auc
    b = M.evaluate(_scored(spark, [(y, s ** 3) for y, s in pairs])).first().roc_auc
    assert a == pytest.approx(b)


def test_yes_no_and_value_map(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("Maybe",), (None,)], "v string")
    assert [r[0] for r in df.select(yes_no("v")).collect()] == [1, 0, None, None]
    got = [r[0] for r in df.select(value_map("v", config.BINARY_MAP)).collect()]
    assert got == [1.0, 0.0, 0.0, None]


def test_row_sum_vs_plus(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(null_skipping_sum(["a", "b"])).collect()] == [1.0, 0.0]
    assert [r[0] for r in df.select(null_propagating_sum(["a", "b"])).collect()] == [None, None]


def test_duplicates_null_equals_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    r = Q.duplicate_count(df).first()
    assert (r.n_rows, r.n_unique, r.n_duplicates) == (3, 2, 1)


def test_imputation_keeps_observed_and_fills_all(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, None), (3, 4.0, "a"), (4, 7.0, "b")],
                               "k long, x double, s string")
    out = {r.k: r for r in IM.simple_imputation(df).collect()}
    assert out[1].x == 1.0 and out[3].x == 4.0 and out[2].x == 4.0 and out[2].s == "a"


def test_knn_matches_bruteforce(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        v = rng.normal(size=3).round(2).tolist()
        for j in range(3):
            if rng.random() < 0.15:
                v[j] = None
        rows.append((i, *v))
    df = spark.createDataFrame(rows, "k long, a double, b double, c double")
    got = {r.k: (r.a, r.b, r.c) for r in IM.knn_imputation(df, key="k", exclude=["k"]).collect()}
    cols = ["a", "b", "c"]
    X = [list(r[1:]) for r in rows]
    for i, r in enumerate(X):
        for j, v in enumerate(r):
            if v is not None:
                continue
            cands = []
            for d, y in enumerate(X):
                if y[j] is None:
                    continue
                s = [(r[t] - y[t]) ** 2 for t in range(3) if r[t] is not None and y[t] is not None]
                if s:
                    cands.append((math.sqrt(3 / len(s) * sum(s)), d, y[j]))
            cands.sort()
            exp = (sum(c[2] for c in cands[:5]) / len(cands[:5]) if cands
                   else np.mean([y[j] for y in X if y[j] is not None]))
            assert got[i][j] == pytest.approx(exp, abs=1e-9), (i, cols[j])


def test_majority_classifier_ties_lowest(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (0,)], "label int")
    assert MD.MajorityClassifier(labelCol="label").fit(df).majority == 0


def test_soft_vote_weights_select_one_model(spark):
    df = spark.createDataFrame([(0.9, 0.1), (0.2, 0.8)], "score_a double, score_b double")
    out = MD.voting(df, ["a", "b"], [1.0, 0.0]).collect()
    assert [r.score for r in out] == [0.9, 0.2] and [r.prediction for r in out] == [1, 0]


@pytest.mark.parametrize("n_cols,levels", [(30, 1000), (3, 2)])
def test_knn_equals_brute_force(spark, n_cols, levels):
    """Many columns, and many ties."""
    import random

    from riskloom.plans.knn import knn_impute

    rng = random.Random(n_cols)
    rows = [(i, *[None if j in (0, 2, 20, 29) and rng.random() < 0.3 else float(rng.randrange(levels)) for j in range(n_cols)])
            for i in range(70)]
    cols = [f"c{j}" for j in range(n_cols)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in cols))
    got = {r.id: r for r in knn_impute(df, "id", cols, 3).collect()}
    for r in rows[:25]:
        for j in range(n_cols):
            if r[1 + j] is None:
                found = []
                for d in rows:
                    shared = [(a - b) ** 2 for a, b in zip(r[1:], d[1:]) if a is not None and b is not None]
                    if d[1 + j] is not None and shared:
                        found.append((math.sqrt(n_cols / len(shared) * sum(shared)), d[0], d[1 + j]))
                near = [v for _, _, v in sorted(found)[:3]]
                assert got[r[0]][1 + j] == pytest.approx(sum(near) / len(near))


@pytest.mark.parametrize("kind,n", [("random_forest", 144), ("xgboost", 3888), ("gradient_boosting", 972)])
def test_draws_do_not_repeat(spark, kind, n):
    from riskloom.operators import tune as TU

    space, translate = TU.SPACES[kind]
    est = MD.random_forest_model() if kind == "random_forest" else MD.boosting_model()
    maps = TU.sampled_maps(est, space, translate, n_iter=20)
    assert len(maps) == 20 and len({str(sorted((p.name, v) for p, v in m.items())) for m in maps}) == 20
    assert len(TU.sampled_maps(est, space, translate, n_iter=10**6)) == n
