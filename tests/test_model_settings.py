"""The registered model queries use the operators' whole settings (the fits themselves are not run here)."""

from types import SimpleNamespace

import pytest

from riskloom import config
from riskloom.catalog import q_models as Q


@pytest.fixture
def searched(spark, monkeypatch):
    """The settings that a query's search is given, without its fits."""
    data = spark.createDataFrame([(0.0, 0), (1.0, 0)], "label double, fold int")
    seen = []

    def search(est, maps, *_, **__):
        seen.extend({p.name: v for p, v in m.items()} for m in maps)
        return SimpleNamespace(getEstimatorParamMaps=lambda: maps, avgMetrics=[0.0] * len(maps))

    monkeypatch.setattr(Q, "_prepared", lambda *_: (SimpleNamespace(train=data), data))
    monkeypatch.setattr(Q.TU, "search", search)
    return seen


@pytest.mark.parametrize("query,rounds", [("random_search_forest", "numTrees"), ("random_search_boosting", "maxIter")])
def test_random_searches_draw_all_settings(spark, searched, query, rounds):
    assert getattr(Q, query)(spark, "").count() == config.RANDOM_SEARCH_DRAWS == len(searched)
    assert {s[rounds] for s in searched} == {100, 200, 300}


@pytest.mark.parametrize("query,n", [("random_search_gradient_boosting", 20), ("grid_search_logistic_full", 30),
                                     ("grid_search_forest", 6), ("grid_search_boosting", 144)])
def test_claimed_searches_try_their_settings(spark, searched, query, n):
    assert getattr(Q, query)(spark, "").count() == len(searched) == len({str(sorted(s.items())) for s in searched}) == n


class Stop(Exception):
    pass


def test_members_are_the_reference_s(spark, monkeypatch):
    data, fits = spark.createDataFrame([(0.0, 0), (1.0, 0)], "label double, fold int"), []

    def stop(*args, **options):
        fits.append((args, options))
        raise Stop

    monkeypatch.setattr(Q, "_prepared", lambda *_: (SimpleNamespace(train=data, test=data, names=[]), data))
    monkeypatch.setattr(Q.MD.RandomForestClassifier, "fit", lambda self, *_: stop(self))
    for query in (Q.forest_importance, Q.tree_paths):
        with pytest.raises(Stop):
            query(spark, "")
    assert [a[0].getNumTrees() for a, _ in fits] == [300, 300]
    monkeypatch.setattr(Q.MD, "stacking", stop)
    with pytest.raises(Stop):
        Q.stacking_evaluation(spark, "")
    members = fits[-1][0][1]
    assert list(members) == ["lr", "rf", "xgb"] and members["rf"].getNumTrees() == 300 and members["xgb"].getMaxIter() == 100
    fitted = {n: SimpleNamespace(fit=lambda *_, n=n: n) for n in config.VOTING_WEIGHTS}
    monkeypatch.setattr(Q, "default_estimators", lambda: fitted)
    monkeypatch.setattr(Q.MD, "score_with", stop)
    with pytest.raises(Stop):
        Q.voting_evaluation(spark, "")
    assert fits[-1][0][0] == dict(zip(["lr", "rf", "xgb"], config.VOTING_WEIGHTS, strict=True))


def test_selection_and_main_flow_use_the_reference_s_settings(monkeypatch):
    import inspect

    from riskloom import workflow
    from riskloom.operators import encode

    default = lambda f, name: inspect.signature(f).parameters[name].default
    assert default(encode.select_features_with_rfe, "num_trees") == 100 and default(encode.select_features_with_rfe, "step") == 1
    assert default(workflow.prepare, "method") == default(workflow.run, "method") == "advanced"
    given = []
    monkeypatch.setattr(Q, "view", lambda *_: None)
    monkeypatch.setattr(Q, "run", lambda *a, **o: given.append(o) or {"test_model_comparison_optimized": None})
    Q.workflow_reports(None, "")
    assert given == [{}]
