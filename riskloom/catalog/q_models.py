"""Registered model, tuning and encoding queries (MD*, TU*, EN*).

Model fits have no SQL twin, so most entries are rows-only; the encoders
(EN2, EN4) and the majority baseline (MD1) have exact oracles.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from riskloom import config
from riskloom.catalog.q_features import _health_sql
from riskloom.catalog.registry import REGISTRY, register, table, view, view_sql
from riskloom.operators import encode as EN
from riskloom.operators import features as FE
from riskloom.operators import metrics as M
from riskloom.operators import models as MD
from riskloom.operators import tune as TU
from riskloom.operators.balance import with_class_weights
from riskloom.operators.boost import SecondOrderBoosting
from riskloom.session import ensure_checkpoint_dir, shared_dir
from riskloom.workflow import default_estimators, prepare, run, save_reports

_SHORT = ["lr", "rf", "xgb"]


def _prepared(spark, sf):
    p = prepare(view(spark, sf, "patients"))
    return p, with_class_weights(p.train, "label")


@register("baseline_majority",
          f"SELECT event_id, CAST((SELECT label FROM {view_sql('events_n')} AS e GROUP BY label "
          f"ORDER BY count(*) DESC, label LIMIT 1) AS DOUBLE) AS prediction FROM events",
          operators="MD1")
def baseline_majority(spark, sf):
    ev = view(spark, sf, "events_n")
    m = MD.MajorityClassifier(labelCol="label").fit(ev)
    return m.transform(ev).select("event_id", "prediction")


_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("population_scaler",
          "SELECT " + ", ".join(f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 "
                                f"THEN stddev_pop({c}) OVER () ELSE 1 END AS {c}__scaled" for c in _LI)
          + " FROM lineitem", [f"{c}__scaled" for c in _LI], "EN2")
def population_scaler(spark, sf):
    li = table(spark, sf, "lineitem").select(*_LI)
    m = EN.PopulationScaler(inputCols=_LI, outputCols=[f"{c}__scaled" for c in _LI]).fit(li)
    return m.transform(li).select(*[f"{c}__scaled" for c in _LI])


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("get_dummies",
          "SELECT o_orderkey, " + ", ".join(
              f"CAST(o_orderpriority = '{p}' AS INTEGER) AS \"o_orderpriority_{p}\"" for p in _PRIOS[1:])
          + " FROM orders", operators="EN4")
def get_dummies(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return EN.get_dummies(o, "o_orderpriority")


@register("exact_imputer_pipeline",
          "SELECT p_partkey, coalesce(p_size, (SELECT quantile_cont(p_size, 0.5) FROM "
          + view_sql("part_n") + " AS m)) AS p_size, coalesce(p_brand, (SELECT p_brand FROM "
          + view_sql("part_n") + " AS m WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY count(*) DESC, "
          "p_brand LIMIT 1)) AS p_brand FROM " + view_sql("part_n") + " AS p", operators="IM6, IM7")
def exact_imputer_pipeline(spark, sf):
    from pyspark.ml import Pipeline

    pn = view(spark, sf, "part_n").select("p_partkey", "p_size", "p_brand")
    pipe = Pipeline(stages=[EN.ExactImputer(inputCols=["p_size"], strategy="median"),
                            EN.ExactImputer(inputCols=["p_brand"], strategy="most_frequent")])
    return pipe.fit(pn).transform(pn)


def _reloaded(spark, model):
    """The fitted pipeline as another application would load it."""
    from pyspark.ml import PipelineModel

    path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    model.write().save(path)
    return PipelineModel.load(path)


@register("saved_preparation",
          "SELECT p_partkey, p_brand, p_size, (p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER () AS scaled FROM ("
          + REGISTRY["exact_imputer_pipeline"].sql + ") AS q", ["scaled"], "IM6, EN2, MD1")
def saved_preparation(spark, sf):
    """A fitted preparation, saved and loaded again, applied to the rows."""
    from pyspark.ml import Pipeline

    pn = view(spark, sf, "part_n").select("p_partkey", "p_size", "p_brand")
    pipe = Pipeline(stages=[EN.ExactImputer(inputCols=["p_size"], strategy="median"),
                            EN.ExactImputer(inputCols=["p_brand"], strategy="most_frequent"),
                            EN.PopulationScaler(inputCols=["p_size"], outputCols=["scaled"])])
    return _reloaded(spark, pipe.fit(pn)).transform(pn).select("p_partkey", "p_brand", "p_size", "scaled")


@register("saved_risk_scores",
          REGISTRY["medical_risk_score"].sql.replace("SELECT ", f"SELECT {_health_sql()} AS health_risk_score, ", 1),
          ["health_risk_score", *REGISTRY["medical_risk_score"].round_cols], "FE9, FE10")
def saved_risk_scores(spark, sf):
    """Both risk scores as stages of a pipeline that was saved and loaded again."""
    from pyspark.ml import PipelineModel

    stages = [FE.HealthRiskScore(), FE.MedicalRiskScore()]
    scored = _reloaded(spark, PipelineModel(stages)).transform(view(spark, sf, "patients"))
    return scored.select("health_risk_score", "age_risk", "bp_risk", "cholesterol_risk", "bmi_risk", "glucose_risk",
                         "diabetes_combined_risk", "cv_risk_score")


@register("logistic_coefficients", None, operators="MD2, MD6, EN1, EN3, EN5")
def logistic_coefficients(spark, sf):
    p, train = _prepared(spark, sf)
    return MD.analyze_coefficients(MD.logistic_model().fit(train), p.names)


@register("logistic_risk_levels", None, operators="MD10, FE14")
def logistic_risk_levels(spark, sf):
    p, train = _prepared(spark, sf)
    scored = MD.with_score(MD.logistic_model().fit(train).transform(p.test))
    return MD.risk_level_counts(scored)


@register("forest_importance", None, operators="MD3, MD7, AN11")
def forest_importance(spark, sf):
    from riskloom.operators.eda import top_importance

    p, train = _prepared(spark, sf)
    rf = MD.random_forest_model(weight="weight").fit(train)
    return top_importance(MD.feature_importance(rf, p.names).withColumnRenamed("importance", "Importance"))


@register("tree_paths", None, operators="MD9")
def tree_paths(spark, sf):
    import uuid

    p, train = _prepared(spark, sf)
    rf = MD.random_forest_model(weight="weight").fit(train)
    path = f"{ensure_checkpoint_dir(spark)}/tree-paths-{uuid.uuid4().hex}"
    return MD.analyze_tree_paths(rf, p.names, path)


@register("boosting_importance", None, operators="MD4, MD5, MD8")
def boosting_importance(spark, sf):
    p, train = _prepared(spark, sf)
    gbt = MD.boosting_model(n_estimators=100).fit(train)
    return MD.feature_importance(gbt, p.names)


_TREE_COLUMNS = ["age", "triglyceride_level", "fasting_blood_sugar", "crp_level", "homocysteine_level"]
_TREE_CUTS = {"age": range(25, 70, 5), "triglyceride_level": range(120, 300, 20), "fasting_blood_sugar": range(80, 160, 10),
              "crp_level": range(1, 10), "homocysteine_level": range(7, 19, 2)}
_TREE_LABEL = "CAST(heart_disease_status = 'Yes' AS INTEGER)"


def _tree_sql(depth=2):
    """One tree over fixed cut points: for every open node the sums by (feature, cut), the best split, the next level."""
    rows = (f"SELECT row_number() OVER () AS id, {_TREE_LABEL} AS label, " + ", ".join(_TREE_COLUMNS)
            + f" FROM {view_sql('patients')} AS v")
    cells = " UNION ALL ".join(f"SELECT {i} AS f, CAST(c AS DOUBLE) AS cut FROM (SELECT unnest({list(cuts)}) AS c) AS u"
                               for i, cuts in enumerate(_TREE_CUTS[c] for c in _TREE_COLUMNS))
    pick = "CASE s.f " + " ".join(f"WHEN {i} THEN r.{c}" for i, c in enumerate(_TREE_COLUMNS)) + " END"
    score = lambda g, h: f"power({g}, 2) / ({h} + 1)"
    parts = [f"r0 AS MATERIALIZED ({rows})", f"cells AS ({cells})",
             "n0 AS (SELECT *, 0 AS node, 0.5 - label AS g, CAST(0.25 AS DOUBLE) AS h FROM r0)"]
    for d in range(depth):
        pick_c = pick.replace("s.f", "c.f")
        parts += [
            f"t{d} AS (SELECT node, CAST(sum(g) AS DOUBLE) AS g, sum(h) AS h FROM n{d} GROUP BY node)",
            f"l{d} AS (SELECT r.node, c.f, c.cut, CAST(sum(r.g) AS DOUBLE) AS gl, sum(r.h) AS hl FROM n{d} AS r JOIN cells AS c ON {pick_c} <= c.cut "
            "GROUP BY r.node, c.f, c.cut)",
            f"w{d} AS (SELECT l.*, {score('gl', 'hl')} + {score('(t.g - gl)', '(t.h - hl)')} - {score('t.g', 't.h')} AS gain "
            f"FROM l{d} AS l JOIN t{d} AS t ON t.node = l.node WHERE hl >= 1 AND t.h - hl >= 1)",
            f"s{d} AS (SELECT * FROM w{d} WHERE gain > 1e-6 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, cut) = 1)",
            f"n{d + 1} AS (SELECT r.* REPLACE (2 * r.node + CASE WHEN {pick} <= s.cut THEN 1 ELSE 2 END AS node) FROM n{d} AS r "
            f"JOIN s{d} AS s ON s.node = r.node)"]
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_TREE_COLUMNS)) + " END"
    none = "CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
    out = [f"SELECT node, {names} AS feature, cut AS threshold, gain, CAST(NULL AS DOUBLE) AS weight FROM s{d}" for d in range(depth)]
    out += [f"SELECT node, {none}, -0.1 * g / (h + 1) FROM t{d} WHERE node NOT IN (SELECT node FROM s{d})" for d in range(depth)]
    out.append(f"SELECT node, {none}, -0.1 * sum(g) / (sum(h) + 1) FROM n{depth} GROUP BY node")
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(out)


@register("boosted_tree", _tree_sql(), ["threshold", "gain", "weight"], operators="MD4")
def boosted_tree(spark, sf):
    """The first tree of a fit over fixed cut points, all rows and columns: its nodes, gains and leaf weights."""
    from riskloom.operators.boost import SecondOrderModel
    from riskloom.plans import boosting as B

    rows = view(spark, sf, "patients").selectExpr(f"array({', '.join(_TREE_COLUMNS)}) AS features", f"{_TREE_LABEL} AS label")
    cuts = [np.array(_TREE_CUTS[c], dtype=float) for c in _TREE_COLUMNS]
    binned = B.bin_rows(rows, "features", "label", cuts)
    job = B.fit(binned, [B.Job(B.Setting(rounds=1, depth=2))])[0]
    nodes = SecondOrderModel(job, cuts).nodes(0)
    return spark.createDataFrame([(n, None if f is None else _TREE_COLUMNS[f], *rest) for n, f, *rest in nodes],
                                 "node int, feature string, threshold double, gain double, weight double")


@register("second_order_importance", None, operators="MD4, MD8")
def second_order_importance(spark, sf):
    p, train = _prepared(spark, sf)
    return MD.feature_importance(SecondOrderBoosting().fit(train), p.names)


@register("early_stopping", None, operators="MD4")
def early_stopping(spark, sf):
    """Rows of fold 0 stop the fit: the loss on them after each round, and whether the model keeps the round."""
    p, train = _prepared(spark, sf)
    est = SecondOrderBoosting(validationCol="held", patience=10, stepSize=0.3)
    model = est.fit(train.withColumn("held", F.col("fold") == 0))
    return spark.createDataFrame([(i, float(x), i <= model.rounds) for i, x in enumerate(model.losses)],
                                 "round int, validation_loss double, used boolean")


@register("permutation_importance", None, operators="MD7")
def permutation_importance(spark, sf):
    p, train = _prepared(spark, sf)
    lr = MD.logistic_model().fit(train)
    return MD.permutation_importance(lr, p.test, p.names)


@register("voting_evaluation", None, operators="MD11, MD13, EV2")
def voting_evaluation(spark, sf):
    p, train = _prepared(spark, sf)
    members, weights = default_estimators(), list(config.VOTING_WEIGHTS.values())
    s = MD.score_with({n: members[m].fit(train) for n, m in zip(_SHORT, config.VOTING_WEIGHTS, strict=True)}, p.test)
    soft = MD.voting(s, _SHORT, weights).withColumn("model", F.lit("soft"))
    hard = MD.voting(s, _SHORT, weights, "hard").withColumn("model", F.lit("hard"))
    both = soft.unionByName(hard).withColumn("label", F.col("label").cast("int"))
    return M.evaluate(both, by=["model"])


@register("stacking_evaluation", None, operators="MD12")
def stacking_evaluation(spark, sf):
    p, train = _prepared(spark, sf)
    members, meta, names = MD.stacking(train, dict(zip(_SHORT, default_estimators().values(), strict=True)))
    scored = MD.stack_score(p.test, members, meta, names).withColumn("label", F.col("label").cast("int"))
    return M.evaluate(scored)


@register("cv_summary", None, operators="TU7, TU2, EV6")
def cv_summary(spark, sf):
    p, train = _prepared(spark, sf)
    cv = TU.cross_validate_model(MD.logistic_model(), train, model_name="Logistic Regression")
    return M.compare_cv(cv)


@register("grid_search_logistic", None, operators="TU3")
def grid_search_logistic(spark, sf):
    p, train = _prepared(spark, sf)
    est = MD.logistic_model()
    maps = TU.grid(est, {"C": config.LR_TUNE_C})
    res = TU.search_results(TU.search(est, maps, train))
    return spark.createDataFrame([(float(s["C"]), r) for s, r in res], "C double, mean_recall double")


@register("search_metrics_logistic", None, operators="TU2")
def search_metrics_logistic(spark, sf):
    """Recall, F1 and ROC AUC of every C, from the same fits."""
    p, train = _prepared(spark, sf)
    est = MD.logistic_model()
    return TU.metric_table(spark, TU.search_metrics(est, TU.grid(est, {"C": config.LR_TUNE_C}), train))


@register("random_search_forest", None, operators="TU4")
def random_search_forest(spark, sf):
    p, train = _prepared(spark, sf)
    res = TU.search_results(TU.random_search("random_forest", MD.random_forest_model(weight="weight"), train))
    return spark.createDataFrame([(str(s), r) for s, r in res], "setting string, mean_recall double")


@register("random_search_boosting", None, operators="TU5, BA5")
def random_search_boosting(spark, sf):
    from riskloom.operators.balance import scale_pos_weight

    p, train = _prepared(spark, sf)
    est = SecondOrderBoosting(scalePosWeight=scale_pos_weight(train, "label"))
    res = TU.search_results(TU.random_search("second_order", est, train))
    return spark.createDataFrame([(str(s), r) for s, r in res], "setting string, mean_recall double")


def _settings(spark, cv_model):
    return spark.createDataFrame([(str(s), r) for s, r in TU.search_results(cv_model)], "setting string, mean_recall double")


@register("random_search_gradient_boosting", None, operators="TU6")
def random_search_gradient_boosting(spark, sf):
    p, train = _prepared(spark, sf)
    return _settings(spark, TU.random_search("gradient_boosting", MD.boosting_model(), train))


@register("grid_search_logistic_full", None, operators="TU1")
def grid_search_logistic_full(spark, sf):
    p, train = _prepared(spark, sf)
    est = MD.logistic_model()
    return _settings(spark, TU.search(est, TU.logistic_grid(est), train))


@register("grid_search_forest", None, operators="TU1")
def grid_search_forest(spark, sf):
    p, train = _prepared(spark, sf)
    est = MD.random_forest_model(weight="weight")
    return _settings(spark, TU.search(est, TU.forest_grid(est), train))


@register("grid_search_boosting", None, operators="TU1")
def grid_search_boosting(spark, sf):
    p, train = _prepared(spark, sf)
    est = SecondOrderBoosting()
    maps, data = TU.boosting_grid(est, train)
    return _settings(spark, TU.search(est, maps, data))


@register("select_features_model", None, operators="EN6")
def select_features_model(spark, sf):
    p, train = _prepared(spark, sf)
    _, keep = EN.select_features_with_model(train, "label")
    return spark.createDataFrame([(p.names[i],) for i in (keep or [])], "feature string")


@register("select_features_rfe", None, operators="EN7")
def select_features_rfe(spark, sf):
    pts = view(spark, sf, "patients").withColumn(
        "label", (F.col("heart_disease_status") == "Yes").cast("double"))
    from riskloom.operators.split import stratified_folds

    num = config.NUMERICAL_FEATURES
    data = stratified_folds(pts.na.fill(0.0, num), "label", num + ["gender"], 5)
    best, _ = EN.select_features_with_rfe(data, "label", num, min_features_to_select=5)
    return spark.createDataFrame([(c,) for c in best], "feature string")


@register("workflow_reports", None, operators="main flow")
def workflow_reports(spark, sf):
    return run(view(spark, sf, "patients"))["test_model_comparison_optimized"]


@register("report_files", None, operators="IO4, IO5, EV9")
def report_files(spark, sf):
    """The main flow's report files, written and read back line by line.

    The flow has the logistic model, its vote and the baseline, median
    imputation and no polynomials or cross-validation: the files are what this
    query is about.
    """
    import uuid

    reports = run(view(spark, sf, "patients"), method="simple", run_cv=False, polynomial=False,
                  estimators={"Logistic Regression": MD.logistic_model()})
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/reports-{uuid.uuid4().hex}"
    save_reports(reports, path)
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.regexp_extract(F.input_file_name(), r"/([a-z_]+[.](?:csv|md))/", 1).alias("report"), F.col("value").alias("line"))
    return lines
