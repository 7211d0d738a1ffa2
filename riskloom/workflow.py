"""The reference's main flow, end to end, as one Spark program.

load -> profile -> clean/impute -> features -> exact stratified split ->
preprocess (fit on train) -> LR / forest / boosting (+ majority baseline,
soft vote) -> CV summary -> test metrics -> threshold search -> fairness
slices -> importance.  Every stage is a DataFrame or a fitted pyspark.ml
stage; the tables returned are the reference's report files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.functions.expr import numeric_columns, string_columns
from riskloom.operators import encode as EN
from riskloom.operators import features as FE
from riskloom.operators import impute as IM
from riskloom.operators import metrics as M
from riskloom.operators import models as MD
from riskloom.operators.fairness import compute_slice_metrics
from riskloom.operators.split import stratified_split_folds, train_test
from riskloom.session import cut_lineage, passing_tables, written
from riskloom.sources.io import export_report


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    names: list
    preprocess: object


def prepare(df: DataFrame, target: str = config.TARGET, method: str = "advanced",
            polynomial: bool = True, test_size: float = config.TEST_SIZE) -> Prepared:
    """Clean, derive features, split exactly, fit the preprocessing on train only."""
    cols = [F.col(f"`{c}`") for c in df.columns]

    def with_key(rows: DataFrame) -> DataFrame:
        # the key comes from the rows as they are: once imputed, different rows may be equal
        return rows.withColumn("row_key", F.concat_ws("-", F.hex(F.xxhash64(*cols)), F.hex(F.xxhash64(F.lit("riskloom"), *cols))))

    options = {"key": "row_key"} if method in ("knn", "advanced") else {}
    with passing_tables():
        clean = IM.clean_data(df, method, target, drop_null_target=True, exclude_target=True, add_key=with_key, **options)
        clean = written(clean.withColumn("label", F.col(target).cast("double")).drop(target))

        def derived(rows: DataFrame) -> DataFrame:
            return FE.engineer_features(rows) if polynomial else FE.compute_lipid_ratio(
                FE.create_interaction_features(FE.create_age_bands(rows)))

        def ranked(rows: DataFrame) -> DataFrame:
            return stratified_split_folds(rows, "label", ["row_key"], test_size, config.CV_FOLDS)

        if clean.count() > min(config.LARGE_ROWS, config.ROWS_PER_BUCKET):
            # features are many more columns and follow from a row: neither the rank's shuffle nor its table has them
            feats = derived(written(ranked(clean), rows_per_file=config.ROWS_PER_FILE))
        else:
            feats = cut_lineage(ranked(derived(clean)))
        train, test = train_test(feats)
        num = numeric_columns(train, exclude=["label", "row_key", "fold"])
        cat = string_columns(train, exclude=["label", "row_key"])
        pre = EN.preprocessing_pipeline(num, cat).fit(train)
        # every fit reads these: the encoded rows are written once, with their feature names
        train_x, test_x = (written(pre.transform(part).select("row_key", "label", "fold", "features", *cat), kept=True)
                           for part in (train, test))
    return Prepared(train_x, test_x, EN.feature_names(train_x), pre)


def default_estimators(weight_col: str = "weight") -> dict:
    return {
        "Logistic Regression": MD.logistic_model(),
        "Random Forest": MD.random_forest_model(weight=weight_col),
        "XGBoost": MD.boosting_model(),
    }


def run(df: DataFrame, target: str = config.TARGET, method: str = "advanced", run_cv: bool = True,
        polynomial: bool = True, estimators: dict | None = None) -> dict[str, DataFrame]:
    """Run the main flow; returns the report tables by name."""
    from riskloom.operators.balance import with_class_weights
    from riskloom.operators.tune import cross_validate_model

    prep = prepare(df, target, method, polynomial)
    train, test = with_class_weights(prep.train, "label"), prep.test  # the fits keep what they read again
    est = estimators or default_estimators()
    reports: dict[str, DataFrame] = {}
    if run_cv:
        cv = None
        for name, e in est.items():
            part = cross_validate_model(e, train, model_name=name)
            cv = part if cv is None else cv.unionByName(part)
        reports["cv_model_comparison"] = M.compare_cv(cv)
    fitted = {name: e.fit(train) for name, e in est.items()}
    fitted_base = MD.MajorityClassifier(labelCol="label").fit(train)
    short = {"Logistic Regression": "lr", "Random Forest": "rf", "XGBoost": "xgb"}
    scored = MD.score_with({short.get(n, n): m for n, m in fitted.items()}, test)
    scored = MD.voting(scored, [short.get(n, n) for n in est],
                       [config.VOTING_WEIGHTS.get(n, 1.0) for n in est])
    scored = scored.withColumnsRenamed({"score": "score_vote", "prediction": "pred_vote"})
    scored = fitted_base.transform(scored).drop("probability").withColumnsRenamed(
        {"score": "score_base", "prediction": "pred_base"})
    scored = scored.drop("features", "rawPrediction").cache()
    models = [short.get(n, n) for n in est] + ["vote", "base"]
    long = None
    for m in models:
        part = scored.select(F.lit(m).alias("model"), "label", F.col(f"score_{m}").alias("score"),
                             F.col(f"pred_{m}").cast("int").alias("prediction"),
                             *[c for c in config.FAIRNESS_SLICES if c in scored.columns])
        long = part if long is None else long.unionByName(part)
    long = long.withColumn("label", F.col("label").cast("int")).cache()
    raw = M.evaluate(long, by=["model"])
    metric_names = ["recall", "accuracy", "precision", "f1", "f_beta", "roc_auc", "pr_auc"]
    reports["test_model_comparison_raw"] = M.compare_models(M.tidy(raw, ["model"], metric_names),
                                                            "recall", metric_names)
    opt_rows = []
    for m in models:
        t, mets = M.find_optimal_threshold(long.where(F.col("model") == m))
        opt_rows.append((m, t, mets["min_precision_constraint"],
                         *[float(mets[k]) if mets[k] is not None else None for k in metric_names]))
    spark = df.sparkSession
    ddl = "model string, optimal_threshold double, min_precision_constraint double, " + ", ".join(
        f"{k} double" for k in metric_names)
    opt = spark.createDataFrame(opt_rows, ddl)
    reports["test_model_comparison_optimized"] = opt.orderBy(F.desc_nulls_last("recall"), "model")
    best = reports["test_model_comparison_optimized"].first()
    best_scored = M.apply_threshold(long.where(F.col("model") == best["model"]), "score",
                                    best["optimal_threshold"])
    reports["fairness_report"] = compute_slice_metrics(best_scored)
    if "Logistic Regression" in fitted:
        reports["logistic_coefficients"] = MD.analyze_coefficients(fitted["Logistic Regression"], prep.names)
    if "Random Forest" in fitted:
        reports["random_forest_feature_importance"] = MD.feature_importance(fitted["Random Forest"], prep.names)
    if "XGBoost" in fitted:
        reports["xgboost_feature_importance"] = MD.feature_importance(fitted["XGBoost"], prep.names)
    # IO6: the best model's own table; the vote and the baseline have none
    of_model = {"lr": "logistic_coefficients", "rf": "random_forest_feature_importance", "xgb": "xgboost_feature_importance"}
    if of_model.get(best["model"]) in reports:
        reports["best_model_importance"] = reports[of_model[best["model"]]]
    return reports


def save_reports(reports: dict[str, DataFrame], path: str) -> None:
    """IO4-IO6: every report as CSV below ``path``, the fairness table as markdown too."""
    for name, table in reports.items():
        export_report(table, f"{path}/{name}.csv", "csv")
    if "fairness_report" in reports:
        export_report(reports["fairness_report"], f"{path}/fairness_report.md", "markdown")
