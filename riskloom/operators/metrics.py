"""Classifier evaluation as aggregations (EV1-EV7, AN9, AN10).

Inputs are scored rows: a 0/1 ``label``, a 0/1 ``prediction`` and/or a
``score`` (probability of class 1), plus optional grouping columns (model,
fold, slice).  Everything is grouped by ``by``, so one job evaluates many
models or slices at once.

Curves follow the usual exact definitions: rows are first aggregated to
distinct scores (ties grouped), cumulative counts run in descending score
order (``plans.running_totals``: bucketed, never a single-task window), and
the areas are sums over curve points where the previous point is the
running total minus the current group, so no ``lag`` window is needed.
The PR curve starts at the anchor (recall 0, precision 1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.plans.running import null_safe_join, running_totals


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    """EV1: ``tn, fp, fn, tp`` per group, labels fixed to [0, 1]."""
    y, p = F.col(label), F.col(pred)

    def cnt(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")

    return df.groupBy(*by).agg(
        cnt((y == 0) & (p == 0)).alias("true_negatives"),
        cnt((y == 0) & (p == 1)).alias("false_positives"),
        cnt((y == 1) & (p == 0)).alias("false_negatives"),
        cnt((y == 1) & (p == 1)).alias("true_positives"))


def rates(conf: DataFrame, beta: float = config.F_BETA) -> DataFrame:
    """Accuracy, recall, precision, F1, F-beta from confusion counts (0 on 0/0)."""
    tp, tn = F.col("true_positives"), F.col("true_negatives")
    fp, fn = F.col("false_positives"), F.col("false_negatives")
    b2 = float(beta) ** 2
    return conf.withColumns({
        "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
        "recall": _ratio(tp, tp + fn),
        "precision": _ratio(tp, tp + fp),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "f_beta": _ratio((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp),
    })


def curve_points(df: DataFrame, label: str = "label", score: str = "score",
                 by: Sequence[str] = (), n_rows: int | None = None) -> DataFrame:
    """EV3/EV4 points: one row per (group, distinct score), descending.

    Columns: ``by..., threshold, tp_at, fp_at, cum_tp, cum_fp, n_pos, n_neg,
    tpr, fpr, precision, recall``.  Predicting positive for ``score >=
    threshold`` gives ``cum_tp`` true and ``cum_fp`` false positives.
    """
    by = list(by)
    if not by:  # a constant group keeps one code path (and no cross join)
        return curve_points(df.withColumn("_all", F.lit(0)), label, score, ["_all"], n_rows).drop("_all")
    y = F.col(label)
    pts = (df.where(F.col(score).isNotNull())
           .groupBy(*by, F.col(score).alias("threshold"))
           .agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("tp_at"),
                F.sum(F.when(y == 1, 0).otherwise(1)).cast("long").alias("fp_at")))
    if n_rows is None:
        n_rows = pts.count()
    cum = running_totals(pts, by, [("threshold", False)],
                         {"cum_tp": F.col("tp_at"), "cum_fp": F.col("fp_at")}, n_rows=n_rows)
    totals = pts.groupBy(*by).agg(F.sum("tp_at").alias("n_pos"), F.sum("fp_at").alias("n_neg"))
    out = null_safe_join(cum, totals, by)
    P, N = F.col("n_pos"), F.col("n_neg")
    return out.withColumns({
        "tpr": F.when(P > 0, F.col("cum_tp") / P),
        "fpr": F.when(N > 0, F.col("cum_fp") / N),
        "precision": F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp")),
        "recall": F.when(P > 0, F.col("cum_tp") / P).otherwise(F.lit(1.0)),
    })


def auc_from_points(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC and PR AUC (trapezoid, PR anchored at (0, 1)) per group.

    Both are null when the group lacks a class (single-class slice).
    """
    tp, fp = F.col("tp_at"), F.col("fp_at")
    ctp, cfp = F.col("cum_tp"), F.col("cum_fp")
    P, N = F.col("n_pos"), F.col("n_neg")
    prev_tp, prev_fp = ctp - tp, cfp - fp
    prec = ctp / (ctp + cfp)
    prev_prec = F.when(prev_tp + prev_fp > 0, prev_tp / (prev_tp + prev_fp)).otherwise(F.lit(1.0))
    roc_term = fp.cast("double") * (2 * ctp - tp)
    pr_term = tp.cast("double") * (prec + prev_prec) / 2
    agg = points.groupBy(*by).agg(F.sum(roc_term).alias("_roc"), F.sum(pr_term).alias("_pr"),
                                  F.first("n_pos").alias("n_pos"), F.first("n_neg").alias("n_neg"))
    ok = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return agg.select(*by,
                      F.when(ok, F.col("_roc") / (2.0 * F.col("n_pos") * F.col("n_neg"))).alias("roc_auc"),
                      F.when(ok, F.col("_pr") / F.col("n_pos")).alias("pr_auc"))


def evaluate(df: DataFrame, label: str = "label", pred: str = "prediction",
             score: str | None = "score", by: Sequence[str] = (),
             beta: float = config.F_BETA) -> DataFrame:
    """EV2: all metrics per group, wide.

    ``accuracy, recall, precision, f1, f_beta, true_positives,
    true_negatives, false_positives, false_negatives[, roc_auc, pr_auc]``.
    """
    by = list(by)
    if not by:
        return evaluate(df.withColumn("_all", F.lit(0)), label, pred, score, ["_all"], beta).drop("_all")
    m = rates(confusion(df, label, pred, by), beta)
    if score is not None:
        aucs = auc_from_points(curve_points(df, label, score, by), by)
        m = null_safe_join(m, aucs, by, "left")
    cols = ["accuracy", "recall", "precision", "f1", "f_beta", "true_positives",
            "true_negatives", "false_positives", "false_negatives"]
    if score is not None:
        cols += ["roc_auc", "pr_auc"]
    return m.select(*by, *cols)


def tidy(wide: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metrics -> ``(by..., metric, value)`` (AN12 long form as well)."""
    return wide.select(*by, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        list(by), list(metrics), "metric", "value")


def threshold_table(df: DataFrame, label: str = "label", score: str = "score",
                    constraints: Sequence[float] = config.THRESHOLD_MIN_PRECISION_CONSTRAINTS,
                    by: Sequence[str] = ()) -> DataFrame:
    """EV5 per constraint: the lowest threshold whose precision meets it.

    Among points with ``precision >= c`` the highest recall is at the lowest
    threshold (recall never rises with the threshold).  When no point
    qualifies, the curve's end point applies: threshold 1.0, recall 0,
    precision 1.  Output ``by..., min_precision, threshold, recall, precision``.
    """
    by = list(by)
    pts = curve_points(df, label, score, by)
    aggs = []
    for i, c in enumerate(constraints):
        s = F.struct(F.col("threshold"), F.col("recall"), F.col("precision"))
        aggs.append(F.min(F.when(F.col("precision") >= F.lit(float(c)), s)).alias(f"c{i}"))
    best = pts.groupBy(*by).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(c)).alias("min_precision"), F.lit(i).alias("ordinal"),
                              F.col(f"c{i}").alias("pt")) for i, c in enumerate(constraints)])
    return best.select(*by, F.inline(rows)).select(
        *by, "min_precision", "ordinal",
        F.coalesce(F.col("pt.threshold"), F.lit(1.0)).alias("threshold"),
        F.coalesce(F.col("pt.recall"), F.lit(0.0)).alias("recall"),
        F.coalesce(F.col("pt.precision"), F.lit(1.0)).alias("precision"))


def find_optimal_threshold(df: DataFrame, label: str = "label", score: str = "score",
                           optimize_for: str = "recall",
                           constraints: Sequence[float] = config.THRESHOLD_MIN_PRECISION_CONSTRAINTS,
                           beta: float = config.F_BETA) -> tuple[float, dict]:
    """EV5: best threshold over the constraints; a strictly better recall wins.

    ``f_beta`` falls back to recall, as in the reference; other objectives
    raise.  Returns ``(threshold, metrics)`` with the metrics at that
    threshold plus ``optimal_threshold`` and ``min_precision_constraint``.
    """
    if optimize_for not in ("recall", "f_beta"):
        raise ValueError(f"Unsupported optimization metric: {optimize_for}")
    table = threshold_table(df, label, score, constraints).orderBy("ordinal").collect()
    best_score, best_t, best_c = -1.0, 0.5, None
    for r in table:  # at most len(constraints) rows
        if r["recall"] > best_score:
            best_score, best_t, best_c = r["recall"], r["threshold"], r["min_precision"]
    scored = df.withColumn("_pred", (F.col(score) >= F.lit(best_t)).cast("int"))
    metrics = evaluate(scored, label, "_pred", score, beta=beta).first().asDict()
    metrics["optimal_threshold"] = best_t
    metrics["min_precision_constraint"] = best_c
    return best_t, metrics


def apply_threshold(df: DataFrame, score: str, threshold: float, out: str = "prediction") -> DataFrame:
    """MD13: ``score >= threshold`` -> 1/0."""
    return df.withColumn(out, (F.col(score) >= F.lit(float(threshold))).cast("int"))


def compare_models(metrics: DataFrame, target_metric: str = "recall",
                   metric_names: Sequence[str] | None = None, model: str = "model") -> DataFrame:
    """EV6: tidy ``(model, metric, value)`` -> one row per model, best first.

    Sorted by ``target_metric`` descending with nulls last (by model name if
    that metric is absent); the target column comes right after the model.
    """
    names = list(metric_names) if metric_names else [
        r[0] for r in metrics.select("metric").distinct().orderBy("metric").collect()]
    wide = metrics.groupBy(model).pivot("metric", names).agg(F.first("value"))
    if target_metric in names:
        order = [target_metric] + [n for n in names if n != target_metric]
        return wide.select(model, *order).orderBy(F.desc_nulls_last(target_metric), model)
    return wide.select(model, *names).orderBy(model)


def compare_cv(cv: DataFrame, target_metric: str = "recall", model: str = "model") -> DataFrame:
    """EV6 for CV summaries ``(model, metric, mean, ci_lower, ci_upper)``.

    Produces ``<metric>_mean`` and ``<metric>_ci`` = ``"(lo, hi)"`` with three
    decimals (``"N/A"`` when undefined).
    """
    names = [r[0] for r in cv.select("metric").distinct().orderBy("metric").collect()]
    ci = F.when(F.col("ci_lower").isNotNull() & F.col("ci_upper").isNotNull()
                & ~F.isnan("ci_lower") & ~F.isnan("ci_upper"),
                F.format_string("(%.3f, %.3f)", "ci_lower", "ci_upper")).otherwise(F.lit("N/A"))
    base = cv.select(model, "metric", "mean", ci.alias("ci"))
    wide = base.groupBy(model).pivot("metric", names).agg(F.first("mean").alias("mean"),
                                                           F.first("ci").alias("ci"))
    cols = []
    for n in ([target_metric] if target_metric in names else []) + [n for n in names if n != target_metric]:
        cols += [F.col(f"{n}_mean"), F.col(f"{n}_ci")]
    out = wide.select(model, *cols)
    if target_metric in names:
        return out.orderBy(F.desc_nulls_last(f"{target_metric}_mean"), model)
    return out.orderBy(model)


def normalized_confusion(df: DataFrame, label: str = "label", pred: str = "prediction",
                         by: Sequence[str] = ()) -> DataFrame:
    """AN9: ``actual, predicted, count, share`` with share = count / row total."""
    by = list(by)
    conf = confusion(df, label, pred, by)
    cells = F.array(
        F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("true_negatives").alias("count")),
        F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("false_positives").alias("count")),
        F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("false_negatives").alias("count")),
        F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("true_positives").alias("count")))
    neg = F.col("true_negatives") + F.col("false_positives")
    pos = F.col("false_negatives") + F.col("true_positives")
    tall = conf.select(*by, neg.alias("_neg"), pos.alias("_pos"), F.inline(cells))
    total = F.when(F.col("actual") == 0, F.col("_neg")).otherwise(F.col("_pos"))
    return tall.select(*by, "actual", "predicted", "count",
                       F.when(total > 0, F.col("count") / total).alias("share"))


def positive_rate(df: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """AN10: the PR no-skill line (share of positives)."""
    return df.groupBy(*by).agg(F.avg(F.col(label).cast("double")).alias("positive_rate"))


def misclassification_summary(df: DataFrame, label: str = "label",
                              pred: str = "prediction") -> DataFrame:
    """EV7 counts: total, misclassified, rate, false positives, false negatives."""
    y, p = F.col(label), F.col(pred)
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.sum(F.when(y != p, 1).otherwise(0)).cast("long").alias("misclassified_count"),
        F.avg(F.when(y != p, 1.0).otherwise(0.0)).alias("misclassification_rate"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("long").alias("false_positive_count"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("long").alias("false_negative_count"))


def misclassification_stats(df: DataFrame, features: Sequence[str], label: str = "label",
                            pred: str = "prediction") -> DataFrame:
    """EV7 feature statistics (DQ4 columns) of false-negative and false-positive rows."""
    from riskloom.operators.quality import describe

    y, p = F.col(label), F.col(pred)
    err = F.when((y == 1) & (p == 0), "false_negative").when((y == 0) & (p == 1), "false_positive")
    tagged = df.withColumn("error_type", err).where(F.col("error_type").isNotNull())
    return describe(tagged, list(features), by=["error_type"])
