"""Registered evaluation queries (EV1-EV8, AN9, AN10, AN12) over scored lineitem rows.

Three score columns of the ``scored`` view play three models; label is
``l_returnflag = 'R'`` and the prediction is ``score >= 0.5``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.registry import register, view, view_sql
from riskloom.operators import fairness as FA
from riskloom.operators import metrics as M

MODELS = ["score_discount", "score_tax", "score_mix"]
S = view_sql("scored")

LONG_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS model, l_linestatus, qty_band, label, {m} AS score, "
    f"CASE WHEN {m} >= 0.5 THEN 1 ELSE 0 END AS prediction FROM {S} AS s" for m in MODELS)


def scored_by(spark, sf, model):
    """The rows of one model."""
    return view(spark, sf, "scored").select("l_linestatus", "qty_band", "label", F.col(model).alias("score"),
                                            (F.col(model) >= 0.5).cast("int").alias("prediction"))


def long_scored(spark, sf):
    s = view(spark, sf, "scored")
    ids = ["l_linestatus", "qty_band", "label"]
    return (s.unpivot(ids, MODELS, "model", "score")
            .withColumn("prediction", (F.col("score") >= 0.5).cast("int")))


_CONF = ("CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS true_negatives, "
         "CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS false_positives, "
         "CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS false_negatives, "
         "CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS true_positives")


@register("confusion_matrix", f"SELECT model, {_CONF} FROM ({LONG_SQL}) AS l GROUP BY model",
          operators="EV1")
def confusion_matrix(spark, sf):
    return M.confusion(long_scored(spark, sf), by=["model"])


@register("apply_threshold",
          f"SELECT label, score_mix, CASE WHEN score_mix >= 0.37 THEN 1 ELSE 0 END AS prediction FROM {S} AS s",
          ["score_mix"], operators="MD13")
def apply_threshold(spark, sf):
    return M.apply_threshold(view(spark, sf, "scored").select("label", "score_mix"), "score_mix", 0.37)


def _points_sql(src, by):
    k = ", ".join(by)
    return (f"WITH pts AS (SELECT {k}, score AS threshold, CAST(sum(label) AS BIGINT) AS tp_at, "
            f"CAST(sum(1 - label) AS BIGINT) AS fp_at FROM ({src}) AS l GROUP BY {k}, score), "
            f"cum AS (SELECT *, CAST(sum(tp_at) OVER w AS BIGINT) AS cum_tp, "
            f"CAST(sum(fp_at) OVER w AS BIGINT) AS cum_fp, "
            f"CAST(sum(tp_at) OVER (PARTITION BY {k}) AS BIGINT) AS n_pos, "
            f"CAST(sum(fp_at) OVER (PARTITION BY {k}) AS BIGINT) AS n_neg FROM pts "
            f"WINDOW w AS (PARTITION BY {k} ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)) ")


_AUC_SEL = ("CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN "
            "sum(CAST(fp_at AS DOUBLE) * (2 * cum_tp - tp_at)) / (2.0 * max(n_pos) * max(n_neg)) END AS roc_auc, "
            "CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN "
            "sum(CAST(tp_at AS DOUBLE) * (CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp) + "
            "CASE WHEN cum_tp - tp_at + cum_fp - fp_at > 0 THEN "
            "CAST(cum_tp - tp_at AS DOUBLE) / (cum_tp - tp_at + cum_fp - fp_at) ELSE 1.0 END) / 2) "
            "/ max(n_pos) END AS pr_auc")

_RATES = ("CASE WHEN tp + tn + fp + fn > 0 THEN CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) ELSE 0.0 END AS accuracy, "
          "CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall, "
          "CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision, "
          "CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0 END AS f1, "
          "CASE WHEN 5 * tp + 4 * fn + fp > 0 THEN CAST(5 * tp AS DOUBLE) / (5 * tp + 4 * fn + fp) ELSE 0.0 END AS f_beta, "
          "tp AS true_positives, tn AS true_negatives, fp AS false_positives, fn AS false_negatives")


def _evaluate_sql(src, by):
    k = ", ".join(by)
    conf = (f"SELECT {k}, CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
            f"CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn, "
            f"CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
            f"CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn "
            f"FROM ({src}) AS l GROUP BY {k}")
    aucs = _points_sql(src, by) + f"SELECT {k}, {_AUC_SEL} FROM cum GROUP BY {k}"
    on = " AND ".join(f"c.{b} IS NOT DISTINCT FROM a.{b}" for b in by)
    sel = ", ".join(f"c.{b}" for b in by)
    return (f"SELECT {sel}, {_RATES}, a.roc_auc, a.pr_auc FROM ({conf}) AS c "
            f"LEFT JOIN ({aucs}) AS a ON {on}")


_METRIC_DOUBLES = ["accuracy", "recall", "precision", "f1", "f_beta", "roc_auc", "pr_auc"]


@register("evaluate_models", _evaluate_sql(LONG_SQL, ["model"]), _METRIC_DOUBLES, "EV2, EV3, EV4")
def evaluate_models(spark, sf):
    return M.evaluate(long_scored(spark, sf), by=["model"])


@register("roc_pr_curves",
          _points_sql(LONG_SQL, ["model"])
          + "SELECT model, threshold, tp_at, fp_at, cum_tp, cum_fp, n_pos, n_neg, "
            "CAST(cum_tp AS DOUBLE) / n_pos AS tpr, CAST(cum_fp AS DOUBLE) / n_neg AS fpr, "
            "CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp) AS precision, "
            "CAST(cum_tp AS DOUBLE) / n_pos AS recall FROM cum",
          ["tpr", "fpr", "precision", "recall"], "EV3, EV4")
def roc_pr_curves(spark, sf):
    return M.curve_points(long_scored(spark, sf), by=["model"])


_CONSTRAINTS = [0.21, 0.25, 0.3, 0.35, 0.4, 0.45, 0.6]


@register("threshold_search",
          _points_sql(LONG_SQL, ["model"])
          + ", pr AS (SELECT model, threshold, CAST(cum_tp AS DOUBLE) / n_pos AS recall, "
            "CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp) AS precision FROM cum), "
            "c AS (SELECT * FROM (VALUES " + ", ".join(f"({v}::DOUBLE, {i})" for i, v in enumerate(_CONSTRAINTS))
          + ") AS t(min_precision, ordinal)), "
            "m AS (SELECT DISTINCT model FROM pr), "
            "best AS (SELECT m.model, c.min_precision, c.ordinal, "
            "(SELECT min(threshold) FROM pr WHERE pr.model = m.model AND pr.precision >= c.min_precision) AS t "
            "FROM m, c) "
            "SELECT best.model, best.min_precision, best.ordinal, coalesce(best.t, 1.0::DOUBLE) AS threshold, "
            "coalesce(pr.recall, 0.0::DOUBLE) AS recall, coalesce(pr.precision, 1.0::DOUBLE) AS precision "
            "FROM best LEFT JOIN pr ON pr.model = best.model AND pr.threshold = best.t",
          ["recall", "precision"], "EV5")
def threshold_search(spark, sf):
    return M.threshold_table(long_scored(spark, sf), constraints=_CONSTRAINTS, by=["model"])


_CMP = ["recall", "accuracy", "precision", "f1", "f_beta", "roc_auc", "pr_auc"]


@register("compare_models",
          "SELECT model, " + ", ".join(_CMP) + f" FROM ({_evaluate_sql(LONG_SQL, ['model'])}) AS e",
          _CMP, "EV6, EV9")
def compare_models(spark, sf):
    ev = M.evaluate(long_scored(spark, sf), by=["model"])
    return M.compare_models(M.tidy(ev, ["model"], _CMP), "recall", _CMP)


@register("comparison_long",
          "SELECT model, metric, value FROM (SELECT model, accuracy, recall, precision, f1 FROM ("
          + _evaluate_sql(LONG_SQL, ["model"]) + ") AS e) UNPIVOT (value FOR metric IN "
          "(accuracy, recall, precision, f1))", ["value"], "AN12")
def comparison_long(spark, sf):
    from riskloom.operators.eda import comparison_long as cl
    return cl(M.evaluate(long_scored(spark, sf), by=["model"]))


@register("normalized_confusion",
          "WITH c AS (SELECT model, " + _CONF + f" FROM ({LONG_SQL}) AS l GROUP BY model), "
          "t AS (SELECT model, 0 AS actual, 0 AS predicted, true_negatives AS count, true_negatives + false_positives AS tot FROM c "
          "UNION ALL SELECT model, 0, 1, false_positives, true_negatives + false_positives FROM c "
          "UNION ALL SELECT model, 1, 0, false_negatives, false_negatives + true_positives FROM c "
          "UNION ALL SELECT model, 1, 1, true_positives, false_negatives + true_positives FROM c) "
          "SELECT model, actual, predicted, count, CASE WHEN tot > 0 THEN CAST(count AS DOUBLE) / tot END AS share FROM t",
          ["share"], "AN9")
def normalized_confusion(spark, sf):
    return M.normalized_confusion(long_scored(spark, sf), by=["model"])


@register("positive_rate", f"SELECT avg(CAST(label AS DOUBLE)) AS positive_rate FROM {S} AS s",
          ["positive_rate"], "AN10")
def positive_rate(spark, sf):
    return M.positive_rate(view(spark, sf, "scored"))


@register("misclassifications",
          "SELECT count(*) AS total_samples, "
          "CAST(sum(CASE WHEN label <> prediction THEN 1 ELSE 0 END) AS BIGINT) AS misclassified_count, "
          "avg(CASE WHEN label <> prediction THEN 1.0 ELSE 0.0 END)::DOUBLE AS misclassification_rate, "
          "CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS false_positive_count, "
          "CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS false_negative_count "
          f"FROM ({LONG_SQL}) AS l WHERE model = 'score_mix'", ["misclassification_rate"], "EV7")
def misclassifications(spark, sf):
    return M.misclassification_summary(scored_by(spark, sf, "score_mix"))


@register("misclassification_stats",
          "SELECT error_type, 'score' AS column_name, count(score) AS count, avg(score) AS mean, "
          "stddev_samp(score) AS std, min(score) AS min, quantile_cont(score, 0.25) AS q25, "
          "quantile_cont(score, 0.5) AS q50, quantile_cont(score, 0.75) AS q75, max(score) AS max FROM ("
          "SELECT *, CASE WHEN label = 1 AND prediction = 0 THEN 'false_negative' "
          "WHEN label = 0 AND prediction = 1 THEN 'false_positive' END AS error_type FROM ("
          + LONG_SQL + ") AS l WHERE model = 'score_mix') AS t WHERE error_type IS NOT NULL GROUP BY error_type",
          ["mean", "std", "q25", "q50", "q75"], "EV7")
def misclassification_stats(spark, sf):
    return M.misclassification_stats(scored_by(spark, sf, "score_mix"), ["score"])


def _slice_src(columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS slice_feature, CAST({expr} AS VARCHAR) AS slice_value, label, prediction, score "
        f"FROM ({LONG_SQL}) AS l WHERE model = 'score_mix'" for f, expr in columns.items())


def _slice_sql(src: str) -> str:
    return ("SELECT e.slice_feature, e.slice_value, e.slice_feature || '_' || coalesce(e.slice_value, 'NaN') AS slice_name, "
            "z.slice_size, e.recall, e.precision, e.f1, e.accuracy, e.f_beta, e.roc_auc, e.pr_auc, "
            "e.false_negatives, e.false_positives FROM (" + _evaluate_sql(src, ["slice_feature", "slice_value"])
            + ") AS e JOIN (SELECT slice_feature, slice_value, count(*) AS slice_size FROM (" + src
            + ") AS s GROUP BY ALL) AS z ON e.slice_feature = z.slice_feature AND e.slice_value IS NOT DISTINCT FROM z.slice_value")


_SLICE_SRC = _slice_src({"l_linestatus": "l_linestatus", "qty_band": "qty_band"})
_NULL_BAND = "CASE WHEN qty_band <> 'q10-30' THEN qty_band END"


@register("slice_metrics_null", _slice_sql(_slice_src({"band": _NULL_BAND})), _METRIC_DOUBLES, "EV8, PR6")
def slice_metrics_null(spark, sf):
    df = scored_by(spark, sf, "score_mix").withColumn("band", F.expr(_NULL_BAND))
    return FA.compute_slice_metrics(df, slice_features=["band"])


@register("slice_metrics", _slice_sql(_SLICE_SRC), _METRIC_DOUBLES, "EV8")
def slice_metrics(spark, sf):
    df = scored_by(spark, sf, "score_mix")
    return FA.compute_slice_metrics(df, slice_features=["l_linestatus", "qty_band"])
