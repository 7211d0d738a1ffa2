"""Registered notebook queries (AN1-AN8) over the patients view."""

from __future__ import annotations


from riskloom import config
from riskloom.catalog.q_features import _cut_sql, _yn
from riskloom.catalog.registry import register, view, view_sql
from riskloom.operators import eda as E
from riskloom.operators import features as FE

P = view_sql("patients")
NUM = config.NUMERICAL_FEATURES
_Y = f"CAST({_yn('heart_disease_status')} AS DOUBLE)"


def patients_encoded(spark, sf):
    return FE.encode_target(view(spark, sf, "patients"), "heart_disease_status")


_levels = ", ".join(f"('{l}', {i})" for i, l in enumerate(config.NOTEBOOK_AGE_LABELS))


@register("rate_by_age_group",
          f"WITH lv AS (SELECT * FROM (VALUES {_levels}) AS t(age_group, o)), "
          f"a AS (SELECT age_group, count(y) AS total_count, avg(y) * 100 AS disease_rate, "
          f"coalesce(sum(y), 0.0::DOUBLE) AS disease_count FROM (SELECT "
          f"{_cut_sql('age', config.NOTEBOOK_AGE_BINS, config.NOTEBOOK_AGE_LABELS)} AS age_group, "
          f"{_Y} AS y FROM {P} AS p) AS q WHERE age_group IS NOT NULL GROUP BY age_group) "
          f"SELECT lv.age_group, coalesce(a.total_count, 0) AS total_count, a.disease_rate, "
          f"coalesce(a.disease_count, 0.0::DOUBLE) AS disease_count FROM lv LEFT JOIN a USING (age_group)",
          ["disease_rate", "disease_count"], "AN1")
def rate_by_age_group(spark, sf):
    df = FE.notebook_age_groups(patients_encoded(spark, sf))
    return E.rate_by_group(df, "age_group", "heart_disease_status", config.NOTEBOOK_AGE_LABELS)


@register("rate_by_risk_count",
          "SELECT risk_factor_count, count(y) AS total_count, avg(y) * 100 AS disease_rate, "
          "coalesce(sum(y), 0.0::DOUBLE) AS disease_count FROM (SELECT "
          + " + ".join(f"CAST(coalesce({_yn(c)}, 0) AS DOUBLE)" for c in config.RISK_FACTOR_FLAGS)
          + f" AS risk_factor_count, {_Y} AS y FROM {P} AS p) AS q GROUP BY risk_factor_count",
          ["disease_rate", "disease_count"], "AN2, FE13")
def rate_by_risk_count(spark, sf):
    df = FE.risk_factor_count(patients_encoded(spark, sf))
    return E.rate_by_group(df, "risk_factor_count", "heart_disease_status")


@register("crosstab",
          "SELECT exercise_habits, count_0, count_1, round(CAST(count_0 AS DOUBLE) / (count_0 + count_1), 4) * 100 AS pct_0, "
          "round(CAST(count_1 AS DOUBLE) / (count_0 + count_1), 4) * 100 AS pct_1 FROM ("
          "SELECT exercise_habits, CAST(sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS count_0, "
          "CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS count_1 FROM ("
          f"SELECT exercise_habits, {_yn('heart_disease_status')} AS y FROM {P} AS p) AS q "
          "WHERE exercise_habits IS NOT NULL AND y IS NOT NULL GROUP BY exercise_habits) AS c",
          ["pct_0", "pct_1"], "AN3")
def crosstab(spark, sf):
    return E.crosstab(patients_encoded(spark, sf), "exercise_habits", "heart_disease_status")


_pairs = [(NUM[j], NUM[i]) for i in range(len(NUM)) for j in range(i + 1, len(NUM))]


@register("correlation_matrix",
          " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM {P} AS p"
                             for a, b in _pairs), ["corr"], "AN4")
def correlation_matrix(spark, sf):
    return E.correlation_matrix(view(spark, sf, "patients"), NUM)


@register("target_correlations",
          " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, {_Y}) AS correlation FROM {P} AS p"
                             for c in NUM), ["correlation"], "AN5")
def target_correlations(spark, sf):
    return E.target_correlations(patients_encoded(spark, sf), "heart_disease_status", NUM)


_CORR = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, {_Y}) AS correlation FROM {P} AS p" for c in NUM)


@register("top_correlations",
          f"WITH t AS ({_CORR}) SELECT * FROM (SELECT *, 'positive' AS direction FROM t WHERE correlation > 0 "
          "ORDER BY correlation DESC LIMIT 5) AS a UNION ALL SELECT * FROM (SELECT *, 'negative' AS direction FROM t "
          "WHERE correlation < 0 ORDER BY correlation LIMIT 5) AS b", ["correlation"], "AN5")
def top_correlations(spark, sf):
    return E.top_correlated(patients_encoded(spark, sf), "heart_disease_status", NUM)


_HIST_SRC = f"(SELECT cholesterol_level AS x, heart_disease_status FROM {P} AS p WHERE cholesterol_level IS NOT NULL)"


@register("histogram_by_class",
          "WITH r AS (SELECT min(x) AS lo, max(x) AS hi FROM " + _HIST_SRC + " AS s), "
          "w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 20 ELSE 1.0 END AS width FROM r), "
          "b AS (SELECT heart_disease_status, CAST(least(floor((x - lo) / width), 19) AS INTEGER) AS bin, lo, width "
          "FROM " + _HIST_SRC + " AS s, w) "
          "SELECT heart_disease_status, bin, lo + bin * width AS bin_lo, lo + (bin + 1) * width AS bin_hi, "
          "count(*) AS count FROM b GROUP BY heart_disease_status, bin, lo, width",
          ["bin_lo", "bin_hi"], "AN6")
def histogram_by_class(spark, sf):
    return E.histogram(view(spark, sf, "patients"), "cholesterol_level", "heart_disease_status", 20)


@register("center_lines",
          "SELECT heart_disease_status, avg(cholesterol_level) AS mean, "
          f"quantile_cont(cholesterol_level, 0.5) AS median FROM {P} AS p GROUP BY heart_disease_status",
          ["mean", "median"], "AN6")
def center_lines(spark, sf):
    return E.center_lines(view(spark, sf, "patients"), "cholesterol_level", "heart_disease_status")


@register("kde_density",
          "WITH st AS (SELECT count(x) AS n, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi FROM "
          f"(SELECT bmi AS x FROM {P} AS p) AS s), "
          "h AS (SELECT n, sd * pow(n, -0.2) AS h, lo, hi FROM st), "
          "g AS (SELECT n, h, lo - 3 * h AS start, (hi + 3 * h - (lo - 3 * h)) / 199 AS step FROM h), "
          f"d AS (SELECT bmi AS v, count(*) AS w FROM {P} AS p WHERE bmi IS NOT NULL GROUP BY bmi) "
          "SELECT CAST(i AS INTEGER) AS grid_index, start + i * step AS x, "
          "sum(w * exp(-0.5 * pow((start + i * step - v) / h, 2))) / (n * h * sqrt(2 * pi())) AS density "
          "FROM g, range(200) AS r(i), d GROUP BY i, start, step, n, h",
          ["x", "density"], "AN7")
def kde_density(spark, sf):
    return E.kde(view(spark, sf, "patients"), "bmi")


@register("box_stats",
          "WITH q AS (SELECT heart_disease_status, quantile_cont(cholesterol_level, 0.25) AS q1, "
          "quantile_cont(cholesterol_level, 0.5) AS median, quantile_cont(cholesterol_level, 0.75) AS q3 "
          f"FROM {P} AS p GROUP BY heart_disease_status) "
          "SELECT q.heart_disease_status, q1, median, q3, q3 - q1 AS iqr, "
          "min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END) AS whisker_low, "
          "max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_high, "
          "CAST(sum(CASE WHEN x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers "
          f"FROM q JOIN (SELECT heart_disease_status, cholesterol_level AS x FROM {P} AS p "
          "WHERE cholesterol_level IS NOT NULL) AS d ON d.heart_disease_status = q.heart_disease_status "
          "GROUP BY q.heart_disease_status, q1, median, q3",
          ["q1", "median", "q3", "iqr"], "AN8")
def box_stats(spark, sf):
    return E.box_stats(view(spark, sf, "patients"), "cholesterol_level", "heart_disease_status")
