"""Registered profiling queries (DQ1-DQ8, PR5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import config
from riskloom.catalog.registry import register, table, view, view_sql
from riskloom.catalog.views import PATIENT_EXPRS
from riskloom.operators import impute as IM
from riskloom.operators import quality as Q

P = view_sql("patients")
PATIENT_COLS = [n for n, _ in PATIENT_EXPRS]
PATIENT_NUM = config.NUMERICAL_FEATURES


def _dtype(c):
    return "double" if c in PATIENT_NUM else "string"


_profile_sql = " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS column_name, '{_dtype(c)}' AS dtype, "
    f"count(*) - count({c}) AS n_missing, "
    f"CAST(count(*) - count({c}) AS DOUBLE) * 100 / count(*) AS pct_missing FROM {P} AS p"
    for i, c in enumerate(PATIENT_COLS))


@register("missing_profile", _profile_sql, ["pct_missing"], "DQ1, DQ8")
def missing_profile(spark, sf):
    return Q.missing_profile(view(spark, sf, "patients"))


@register("missing_only", f"SELECT * FROM ({_profile_sql}) AS t WHERE n_missing > 0",
          ["pct_missing"], "PR5")
def missing_only(spark, sf):
    return Q.missing_only(Q.missing_profile(view(spark, sf, "patients")))


@register("duplicate_count",
          "SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_unique, "
          "CAST(sum(n) AS BIGINT) - count(*) AS n_duplicates "
          "FROM (SELECT COLUMNS(*), count(*) AS n FROM events GROUP BY ALL) AS g",
          operators="DQ2")
def duplicate_count(spark, sf):
    return Q.duplicate_count(table(spark, sf, "events"))


@register("drop_duplicates", "SELECT DISTINCT * FROM events", operators="DQ3")
def drop_duplicates(spark, sf):
    return Q.drop_duplicates(table(spark, sf, "events"))


_describe_sql = " UNION ALL ".join(
    f"SELECT heart_disease_status, '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, "
    f"stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25, "
    f"quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max "
    f"FROM {P} AS p GROUP BY heart_disease_status"
    for c in PATIENT_NUM)


@register("describe_by_class", _describe_sql, ["mean", "std", "q25", "q50", "q75"], "DQ4")
def describe_by_class(spark, sf):
    return Q.describe(view(spark, sf, "patients"), PATIENT_NUM, by=["heart_disease_status"])


@register("describe_lineitem",
          " UNION ALL ".join(
              f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, "
              f"stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25, "
              f"quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max "
              f"FROM lineitem" for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
          ["mean", "std", "q25", "q50", "q75"], "DQ4")
def describe_lineitem(spark, sf):
    return Q.describe(table(spark, sf, "lineitem"),
                      ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@register("value_counts",
          f"SELECT exercise_habits, count(*) AS count, "
          f"CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM lineitem) AS pct "
          f"FROM {P} AS p GROUP BY exercise_habits", ["pct"], "DQ5")
def value_counts(spark, sf):
    return Q.value_counts(view(spark, sf, "patients"), "exercise_habits")


@register("value_counts_priority",
          "SELECT o_orderpriority, count(*) AS count, "
          "CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM orders) AS pct "
          "FROM orders GROUP BY o_orderpriority", ["pct"], "DQ5")
def value_counts_priority(spark, sf):
    return Q.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@register("target_distribution",
          f"SELECT heart_disease_status, count(*) AS count, "
          f"CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM lineitem) AS pct "
          f"FROM {P} AS p WHERE heart_disease_status IS NOT NULL GROUP BY heart_disease_status",
          ["pct"], "DQ6")
def target_distribution(spark, sf):
    return Q.target_distribution(view(spark, sf, "patients"), "heart_disease_status")


@register("imbalance_ratio",
          "SELECT CAST(sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_negative, "
          "CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive, "
          "CASE WHEN sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) > 0 THEN "
          "CAST(sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS DOUBLE) / "
          "sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) ELSE 'inf'::DOUBLE END AS ratio FROM labels",
          ["ratio"], "DQ7")
def imbalance_ratio(spark, sf):
    return Q.imbalance_ratio(table(spark, sf, "labels"), "quality")


@register("missing_after_cleaning",
          " UNION ALL ".join(
              f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS dtype, "
              f"count(*) - count({c}) AS n_missing, "
              f"CAST(count(*) - count({c}) AS DOUBLE) * 100 / count(*) AS pct_missing "
              f"FROM (SELECT DISTINCT * FROM {view_sql('events_n')} AS e) AS d"
              for i, (c, t) in enumerate([("event_id", "bigint"), ("user_id", "bigint"),
                                          ("event_type", "string"), ("value", "double"),
                                          ("props", "string"), ("label", "int")])),
          ["pct_missing"], "DQ8")
def missing_after_cleaning(spark, sf):
    ev = view(spark, sf, "events_n")
    return Q.missing_profile(Q.drop_duplicates(ev))


@register("missing_after_imputation",
          " UNION ALL ".join(
              f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS dtype, CAST(0 AS BIGINT) AS n_missing, "
              f"CAST(0 AS DOUBLE) AS pct_missing"
              for i, (c, t) in enumerate([("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string"),
                                          ("value", "double"), ("props", "string"), ("label", "int")])),
          ["pct_missing"], "DQ8, IM1")
def missing_after_imputation(spark, sf):
    ev = view(spark, sf, "events_n")
    types = dict(ev.dtypes)
    clean = IM.clean_data(ev, "simple", target=None)
    return Q.missing_profile(clean.select(*[F.col(c).cast(types[c]).alias(c) for c in ev.columns]))
