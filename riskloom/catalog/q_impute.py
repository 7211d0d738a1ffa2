"""Registered imputation queries (IM1, IM2, IM4, IM5; IM3 rows-only) on ``part_n``."""

from __future__ import annotations

from riskloom.catalog.registry import register, view, view_sql
from riskloom.operators import impute as IM

PN = view_sql("part_n")
NUM = ["p_size", "p_retailprice", "p_weight"]  # the key is no coordinate
STR = ["p_brand", "p_type"]


def _mode(c):
    return (f"(SELECT {c} FROM {PN} AS m WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} ASC LIMIT 1)")


def _median(c):
    return f"(SELECT quantile_cont({c}, 0.5) FROM {PN} AS m)"


def _fill(c, how):
    return f"coalesce({c}, {how(c)}) AS {c}"


@register("impute_simple",
          f"SELECT p_partkey, {_fill('p_brand', _mode)}, {_fill('p_type', _mode)}, "
          f"{_fill('p_size', _median)}, {_fill('p_retailprice', _median)}, {_fill('p_weight', _median)} "
          f"FROM {PN} AS p", operators="IM1")
def impute_simple(spark, sf):
    return IM.simple_imputation(view(spark, sf, "part_n"))


@register("impute_indicator",
          f"SELECT p_partkey, {_fill('p_brand', _mode)}, {_fill('p_type', _mode)}, "
          f"{_fill('p_size', _median)}, {_fill('p_retailprice', _median)}, {_fill('p_weight', _median)}, "
          + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing"
                      for c in ["p_size", "p_retailprice", "p_weight", "p_brand", "p_type"])
          + f" FROM {PN} AS p", operators="IM4")
def impute_indicator(spark, sf):
    return IM.indicator_imputation(view(spark, sf, "part_n"))


def _knn_sql(cols, coords, target, k=5):
    """Brute-force oracle: all receiver x donor pairs, exact distance, top k."""
    p = len(cols)
    present = " + ".join(f"CAST(r.{c} IS NOT NULL AND d.{c} IS NOT NULL AS INTEGER)" for c in coords)
    ssum = "CAST(0.0 AS DOUBLE)" + "".join(
        f" + coalesce((r.{c} - d.{c}) * (r.{c} - d.{c}), CAST(0.0 AS DOUBLE))" for c in coords)
    return (f"SELECT rk, avg(v) AS v FROM (SELECT r.p_partkey AS rk, d.{target} AS v, "
            f"row_number() OVER (PARTITION BY r.p_partkey ORDER BY "
            f"sqrt(CAST({p} AS DOUBLE) / ({present}) * ({ssum})), d.p_partkey) AS rn "
            f"FROM {PN} AS r JOIN {PN} AS d ON r.{target} IS NULL AND d.{target} IS NOT NULL "
            f"AND ({present}) > 0) AS t WHERE rn <= {k} GROUP BY rk")


def _knn_fill(c, cols, coords):
    return (f"coalesce({c}, (SELECT v FROM ({_knn_sql(cols, coords, c)}) AS kk WHERE kk.rk = p.p_partkey), "
            f"(SELECT avg({c}) FROM {PN} AS m)) AS {c}")


@register("impute_knn",
          f"SELECT {_fill('p_brand', _mode)}, {_fill('p_type', _mode)}, p_partkey, "
          + ", ".join(_knn_fill(c, NUM, NUM) for c in ["p_size", "p_retailprice", "p_weight"])
          + f" FROM {PN} AS p", operators="IM2")
def impute_knn(spark, sf):
    return IM.knn_imputation(view(spark, sf, "part_n"), key="p_partkey", exclude=["p_partkey"])


_LOW = ["p_size", "p_retailprice"]


@register("impute_advanced",
          f"SELECT p_partkey, {_fill('p_brand', _mode)}, {_fill('p_type', _mode)}, "
          + ", ".join(_knn_fill(c, _LOW, _LOW) for c in _LOW)
          + f", {_fill('p_weight', _median)}, "
          + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing"
                      for c in ["p_brand", "p_type", "p_size", "p_retailprice", "p_weight"])
          + f" FROM {PN} AS p", operators="IM5")
def impute_advanced(spark, sf):
    return IM.advanced_imputation(view(spark, sf, "part_n"), key="p_partkey")


@register("impute_mice", None, operators="IM3")
def impute_mice(spark, sf):
    return IM.mice_imputation(view(spark, sf, "part_n"))
