"""Missing-value handling (IM1-IM5) and the ``clean_data`` dispatcher.

Fill values are computed by distributed aggregations and applied as one
projection of ``coalesce`` expressions:

* median: exact interpolated median (``plans.quantiles``);
* mode: value counts per column (a partial-aggregated group-by) reduced by
  ``min_by(value, (-count, value))``: most frequent, smallest on ties;
* KNN: the banded exact join in ``plans.knn``;
* MICE: chained Bayesian ridge regressions from one aggregation of moments by
  pattern of nulls (``plans.chained``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expr import numeric_columns, string_columns
from riskloom.operators.features import encode_target
from riskloom.operators.quality import drop_duplicates
from riskloom.plans.chained import chained_ridge, pattern_moments, regression
from riskloom.plans.knn import knn_impute
from riskloom.plans.quantiles import exact_median
from riskloom.session import cut_lineage, written


def _nan_to_null(df: DataFrame) -> DataFrame:
    """One rule for missing: NaN counts as NULL in every imputer, as in the profile."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def null_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    if not cols:
        return {}
    r = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols]).first()
    return {c: r[c] for c in cols}


def mode_values(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent non-null value per column, smallest on ties."""
    if not cols:
        return {}
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"))
                    for c in cols])
    counts = (df.select(F.inline(arr)).where(F.col("v").isNotNull())
              .groupBy("column_name", "v").count())
    best = counts.groupBy("column_name").agg(
        F.min_by("v", F.struct(-F.col("count"), F.col("v"))).alias("mode"))
    return {r["column_name"]: r["mode"] for r in best.collect()}


def fill(df: DataFrame, values: dict) -> DataFrame:
    """Fill nulls per column with literals, in one projection."""
    if not values:
        return df
    def one(c):
        v = values[c]
        if isinstance(v, float):  # a median: the column becomes double, like pandas
            return F.coalesce(F.col(c).cast("double"), F.lit(v)).alias(c)
        return F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)).alias(c)

    return df.select(*[one(c) if c in values and values[c] is not None else F.col(c)
                       for c in df.columns])


def _missing_cols(df, cols):
    nc = null_counts(df, cols)
    return [c for c in cols if nc[c] > 0], nc


def simple_imputation(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """IM1: numeric -> median, string -> mode."""
    df = _nan_to_null(df)
    num, _ = _missing_cols(df, numeric_columns(df, exclude))
    cat, _ = _missing_cols(df, string_columns(df, exclude))
    values = dict(exact_median(df, num)) if num else {}
    values.update(mode_values(df, cat))
    return fill(df, values)


def _with_key(df: DataFrame, key: str | None):
    if key is not None:
        return df, key, False
    cols = [F.col(c) for c in df.columns]
    keyed = df.withColumn("_row_key", F.struct(F.xxhash64(*cols).alias("h1"),
                                               F.xxhash64(F.lit("riskloom"), *cols).alias("h2")))
    return keyed, "_row_key", True


def knn_imputation(df: DataFrame, n_neighbors: int = 5, key: str | None = None,
                   exclude: Sequence[str] = ()) -> DataFrame:
    """IM2: strings -> mode; all numeric columns together by k-NN.

    ``key`` must identify rows (after de-duplication a hash of all columns
    does, which is the default).
    """
    df = _nan_to_null(df)
    cat, _ = _missing_cols(df, string_columns(df, exclude))
    out = fill(df, mode_values(df, cat))
    num = numeric_columns(out, exclude)
    if not _missing_cols(out, num)[0]:
        return out
    keyed, k, added = _with_key(out, key)
    res = knn_impute(keyed, k, num, n_neighbors)
    return res.drop(k) if added else res


def mice_imputation(df: DataFrame, max_iter: int = 10, tol: float = 1e-3, exclude: Sequence[str] = (),
                    max_patterns: int = 4096) -> DataFrame:
    """IM3: chained equations for the numeric columns, strings -> mode.

    Bayesian ridge regressions (`plans.chained`): all rounds follow from one
    aggregation of moments by pattern of nulls.  With more than
    ``max_patterns`` patterns the moments of each regression are aggregated
    anew, a column at a time, with a reliable checkpoint per round.
    """
    df = _nan_to_null(df)
    cat, _ = _missing_cols(df, string_columns(df, exclude))
    out = fill(df, mode_values(df, cat))
    num = numeric_columns(out, exclude)
    miss, nc = _missing_cols(out, num)
    if not miss:
        return out
    done = chained_ridge(out, num, max_iter, tol, max_patterns)
    return done if done is not None else _by_column(out, num, sorted(miss, key=lambda c: (nc[c], num.index(c))), max_iter, tol)


def _by_column(out: DataFrame, num: list[str], order: list[str], max_iter: int, tol: float) -> DataFrame:
    """The same regressions, with a pass over the rows for each."""
    stats = out.agg(*[F.avg(c).alias(f"m_{c}") for c in num],
                    F.max(F.greatest(*[F.coalesce(F.abs(F.col(c)), F.lit(0.0)) for c in num], F.lit(0.0))).alias("_absmax")).first()
    cur = out.withColumns({f"_miss_{c}": F.col(c).isNull() for c in order})
    cur = cur.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(stats[f"m_{c}"] or 0.0)) for c in order})
    cur = cut_lineage(cur)
    threshold = tol * (stats["_absmax"] or 0.0)
    for _ in range(max_iter):
        prev = {c: f"_prev_{c}" for c in order}
        cur = cur.withColumns({prev[c]: F.col(c) for c in order})
        for c in order:
            centred = [F.col(o).cast("double") - float(stats[f"m_{o}"] or 0.0) for o in num]
            rows = cur.select(F.col(f"_miss_{c}").cast("int").cast("string").alias("pattern"),
                              *(v.alias(f"c{i}") for i, v in enumerate(centred)))
            moments = pattern_moments(rows.where("pattern = '0'"), len(num)).get("0")
            if moments is None:
                continue
            beta = regression(moments, num.index(c) + 1)
            pred = sum((float(b) * v for b, v in zip(beta[1:], centred, strict=True)), F.lit(float(beta[0] + (stats[f"m_{c}"] or 0.0))))
            cur = cur.withColumn(c, F.when(F.col(f"_miss_{c}"), pred).otherwise(F.col(c)))
        delta = cur.agg(F.max(F.greatest(*[F.abs(F.col(c) - F.col(prev[c])) for c in order], F.lit(0.0))).alias("d")).first()["d"] or 0.0
        cur = cut_lineage(cur.drop(*prev.values()))
        if delta < threshold:
            break
    return cur.select(*out.columns)


def indicator_imputation(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """IM4: ``<col>_missing`` 0/1 for each column with nulls, then median/mode."""
    df = _nan_to_null(df)
    num, _ = _missing_cols(df, numeric_columns(df, exclude))
    cat, _ = _missing_cols(df, string_columns(df, exclude))
    flagged = df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in num + cat})
    values = dict(exact_median(df, num)) if num else {}
    values.update(mode_values(df, cat))
    return fill(flagged, values)


def advanced_imputation(df: DataFrame, missingness_threshold: float = 0.2, key: str | None = None,
                        n_neighbors: int = 5, exclude: Sequence[str] = ()) -> DataFrame:
    """IM5 (the reference default).

    Indicators for every column with nulls; strings -> mode; numerics with
    ``0 < share < threshold`` -> k-NN over just those columns; numerics with
    ``share >= threshold`` -> median.
    """
    df = _nan_to_null(df)
    cols = [c for c in df.columns if c not in set(exclude)]
    n = df.count()
    nc = null_counts(df, cols)
    with_null = [c for c in cols if nc[c] > 0]
    num = numeric_columns(df, exclude)
    cat = string_columns(df, exclude)
    flagged = df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in with_null})
    values = mode_values(df, [c for c in cat if nc[c] > 0])
    low = [c for c in num if 0 < nc[c] / max(n, 1) < missingness_threshold]
    high = [c for c in num if nc[c] / max(n, 1) >= missingness_threshold]
    values.update(exact_median(df, high) if high else {})
    out = fill(flagged, values)
    if low:
        keyed, k, added = _with_key(out, key)
        out = knn_impute(keyed, k, low, n_neighbors)
        out = out.drop(k) if added else out
    return out


METHODS = {
    "simple": simple_imputation,
    "knn": knn_imputation,
    "mice": mice_imputation,
    "indicator": indicator_imputation,
    "advanced": advanced_imputation,
}


def clean_data(df: DataFrame, method: str = "advanced", target: str | None = "heart_disease_status",
               drop_null_target: bool = False, exclude_target: bool = False, add_key: Callable[[DataFrame], DataFrame] | None = None,
               **kw) -> DataFrame:
    """De-duplicate, encode the Yes/No target, then impute with ``method``.

    ``drop_null_target`` removes rows whose label is unknown and
    ``exclude_target`` keeps the label out of the imputation (both off by
    default, which is the reference behaviour).  ``add_key`` adds a key to the
    distinct rows, so that the shuffle which finds them doesn't carry it.
    """
    if method not in METHODS:
        raise ValueError(f"Unknown imputation method: {method}")
    out = drop_duplicates(df)
    if add_key:
        out = add_key(out)
    if target and target in out.columns:
        out = encode_target(out, target)
        if drop_null_target:
            out = out.where(F.col(target).isNotNull())
    out = written(out)  # the imputers read it several times: de-duplicate once
    exclude = [target] if (exclude_target and target) else []
    return METHODS[method](out, exclude=exclude, **kw)
