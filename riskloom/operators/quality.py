"""Profiling and de-duplication (DQ1-DQ8, PR5).

Every profile is one pass: a single wide aggregation over all columns, then
an ``unpivot`` of the one-row result into a tall table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.plans.quantiles import quantile_table
from riskloom.plans.running import null_safe_join


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_profile(df: DataFrame, n_rows: int | None = None) -> DataFrame:
    """DQ1/DQ8: one row per column: ``ordinal, column_name, dtype, n_missing, pct_missing``."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(F.when(_missing(df, c), 1)).alias(f"m{i}") for i, c in enumerate(cols)])
    tall = row.select(
        "_n",
        F.inline(F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                                    F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                                    F.col(f"m{i}").alias("n_missing"))
                           for i, c in enumerate(cols)])))
    return tall.select(
        "ordinal", "column_name", "dtype", "n_missing",
        F.when(F.col("_n") > 0, F.col("n_missing") * 100.0 / F.col("_n")).alias("pct_missing"))


def missing_only(profile: DataFrame) -> DataFrame:
    """PR5: columns with at least one missing value, highest share first."""
    return profile.where(F.col("n_missing") > 0).orderBy(F.desc("pct_missing"), "ordinal")


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """DQ2: ``n_rows, n_unique, n_duplicates`` (rows beyond the first copy).

    A group-by over all columns; the map-side partial aggregation collapses
    repeated rows before the shuffle, so a hot row does not skew a task.
    """
    cols = list(subset or df.columns)
    counts = df.groupBy(*[F.col(f"`{c}`") for c in cols]).count()
    return counts.agg(F.sum("count").cast("long").alias("n_rows"),
                      F.count(F.lit(1)).alias("n_unique")).select(
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "n_unique",
        (F.coalesce("n_rows", F.lit(0)) - F.col("n_unique")).alias("n_duplicates"))


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """DQ3: full-row de-duplication (NULL equals NULL)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def quality_summary(df: DataFrame) -> dict:
    """DQ1 as a small dict: shape, missing counts and shares, duplicates, dtypes."""
    prof = missing_profile(df).collect()
    n = df.count()
    dup = duplicate_count(df).first()["n_duplicates"]
    return {
        "shape": (n, len(df.columns)),
        "missing_values": {r["column_name"]: r["n_missing"] for r in prof},
        "missing_percentage": {r["column_name"]: r["pct_missing"] for r in prof},
        "duplicates": dup,
        "data_types": {f.name: f.dataType.simpleString() for f in df.schema.fields},
    }


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """DQ4: count, mean, std (n-1), min, 25/50/75% (interpolated), max.

    Tall output ``(by..., column_name, count, mean, std, min, q25, q50, q75, max)``.
    Moments come from one grouped aggregation, the quartiles from
    ``quantile_table``; a null group is a group.
    """
    by = list(by)
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                    for c in cols])
    tall = df.select(*by, F.inline(arr)).where(F.col("v").isNotNull() & ~F.isnan("v"))
    moments = tall.groupBy(*by, "column_name").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    quartiles = quantile_table(df, cols, [0.25, 0.5, 0.75], by).drop("n").withColumnsRenamed(
        {"q0": "q25", "q1": "q50", "q2": "q75"})
    return null_safe_join(moments, quartiles, [*by, "column_name"], "left").select(
        *by, "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def value_counts(df: DataFrame, col: str, dropna: bool = False,
                 n_rows: int | None = None) -> DataFrame:
    """DQ5/DQ6: ``col, count, pct`` (pct of all rows), most frequent first.

    ``dropna=False`` keeps NULL as a level.  The total is a scalar (a count),
    not a global window, so a high-cardinality column stays distributed.
    """
    base = df if not dropna else df.where(F.col(col).isNotNull())
    total = n_rows if n_rows is not None else df.count()
    counts = base.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(col, "count",
                         (F.col("count") * 100.0 / F.lit(max(total, 1))).alias("pct")
                         ).orderBy(F.desc("count"), F.asc_nulls_last(col))


def target_distribution(df: DataFrame, label: str) -> DataFrame:
    """DQ6: class counts and shares, null labels excluded from the counts."""
    return value_counts(df, label, dropna=True)


def imbalance_ratio(df: DataFrame, label: str, positive=1, negative=0) -> DataFrame:
    """DQ7: ``n_negative, n_positive, ratio``; ratio is +inf with no positives."""
    pos = F.sum(F.when(F.col(label) == positive, 1).otherwise(0)).cast("long")
    neg = F.sum(F.when(F.col(label) == negative, 1).otherwise(0)).cast("long")
    agg = df.agg(F.coalesce(neg, F.lit(0)).alias("n_negative"), F.coalesce(pos, F.lit(0)).alias("n_positive"))
    return agg.select("n_negative", "n_positive",
                      F.when(F.col("n_positive") > 0, F.col("n_negative") / F.col("n_positive"))
                      .otherwise(F.lit(float("inf"))).alias("ratio"))
