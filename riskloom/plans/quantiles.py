"""Exact quantiles without a whole group in one task or any row on the driver.

Spark's exact ``percentile`` keeps a value->count map of a whole group in one
task.  Here the rows are reduced to counts per (group, column, value), and
running counts over the ordered values tell which value holds each rank:

1. every column is cut into buckets at approximate percentiles (the cuts
   only balance the work; the result does not depend on them);
2. running counts are taken within (group, column, bucket) and shifted by the
   totals of the buckets before;
3. the values at the ranks ``floor`` and ``ceil`` of ``p * (n - 1)`` are
   interpolated.

Everything stays a DataFrame, for any number of groups.  Results equal linear
interpolation (pandas/numpy default, DuckDB ``quantile_cont``, Spark
``percentile``).

Medians of whole large tables (`exact_median`) stack only the values near the
median: a sample brackets it, and the values outside are counted where they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import config
from riskloom.plans.running import null_safe_join
from riskloom.session import ship_package

SAMPLE = 1 << 17  # rows that bracket a median, about
MARGIN = 0.01  # seven standard errors of a median's rank in such a sample
COUNT_DDL = "column int, bucket int, v double, c long"
COUNT = pa.schema([("column", pa.int32()), ("bucket", pa.int32()), ("v", pa.float64()), ("c", pa.int64())])


def _stacked(df: DataFrame, cols: Sequence[str], by: Sequence[str], rows_per_bucket: int) -> DataFrame:
    """(by..., column_name, v, bucket) for non-null, non-NaN values."""
    wide = df.select(*by, *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"_v{i}")
                            for i, c in enumerate(cols)])
    values = [f"_v{i}" for i in range(len(cols))]
    n_buckets = math.ceil(df.count() / rows_per_bucket)
    buckets = [F.lit(0)] * len(cols)
    if n_buckets > 1:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        cuts = wide.agg(*[F.percentile_approx(v, probs, max(10_000, 20 * n_buckets)).alias(v) for v in values]).first()
        splits = [[-math.inf, *sorted(set(cuts[v] or [])), math.inf] for v in values]
        wide = Bucketizer(splitsArray=splits, inputCols=values, outputCols=[f"{v}_b" for v in values],
                          handleInvalid="keep").transform(wide)
        buckets = [F.col(f"{v}_b").cast("int") for v in values]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(v).alias("v"), b.alias("bucket"))
                     for c, v, b in zip(cols, values, buckets)])
    return wide.select(*by, F.inline(rows)).where(F.col("v").isNotNull())


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                   rows_per_bucket: int = config.ROWS_PER_BUCKET) -> DataFrame:
    """``(by..., column_name, n, q0, q1, ...)``, a row per group and column with values."""
    keys = [*by, "column_name"]
    counts = _stacked(df, cols, by, rows_per_bucket).groupBy(*keys, "bucket", "v").agg(F.count("*").alias("c"))
    return _at_ranks(counts, keys, probs)


def _at_ranks(counts: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The quantiles of (keys..., bucket, v, c): ``c`` rows of value ``v``, in buckets that follow the order of ``v``."""
    local = Window.partitionBy(*keys, "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumn("upto", F.sum("c").over(local))
    totals = counts.groupBy(*keys, "bucket").agg(F.sum("c").alias("c"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(*keys, "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("shift"),
                           F.sum("c").over(group).alias("n"))
    placed = null_safe_join(running, shifts, [*keys, "bucket"]).withColumn("upto", F.col("upto") + F.col("shift"))

    def at(rank):
        return F.max(F.when((F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto")), F.col("v")))

    ranks = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    picked = placed.groupBy(*keys).agg(
        F.first("n").alias("n"),
        *[at(F.floor(r)).alias(f"lo{i}") for i, r in enumerate(ranks)],
        *[at(F.ceil(r)).alias(f"hi{i}") for i, r in enumerate(ranks)])
    return picked.select(*keys, "n", *[
        (F.col(f"lo{i}") + (r - F.floor(r)) * (F.col(f"hi{i}") - F.col(f"lo{i}"))).alias(f"q{i}")
        for i, r in enumerate(ranks)])


def _counted(cuts: list[np.ndarray]):
    """Counts by (column, bucket, value) from the first cut to the last; rows before and after are buckets without a value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, inside = np.zeros((len(cuts), 2), np.int64), [[] for _ in cuts]
        for batch in batches:
            for i, c in enumerate(cuts):
                v = batch.column(i).to_numpy(zero_copy_only=False)
                v = v[~np.isnan(v)]
                near = v[(v >= c[0]) & (v <= c[-1])] if len(c) else v[:0]
                above = np.count_nonzero(v > c[-1]) if len(c) else 0
                ends[i] += len(v) - len(near) - above, above
                inside[i].append(np.unique(near, return_counts=True))
        for i, c in enumerate(cuts):
            values, at = np.unique(np.concatenate([v for v, _ in inside[i]] or [np.empty(0)]), return_inverse=True)
            n = np.bincount(at, np.concatenate([k for _, k in inside[i]] or [np.empty(0)]), len(values)).astype(np.int64)
            bucket = np.searchsorted(c, values, "left")
            for b, v, k in ((bucket, pa.array(values), n), ([-1], pa.nulls(1, pa.float64()), ends[i, :1]),
                            ([len(c)], pa.nulls(1, pa.float64()), ends[i, 1:])):
                out = pa.RecordBatch.from_arrays([pa.array(np.full(len(k), i), pa.int32()), pa.array(b, pa.int32()), v,
                                                  pa.array(k, pa.int64())], schema=COUNT)
                yield out.filter(pa.array(np.asarray(k) > 0))

    return run


def _bracketed_medians(df: DataFrame, cols: Sequence[str], n: int, rows_per_bucket: int) -> dict[str, float | None]:
    """Medians between the cuts of a sample; None where the sample's bracket misses one."""
    ship_package(df.sparkSession)
    wide = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    parts = math.ceil(2 * MARGIN * n / rows_per_bucket)
    probs = [0.5 - MARGIN + 2 * MARGIN * i / parts for i in range(parts + 1)]
    some = wide.sample(min(1.0, SAMPLE / n), seed=config.RANDOM_STATE)  # decides the cuts, never the result
    found = some.agg(*[F.percentile_approx(F.when(~F.isnan(v), F.col(v)), probs, max(10_000, 20 * parts)).alias(v)
                       for v in wide.columns]).first()
    cuts = [np.unique(np.asarray(found[v] or [], dtype=float)) for v in wide.columns]
    counts = (wide.mapInArrow(_counted(cuts), COUNT_DDL).groupBy(F.col("column").alias("column_name"), "bucket", "v")
              .agg(F.sum("c").alias("c")))
    return {cols[r["column_name"]]: r["q0"] for r in _at_ranks(counts, ["column_name"], [0.5]).collect()}


def exact_median(df: DataFrame, cols: Sequence[str], rows_per_bucket: int = config.ROWS_PER_BUCKET) -> dict[str, float]:
    """Interpolated median per column (``{column: value}``; all-null -> absent).  A row per column is fetched."""
    if not cols:
        return {}
    n = df.count()
    found = _bracketed_medians(df, cols, n, rows_per_bucket) if n > min(rows_per_bucket, SAMPLE) else dict.fromkeys(cols)
    rest = [c for c in cols if c in found and found[c] is None]
    if rest:
        found |= {c: None for c in rest} | {r["column_name"]: r["q0"] for r in quantile_table(df, rest, [0.5], (), rows_per_bucket).collect()}
    return {c: v for c, v in found.items() if v is not None}
