"""Exact stratified splits and folds (SP1, SP2).

Rows are ordered inside each class by a deterministic key (default: a
64-bit hash of the row key and the seed), ranked exactly with
``plans.exact_rank`` (bucketed, so the 80% class never lands in one task),
and assigned by rank: the first ``ceil(test_size * n_class)`` go to test;
fold = ``(rank - 1) % k``.  The same seed gives the same rows under any
partitioning, and shares are exact rather than ``sampleBy``'s approximation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.plans.running import exact_rank


def hash_order(key_cols: Sequence[str], seed: int = config.RANDOM_STATE) -> Column:
    """Default ordering key: xxhash64 of the key columns and the seed."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols])


def _ranked(df: DataFrame, label: str, order: Column | None, key_cols: Sequence[str],
            seed: int, **kw) -> DataFrame:
    o = order if order is not None else hash_order(key_cols, seed)
    keyed = df.withColumn("_ord", o)
    # (order, key...) is unique per row, which makes the rank deterministic
    spec = [("_ord", True)] + [(c, True) for c in key_cols]
    return exact_rank(keyed, [label], spec, "_rank", **kw)


def stratified_split(df: DataFrame, label: str, key_cols: Sequence[str],
                     test_size: float = config.TEST_SIZE, seed: int = config.RANDOM_STATE,
                     order: Column | None = None, out: str = "split", **kw) -> DataFrame:
    """SP1: add ``split`` = ``"test"`` / ``"train"`` with exact per-class shares."""
    counts = _class_sizes(df, label)
    ranked = _ranked(df, label, order, key_cols, seed, **kw)
    return ranked.withColumn(out, _split_of(counts, label, test_size)).drop("_rank", "_ord")


def _class_sizes(df: DataFrame, label: str) -> dict:
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}  # #classes rows


def _split_of(counts: dict, label: str, test_size: float) -> Column:
    limit = None
    for cls, n in counts.items():
        m = F.lit(math.ceil(test_size * n))
        cond = F.col(label).isNull() if cls is None else F.col(label) == F.lit(cls)
        limit = F.when(cond, m) if limit is None else limit.when(cond, m)
    return F.when(F.col("_rank") <= limit, "test").otherwise("train")


def stratified_folds(df: DataFrame, label: str, key_cols: Sequence[str], k: int = config.CV_FOLDS,
                     seed: int = config.RANDOM_STATE, order: Column | None = None,
                     out: str = "fold", **kw) -> DataFrame:
    """SP2: add ``fold`` in ``0..k-1``; every fold's class counts differ by at most one."""
    ranked = _ranked(df, label, order, key_cols, seed, **kw)
    return ranked.withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_ord")


def stratified_split_folds(df: DataFrame, label: str, key_cols: Sequence[str], test_size: float = config.TEST_SIZE,
                           k: int = config.CV_FOLDS, seed: int = config.RANDOM_STATE, **kw) -> DataFrame:
    """SP1 and SP2 by the same order: both follow from one rank of the rows."""
    counts = _class_sizes(df, label)
    ranked = _ranked(df, label, None, key_cols, seed, n_rows=sum(counts.values()), **kw)
    return ranked.withColumns({"split": _split_of(counts, label, test_size),
                               "fold": ((F.col("_rank") - 1) % k).cast("int")}).drop("_rank", "_ord")


def train_test(df: DataFrame, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    return (df.where(F.col(split_col) == "train").drop(split_col),
            df.where(F.col(split_col) == "test").drop(split_col))
