"""Class balance: weights, under-sampling, SMOTE (BA1-BA5).

Class counts are a group-by with one row per class, so they are collected
and turned into literal ``F.when`` chains; the data never leave the
executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.plans.running import exact_rank
from riskloom.operators.split import hash_order


def class_counts(df: DataFrame, label: str) -> dict:
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect() if r[label] is not None}


def _by_class(label: str, values: dict) -> Column:
    out = None
    for cls, v in values.items():
        cond = F.col(label) == F.lit(cls)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """BA3: ``label, count, weight`` with weight = n / (n_classes * n_class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).count()
    n_classes = counts.count()
    total = df.where(F.col(label).isNotNull()).count()
    return counts.withColumn("weight", F.lit(float(total)) / (F.lit(n_classes) * F.col("count")))


def get_class_weights(df: DataFrame, label: str) -> dict:
    return {r[label]: r["weight"] for r in class_weight_table(df, label).collect()}


def with_class_weights(df: DataFrame, label: str, out: str = "weight",
                       weights: dict | None = None) -> DataFrame:
    """BA3 as a ``weightCol``: balanced weights (or the given class -> weight map)."""
    w = weights if weights is not None else get_class_weights(df, label)
    return df.withColumn(out, _by_class(label, {k: float(v) for k, v in w.items()}).cast("double"))


def cost_sensitive_weights(df: DataFrame, label: str, false_negative_cost: float = 10.0,
                           false_positive_cost: float = 1.0, out: str = "weight") -> DataFrame:
    """BA4: positives get the FN cost, negatives the FP cost, rescaled to mean 1."""
    counts = class_counts(df, label)
    n = sum(counts.values())
    raw = counts.get(1, 0) * false_negative_cost + counts.get(0, 0) * false_positive_cost
    scale = n / raw if raw else 1.0
    w = F.when(F.col(label) == 1, false_negative_cost).when(F.col(label) == 0, false_positive_cost)
    return df.withColumn(out, (w * F.lit(scale)).cast("double"))


def scale_pos_weight(df: DataFrame, label: str) -> float:
    """BA5: negatives / positives, 1.0 without positives."""
    c = class_counts(df, label)
    return c.get(0, 0) / c[1] if c.get(1) else 1.0


def with_scale_pos_weight(df: DataFrame, label: str, out: str = "weight",
                          value: float | None = None) -> DataFrame:
    s = scale_pos_weight(df, label) if value is None else value
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(s))).otherwise(F.lit(1.0)))


def undersample(df: DataFrame, label: str, key_cols: Sequence[str],
                sampling_strategy: float | dict = 0.5, seed: int = config.RANDOM_STATE,
                order: Column | None = None, **kw) -> DataFrame:
    """BA2: keep the first ``target`` rows of each class in hash order.

    A float keeps ``int(n_minority / ratio)`` majority rows (all others
    untouched); a dict gives the count to keep per class.
    """
    counts = class_counts(df, label)
    if isinstance(sampling_strategy, dict):
        keep = dict(sampling_strategy)
    else:
        minority = min(counts, key=lambda c: (counts[c], c))
        majority = max(counts, key=lambda c: (counts[c], -c if isinstance(c, int) else 0))
        keep = {c: n for c, n in counts.items()}
        keep[majority] = int(counts[minority] / sampling_strategy)
        keep[minority] = counts[minority]
    o = order if order is not None else hash_order(key_cols, seed)
    ranked = exact_rank(df.withColumn("_ord", o), [label],
                        [("_ord", True)] + [(c, True) for c in key_cols], "_rank", **kw)
    return ranked.where(F.col("_rank") <= _by_class(label, keep)).drop("_rank", "_ord")


def smote(df: DataFrame, label: str, features: str, key: str, k_neighbors: int = 5,
          seed: int = config.RANDOM_STATE, minority=None) -> DataFrame:
    """BA1: synthesise minority rows ``x + u * (neighbour - x)`` up to parity.

    ``features`` is an array<double> column.  Neighbours are the exact
    ``k`` nearest minority rows (``plans.pivots``: blocks of rows that the
    triangle inequality can't rule out are compared).  Each minority row (in hash order) makes an equal share
    of the synthetic rows; the neighbour and ``u`` come from hashes of (row,
    draw, seed), so the output is reproducible under any partitioning.
    Returns the input plus the synthetic rows (``synthetic`` = 1).
    """
    from riskloom.plans.pivots import nearest_rows

    counts = class_counts(df, label)
    if len(counts) < 2:
        return df.withColumn("synthetic", F.lit(0))
    mino = minority if minority is not None else min(counts, key=lambda c: (counts[c], c))
    n_min, n_maj = counts[mino], max(counts.values())
    need = n_maj - n_min
    base = df.withColumn("synthetic", F.lit(0))
    if need <= 0 or n_min < 2:
        return base
    minor = df.where(F.col(label) == F.lit(mino)).select(key, features)
    kk = min(k_neighbors, n_min - 1)
    nn = nearest_rows(minor, key, features, kk)  # key, nbr_rank (1..kk), nbr_key, nbr_features
    nbrs = nn.groupBy(key).agg(F.sort_array(F.collect_list(
        F.struct("nbr_rank", F.col("nbr_features").alias("f")))).alias("nbrs"))  # kk per row
    ranked = exact_rank(minor.withColumn("_ord", F.xxhash64(F.lit(seed), F.col(key))),
                        [], [("_ord", True), (key, True)], "_rank")
    per, extra = divmod(need, n_min)
    m = F.lit(per) + F.when(F.col("_rank") <= extra, 1).otherwise(0)
    draws = (ranked.join(nbrs, on=key).where(m > 0)
             .withColumn("_draw", F.explode(F.sequence(F.lit(0), m - 1))))
    h = F.xxhash64(F.lit(seed), F.col(key), F.col("_draw"))
    pick = (F.pmod(h, F.lit(kk)) + 1).cast("int")
    u = (F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key), F.col("_draw")), F.lit(1 << 24))
         / F.lit(float(1 << 24)))
    nb = F.element_at("nbrs", pick)["f"]
    synth = F.zip_with(features, nb, lambda a, b: a + u * (b - a))
    out_cols = []
    for c in df.columns:
        if c == features:
            out_cols.append(synth.alias(c))
        elif c == label:
            out_cols.append(F.lit(mino).cast(df.schema[label].dataType).alias(c))
        elif c == key:
            out_cols.append(F.xxhash64(F.lit("smote"), F.col(key), F.col("_draw")).cast(
                df.schema[key].dataType).alias(c))
        else:
            out_cols.append(F.lit(None).cast(df.schema[c].dataType).alias(c))
    synthetic = draws.select(*out_cols, F.lit(1).alias("synthetic"))
    return base.unionByName(synthetic)
