"""Exact ranks and running sums without a single-task window.

``Window.orderBy(...)`` with no partition (or partitioned by a label that
holds 80% of the rows) sends everything to one task.  ``running_totals``
keeps the result exact but splits the order into ``B`` ordered buckets:

* bucket boundaries come from ``percentile_approx`` of the leading order key
  (approximate boundaries only affect balance, never the result).  Where that
  key can't split the rows (a value holds more than a bucket, or it is no
  number), the rows are dealt by range of the whole order instead and written
  once, so that every later read sees the same buckets;
* per (group, bucket) totals are a small partial aggregation, turned into
  bucket offsets by a window over that small table;
* inside each (group, bucket) a bounded window gives local running sums;
* offset + local = the exact running sum over the whole group.

``B = ceil(rows / rows_per_bucket)`` so a bucket never exceeds what one task
can sort; with few rows it is 1 and the plan is a plain partitioned window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskloom import config
from riskloom.session import written

_B = "_bucket"
_K = "_key0"


def _order_cols(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL matches NULL; the keys come once, from ``left``."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_right_{k}" for k in keys])


def bucketed(df: DataFrame, order: Sequence[tuple[str, bool]], n_buckets: int) -> DataFrame:
    """``df`` with the number of an ordered bucket, of about equal sizes, in ``_bucket``."""
    if n_buckets == 1:
        return df.withColumn(_B, F.lit(0))
    k0, asc0 = order[0]
    if isinstance(df.schema[k0].dataType, NumericType):
        keyed = df.withColumn(_K, F.col(k0).cast("double") * F.lit(1.0 if asc0 else -1.0))
        probs = [i / n_buckets for i in range(1, n_buckets)]
        bounds = keyed.agg(F.percentile_approx(_K, probs, max(10_000, 20 * n_buckets)).alias("b"),
                           F.count(F.when(F.col(_K).isNull(), 1)).alias("nulls"), F.count(F.lit(1)).alias("rows")).first()
        cuts = sorted(set(map(float, bounds["b"] or [])))
        if len(cuts) == len(probs) and all(map(math.isfinite, cuts)) and bounds["nulls"] * n_buckets <= bounds["rows"]:
            keyed = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=_K, outputCol=_B, handleInvalid="keep").transform(keyed)
            first, last = F.lit(-1), F.lit(n_buckets)  # NULL is before all values and NaN after them, or the reverse
            place = (F.when(F.col(_K).isNull(), first if asc0 else last).when(F.isnan(_K), last if asc0 else first)
                     .otherwise(F.col(_B)))
            return keyed.withColumn(_B, place.cast("int"))
    return written(df.repartitionByRange(n_buckets, *_order_cols(order)).withColumn(_B, F.spark_partition_id()))


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]],
                   sums: dict[str, Column], rows_per_bucket: int | None = None,
                   n_rows: int | None = None) -> DataFrame:
    """Add inclusive running sums ``sums`` over ``order`` within ``by``.

    ``order`` is a list of ``(column, ascending)``; it should be unique per
    group (ties are cut in arbitrary order, as in any ROWS frame).
    """
    by = list(by)
    rows_per_bucket = rows_per_bucket or config.ROWS_PER_BUCKET
    if n_rows is None:
        n_rows = df.count()
    n_buckets = max(1, math.ceil(n_rows / rows_per_bucket))
    keyed = bucketed(df.withColumns({f"_v_{name}": expr for name, expr in sums.items()}), order, n_buckets)

    part = by + [_B]
    local_w = Window.partitionBy(*part).orderBy(*_order_cols(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = keyed
    for name in sums:
        local = local.withColumn(name, F.sum(f"_v_{name}").over(local_w))

    if n_buckets == 1:
        out = local
    else:
        totals = keyed.groupBy(*part).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
        prev_w = (Window.partitionBy(*by).orderBy(_B)
                  .rowsBetween(Window.unboundedPreceding, -1))
        offsets = totals.select(*part, *[F.coalesce(F.sum(f"_t_{n}").over(prev_w), F.lit(0))
                                         .alias(f"_o_{n}") for n in sums])
        # a row per group and bucket; NULL is a group like any other
        out = null_safe_join(local, offsets, part, "left")
        for name in sums:
            out = out.withColumn(name, F.col(name) + F.coalesce(F.col(f"_o_{name}"), F.lit(0)))
    drop = [_K, _B] + [f"_v_{n}" for n in sums] + [f"_o_{n}" for n in sums]
    return out.drop(*[c for c in drop if c in out.columns])


def exact_rank(df: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]],
               name: str = "rank", **kw) -> DataFrame:
    """1-based ``row_number`` within ``by`` over a unique ``order``."""
    return running_totals(df, by, order, {name: F.lit(1).cast("long")}, **kw)
