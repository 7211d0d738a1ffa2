"""Exact nearest rows by a pivot index.

Some rows far apart (`choose`, from a bounded sample) are pivots.  Rows are
dealt by range of (nearest pivot, distance to it, key) and packed into blocks,
so that a block is a part of a shell around its pivot; equal rows spread over
blocks by their keys.  A block knows the least and the largest distance of its
rows to every pivot, and the distance within which each of its rows finds ``k``
others in the block itself.

By the triangle inequality a row within ``r`` of a block's row differs from it
by at most ``r`` in its distance to any pivot.  Blocks whose shells are further
apart at some pivot are never compared: candidate pairs come from an equi-join
on cells of the distance to the block's own pivot, and all pivots then filter
them.  Pairs of blocks are compared in the tasks, a row at a time only where
its own radius reaches the other block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.session import ship_package, written

CELLS = 256  # cells per pivot's range of distances


def choose(df: DataFrame, key: str, features: str, pivots: int, sample: int = 256) -> np.ndarray:
    """Rows far apart, of the ``sample`` rows of the least key hashes."""
    some = df.select(F.xxhash64(key).alias("h"), F.col(features).cast("array<double>").alias("x")).orderBy("h").limit(sample).collect()
    x = np.unique(np.array([r["x"] for r in some], dtype=float), axis=0)
    picked = [int(((x - x.mean(0)) ** 2).sum(1).argmax())]
    while len(picked) < min(pivots, len(x)):
        least = ((x[:, None] - x[picked][None]) ** 2).sum(-1).min(1)
        picked.append(int(least.argmax()))
    return x[picked]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances up to rounding."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def nearest(a: np.ndarray, b: np.ndarray, k: int, skip: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row of ``a`` its ``k`` nearest of ``b`` (places, exact distances); ties to the first.

    ``skip``: both are one block, and a row isn't its own neighbour.
    """
    rough = distances(a, b)
    slack = 1e-6 * (1 + float(rough.max(initial=0.0)))  # beyond the rounding of `distances`
    for i in range(len(a)):
        if skip:
            rough[i, i] = np.inf
        reach = np.partition(rough[i], min(k, len(b)) - 1)[min(k, len(b)) - 1] + slack
        at = np.flatnonzero(rough[i] <= reach) if np.isfinite(reach) else np.flatnonzero(np.isfinite(rough[i]))
        exact = np.sqrt(((b[at] - a[i]) ** 2).sum(1))
        order = np.argsort(exact, kind="stable")[:k]
        yield at[order], exact[order]


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _place(pivots: np.ndarray, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = distances(_matrix(batch.column("x"), batch.num_rows), pivots)
                cell = d.argmin(1)
                out = {"cell": pa.array(cell, pa.int32()), "d": pa.array(d[np.arange(len(d)), cell], pa.float64())}
                yield pa.RecordBatch.from_arrays([out[f.name] if f.name in out else batch.column(f.name) for f in schema], schema=schema)

    return run


def _pack(pivots: np.ndarray, k: int, size: int, schema: pa.Schema):
    """Sorted rows into blocks of ``size`` rows; what is left of a cell joins the block before if it is small."""

    def block(part: int, number: int, rows: pa.RecordBatch) -> pa.RecordBatch:
        rows = rows.sort_by("key")  # ties go to the least key
        x = _matrix(rows.column("x"), rows.num_rows)
        d = distances(x, pivots)
        radius = np.full(len(x), np.inf)
        if len(x) > k:
            radius = np.array([r[-1] for _, r in nearest(x, x, k, True)])
        values = {"block": (part << 24) + number, "cell": int(np.bincount(d.argmin(1)).argmax()), "key": rows.column("key").to_pylist(),
                  "x": x.tobytes(), "n": len(x), "radius": radius.tobytes(), "r": float(radius.max()),
                  "low": d.min(0).tolist(), "high": d.max(0).tolist()}
        return pa.RecordBatch.from_arrays([pa.array([values[f.name]], f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number = part = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            held.append(batch)
            while sum(b.num_rows for b in held) >= 2 * size:
                rows = _joined(held)
                yield block(part, number, rows.slice(0, size))
                held, number = [rows.slice(size)], number + 1
        if held:
            rows = _joined(held)
            cut = size if rows.num_rows - size > k else rows.num_rows
            yield block(part, number, rows.slice(0, cut))
            if cut < rows.num_rows:
                yield block(part, number + 1, rows.slice(cut))

    return run


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _compare(k: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a, b = (np.frombuffer(r[c]).reshape(r[n], -1) for c, n in (("x", "n"), ("other_x", "other_n")))
                same = r["block"] == r["other"]
                radius = np.frombuffer(r["radius"])
                # a row whose radius doesn't reach the other block at some pivot has no neighbour there
                d = distances(a, np.frombuffer(r["pivots"]).reshape(-1, a.shape[1]))
                gap = np.maximum(np.maximum(np.array(r["other_low"])[None] - d, d - np.array(r["other_high"])[None]), 0).max(1)
                rows = np.arange(len(a)) if same else np.flatnonzero(gap <= radius * (1 + 1e-9) + 1e-6)
                out: dict[str, list] = {"key": [], "nbr_key": [], "d": []}
                for i, (at, exact) in zip(rows.tolist(), nearest(a[rows], b, k, same), strict=True):
                    out["key"] += [r["key"][i]] * len(at)
                    out["nbr_key"] += [r["other_key"][j] for j in at.tolist()]
                    out["d"] += exact.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run


def nearest_rows(df: DataFrame, key: str, features: str, k: int, pivots: int = 8, size: int = 1024) -> DataFrame:
    """The exact ``k`` nearest other rows: (key, nbr_rank (1..k), nbr_key, nbr_features).

    Euclidean distance of complete arrays of one length; ties go to the least
    neighbour key.  Keys must differ.
    """
    ship_package(df.sparkSession)
    schema_of = lambda frame: to_arrow_schema(frame.schema)
    points = df.select(F.col(key).alias("key"), F.col(features).cast("array<double>").alias("x"))
    kind = dict(points.dtypes)["key"]
    centres = choose(points, "key", "x", pivots) if points.limit(1).collect() else np.zeros((1, 1))
    placed = points.withColumns({"cell": F.lit(0), "d": F.lit(0.0)})
    placed = placed.mapInArrow(_place(centres, schema_of(placed)), placed.schema)
    sorted_rows = (placed.repartitionByRange("cell", "d", "key").sortWithinPartitions("cell", "d", "key")
                   .select("key", "x", F.spark_partition_id().cast("long").alias("part")))
    spark = df.sparkSession
    ddl = f"block long, cell int, key array<{kind}>, x binary, n int, radius binary, r double, low array<double>, high array<double>"
    blocks = written(sorted_rows.mapInArrow(_pack(centres, k, size, schema_of(spark.createDataFrame([], ddl))), ddl))

    # candidate pairs: shells that meet around the block's own pivot, by cells of that distance; then all pivots
    summary = blocks.select("block", "cell", "r", "low", "high")
    ends = summary.select(F.explode("high").alias("v")).agg(F.max("v").alias("top")).first()["top"] or 0.0
    step = float(ends / CELLS) or 1.0
    cell_of = lambda v: F.least(F.greatest(F.floor(v / step), F.lit(0)), F.lit(CELLS)).cast("int")
    shells = summary.select("block", "low", "high", F.posexplode("low").alias("p", "from")).withColumn("to", F.get("high", F.col("p")))
    shells = shells.withColumn("at", F.explode(F.sequence(cell_of(F.col("from")), cell_of(F.col("to"))))).select(
        "p", "at", F.col("block").alias("other"), F.col("low").alias("other_low"), F.col("high").alias("other_high"))
    # a block of at most k rows reaches everything: no two rows are further apart than twice the largest distance
    asks = summary.withColumn("r", F.least("r", F.lit(2 * ends + 1))).withColumn("p", F.col("cell")).withColumn("at", F.explode(F.sequence(
        cell_of(F.get("low", F.col("cell")) - F.col("r")), cell_of(F.get("high", F.col("cell")) + F.col("r")))))
    gap = F.zip_with(F.zip_with("other_low", "high", lambda a, b: a - b), F.zip_with("low", "other_high", lambda a, b: a - b),
                     lambda a, b: F.greatest(a, b))
    near = F.forall(gap, lambda g: g <= F.col("r") * (1 + 1e-9) + 1e-6)
    pairs = asks.join(shells, ["p", "at"]).where(near | (F.col("block") == F.col("other"))).select("block", "other").distinct()

    left = blocks.select("block", "key", "x", "n", "radius")
    right = blocks.select(F.col("block").alias("other"), F.col("key").alias("other_key"), F.col("x").alias("other_x"),
                          F.col("n").alias("other_n"), F.col("low").alias("other_low"), F.col("high").alias("other_high"))
    both = written(pairs).join(left, "block").join(right, "other").withColumn("pivots", F.lit(centres.tobytes()))
    found = f"key {kind}, nbr_key {kind}, d double"
    near_rows = both.mapInArrow(_compare(k, schema_of(spark.createDataFrame([], found))), found)
    rank = F.row_number().over(Window.partitionBy("key").orderBy("d", "nbr_key"))
    top = near_rows.withColumn("nbr_rank", rank).where(F.col("nbr_rank") <= k)
    values = points.select(F.col("key").alias("nbr_key"), F.col("x").alias("nbr_features"))
    return top.join(values, "nbr_key").select(F.col("key").alias(key), "nbr_rank", "nbr_key", "nbr_features")
