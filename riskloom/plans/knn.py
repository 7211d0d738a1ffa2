"""Exact k-nearest-donor imputation over the leaves of balanced split trees.

Semantics (the usual KNN imputer, uniform weights): for a row missing
column ``c`` the donors are the rows where ``c`` is present; the distance
over ``p`` columns uses the coordinates present in both rows,
``d^2 = p / |S| * sum_{j in S} (x_j - y_j)^2``, undefined when ``S`` is
empty.  The imputed value is the mean of ``c`` over the ``k`` nearest donors
with a defined distance (ties cut by donor key); with none, the column
mean.  Distances use the original (un-imputed) values for every column.

Plan, for all columns at once:

* receivers with equal coordinates have equal donors, so each distinct vector
  is searched once; of donors with equal coordinates only the ``k`` smallest
  keys can be chosen, so only those stay;
* a k-d tree per column, grown on a bounded sample of its donors: a node with
  and without nulls in a coordinate is split there, others at the median of
  their widest coordinate.  The sample decides how even the leaves are, never
  the result.  Every donor goes to its leaf, in blocks of bounded size, and a
  leaf's bounding box is aggregated from all of its donors;
* **phase 1** compares a receiver with the donors of its own leaf; the k-th
  smallest distance there bounds that of its true k-th neighbour (no bound if
  there are fewer);
* **phase 2** compares it with every leaf whose box is within that bound.  The
  box of a coordinate without nulls in the leaf gives the least distance, with
  ``|S|`` at most the coordinates that both sides have;
* the candidates of all leaves are cut to the k nearest.

Blocks are compared in the tasks (numpy), so no pairs are shuffled.  The driver
sees the sample and a box per leaf.  With more than ``MAX_LEAVES * leaf`` donors
the leaves grow and not their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from riskloom.session import ship_package, written

SAMPLE = 1 << 17  # donors that the trees are grown on, about
MAX_LEAVES = 4096
LEAST_SAMPLED = 32  # sampled donors in a node worth splitting


@dataclass
class Tree:
    """Nodes of one column's tree; a leaf has ``coord`` -1 and a number that no other tree uses."""

    coord: np.ndarray
    cut: np.ndarray  # NaN: the split is by presence
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray

    def leaves(self, x: np.ndarray, receivers: bool) -> np.ndarray:
        """The leaf of each row; a receiver that lacks a coordinate follows the donors that have it."""
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = np.flatnonzero(self.coord[node] >= 0)
            if not len(inner):
                return self.leaf[node]
            at = node[inner]
            value, cut = x[inner, self.coord[at]], self.cut[at]
            presence = np.isnan(cut)
            right = np.where(presence, receivers | ~np.isnan(value), value > cut)
            node[inner] = np.where(right, self.right[at], self.left[at])


def grow(x: np.ndarray, rows_per_leaf: int, first_leaf: int) -> Tree:
    """A tree over the sampled donors ``x``, with leaves numbered from ``first_leaf``."""
    nodes: list[list] = []  # coord, cut, left, right, leaf
    leaves = first_leaf

    def split(rows: np.ndarray) -> tuple[int, float, np.ndarray] | None:
        if len(rows) <= rows_per_leaf:
            return None
        some, absent = x[rows], np.isnan(x[rows])
        mixed = absent.any(0) & ~absent.all(0)
        if mixed.any():
            j = int(mixed.argmax())
            return j, np.nan, ~absent[:, j]
        low, high = np.where(absent, np.inf, some).min(0), np.where(absent, -np.inf, some).max(0)
        spread = np.subtract(high, low, out=np.zeros(len(low)), where=high > low)
        j = int(spread.argmax())
        if not spread[j] > 0:
            return None
        middle = np.sort(some[:, j])[(len(some) - 1) // 2]
        cut = float(middle if middle < some[:, j].max() else some[:, j][some[:, j] < middle].max())
        return j, cut, some[:, j] > cut

    todo = [np.arange(len(x))]
    nodes.append([-1, 0.0, -1, -1, -1])
    at = 0
    while at < len(nodes):  # nodes and their rows are in the same order
        found = split(todo[at])
        if found is None:
            nodes[at][4], leaves = leaves, leaves + 1
        else:
            j, cut, right = found
            nodes[at][:4] = [j, cut, len(nodes), len(nodes) + 1]
            todo += [todo[at][~right], todo[at][right]]
            nodes += [[-1, 0.0, -1, -1, -1], [-1, 0.0, -1, -1, -1]]
        at += 1
    kinds = (np.int64, np.float64, np.int64, np.int64, np.int64)
    return Tree(*(np.array(c, dtype=d) for c, d in zip(zip(*nodes, strict=True), kinds, strict=True)))


@dataclass
class Boxes:
    """Bounds of the leaves of one column's tree; NaN where a coordinate doesn't bound."""

    leaf: np.ndarray
    low: np.ndarray
    high: np.ndarray
    some: np.ndarray  # whether any donor of the leaf has the coordinate

    def within(self, x: np.ndarray, r: np.ndarray) -> Iterator[np.ndarray]:
        """For each receiver the leaves that may hold a donor at a distance of at most ``r``."""
        p = x.shape[1]
        for start in range(0, len(x), 256):
            part, reach = x[start:start + 256], r[start:start + 256]
            total = np.zeros((len(part), len(self.leaf)))
            shared = (~np.isnan(part)).astype(np.float64) @ self.some.T
            for j in range(p):
                with np.errstate(invalid="ignore"):
                    gap = np.fmax(np.fmax(self.low[None, :, j] - part[:, None, j], part[:, None, j] - self.high[None, :, j]), 0.0)
                total += np.nan_to_num(gap, nan=0.0, posinf=np.inf) ** 2
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.sqrt(p / shared * total) * (1 - 1e-9)  # below the rounding of the distances
            for i in range(len(part)):
                yield self.leaf[(shared[i] > 0) & ~(least[i] > reach[i])]


def _matrix(column: pa.Array, p: int) -> np.ndarray:
    """Rows of an array column of ``p`` values each; null is NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, p)


def _leaf_of(trees: dict[int, Tree], receivers: bool):
    def run(columns: pd.Series, rows: pd.Series) -> pd.Series:
        x, which = np.stack(rows.to_list()).astype(np.float64), columns.to_numpy()
        out = np.empty(len(x), dtype=np.int32)
        for t in np.unique(which):
            at = np.flatnonzero(which == t)
            out[at] = trees[int(t)].leaves(x[at], receivers)
        return pd.Series(out)

    return F.pandas_udf(run, "int")


def _reached(boxes: dict[int, Boxes], p: int, schema: pa.Schema):
    """Each receiver once for every leaf within its radius."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                x, which = _matrix(batch.column("x"), p), batch.column("t").to_numpy()
                r = batch.column("r").to_numpy(zero_copy_only=False).astype(np.float64)
                r = np.where(np.isnan(r), np.inf, r)
                places, leaves = [], []
                for t in np.unique(which):
                    at = np.flatnonzero(which == t)
                    for i, found in zip(at, boxes[int(t)].within(x[at], r[at]), strict=True):
                        places.append(np.full(len(found), i))
                        leaves.append(found)
                take = pa.array(np.concatenate(places)) if places else pa.array([], pa.int64())
                out = {"leaf": pa.array(np.concatenate(leaves) if leaves else [], pa.int32()), "r": pa.array(r, pa.float64()).take(take)}
                yield pa.RecordBatch.from_arrays([out[f.name] if f.name in out else batch.column(f.name).take(take) for f in schema],
                                                 schema=schema)

    return run


def _nearest(k: int, p: int, schema: pa.Schema):
    """The ``k`` nearest donors of a block within the radius of each receiver of a block; ties to the smaller key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                recv, donors = batch.column("receivers")[row].values, batch.column("donors")[row].values
                x, y = _matrix(recv.field("x"), p), _matrix(donors.field("x"), p)
                r = recv.field("r").to_numpy(zero_copy_only=False).astype(np.float64)
                total, shared = np.zeros((len(x), len(y))), np.zeros((len(x), len(y)))
                for j in range(p):
                    gap = x[:, None, j] - y[None, :, j]
                    both = ~np.isnan(gap)
                    total += np.where(both, gap * gap, 0.0)
                    shared += both
                with np.errstate(divide="ignore", invalid="ignore"):
                    d = np.sqrt(p / shared * total)
                reach = np.where(np.isnan(r), np.inf, r)
                i, j = np.nonzero((shared > 0) & (d <= reach[:, None]))
                order = np.lexsort((d[i, j], i))  # stable: equal distances stay in the order of the keys
                i, j = i[order], j[order]
                keep = np.arange(len(i)) - np.searchsorted(i, i) < k
                i, j = i[keep], j[keep]
                out = {"t": recv.field("t").take(pa.array(i)), "vec": recv.field("vec").take(pa.array(i)), "d": pa.array(d[i, j]),
                       "dkey": donors.field("dkey").take(pa.array(j)), "val": donors.field("val").take(pa.array(j))}
                yield pa.RecordBatch.from_arrays([out[f.name].cast(f.type) for f in schema], schema=schema)

    return run


def _vector_key(array: str) -> Column:
    return F.concat_ws("|", F.transform(array, lambda v: F.coalesce(v.cast("string"), F.lit("~"))))


def _first_k(df: DataFrame, group: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows of each group; Spark cuts a group to ``k`` in every task before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def _blocks(df: DataFrame, size: int, by: str, columns: Sequence[str], name: str) -> DataFrame:
    """(leaf, ``name``): the rows of each leaf in sorted arrays of about ``size``."""
    parts = df.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts"))
    block = F.pmod(F.xxhash64(by), "parts")
    return (df.join(parts, "leaf").groupBy("leaf", block.alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name)).drop("block"))


def _grown(donors: DataFrame, counts: dict[int, int], p: int, leaf: int) -> dict[int, Tree]:
    """A tree for each column, on a sample by hash of all donors."""
    total = sum(counts.values())
    share = min(1.0, SAMPLE / max(total, 1))
    some = donors.where(F.pmod(F.xxhash64("t", "vec", "dkey"), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0)
                        ).select("t", "x").toArrow()
    which = some.column("t").to_numpy()
    x = _matrix(some.column("x").combine_chunks(), p) if some.num_rows else np.empty((0, p))
    per_leaf = max(int(leaf * share), LEAST_SAMPLED, -(-2 * len(x) // MAX_LEAVES))
    trees, first = {}, 0
    for t in counts:
        trees[t] = grow(x[which == t], per_leaf, first)
        first = int(trees[t].leaf.max()) + 1
    return trees


def _bounds(placed: DataFrame, p: int, todo: Sequence[int]) -> dict[int, Boxes]:
    """The boxes of all leaves, a row each."""
    aggs = [f(F.get("x", F.lit(j))).alias(f"{n}{j}") for j in range(p) for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]
    rows = placed.groupBy("t", "leaf").agg(F.count(F.lit(1)).alias("n"), *aggs).toPandas()
    out = {}
    for t in todo:
        r = rows[rows["t"] == t]
        some = np.stack([r[f"n{j}"].to_numpy() > 0 for j in range(p)], axis=1)
        full = np.stack([(r[f"n{j}"] == r["n"]).to_numpy() for j in range(p)], axis=1)
        low, high = (np.stack([r[f"{s}{j}"].to_numpy(dtype=np.float64) for j in range(p)], axis=1) for s in ("lo", "hi"))
        out[t] = Boxes(r["leaf"].to_numpy(), np.where(full, low, np.nan), np.where(full, high, np.nan), some.astype(np.float64))
    return out


def knn_impute(df: DataFrame, key: str, cols: Sequence[str], k: int = 5, leaf: int = 256, block: int = 1024) -> DataFrame:
    """Impute every null in ``cols`` from its ``k`` nearest donors (see module doc).

    A column without any value stays null.
    """
    cols = list(cols)
    p, spark = len(cols), df.sparkSession
    st = df.agg(F.count(F.lit(1)).alias("rows"), *[f(F.col(c).cast("double")).alias(f"{n}_{i}") for i, c in enumerate(cols)
                                                   for n, f in (("n", F.count), ("m", F.avg))]).first()
    counts = {i: st[f"n_{i}"] for i in range(p)}
    todo = [i for i in range(p) if counts[i] < st["rows"]]
    if not todo:
        return df
    ship_package(spark)
    order = sorted(range(p), key=lambda i: -counts[i])  # the order in which squares are added
    place = {i: at for at, i in enumerate(order)}
    x = F.array(*[F.col(cols[i]).cast("double") for i in order])
    values = F.array(*[F.struct(F.lit(i).alias("t"), F.col(cols[i]).cast("double").alias("val"), F.lit(place[i]).alias("at")) for i in todo])
    base = df.select(F.col(key).alias("dkey"), x.alias("x"), F.explode(values).alias("v")).select("dkey", "x", "v.*")
    known = F.exists("x", lambda e: e.isNotNull())

    missing = base.where("val is null").select("dkey", "t", "x", _vector_key("x").alias("vec"))
    receivers = missing.where(known).select("t", "vec", "x").dropDuplicates(["t", "vec"])
    donors = (base.where("val is not null").withColumn("x", F.transform("x", lambda e, j: F.when(j != F.col("at"), e)))
              .where(known).select("t", "dkey", "x", "val", _vector_key("x").alias("vec")))
    donors = written(_first_k(donors, ["t", "vec"], ["dkey"], k))

    trees = _grown(donors, {t: counts[t] for t in todo}, p, leaf)
    placed = donors.withColumn("leaf", _leaf_of(trees, False)("t", "x"))
    boxes = _bounds(placed, p, todo)
    tiles = written(_blocks(placed, block, "dkey", ["dkey", "x", "val"], "donors"))

    shape = StructType([*receivers.schema.fields, *StructType.fromDDL("r double, leaf int").fields])
    result = StructType([receivers.schema["t"], receivers.schema["vec"], *StructType.fromDDL("d double").fields,
                         donors.schema["dkey"], donors.schema["val"]])

    def near(to_search: DataFrame) -> DataFrame:
        met = _blocks(to_search, block, "vec", ["t", "vec", "x", "r"], "receivers").join(tiles, "leaf").select("receivers", "donors")
        return met.mapInArrow(_nearest(k, p, to_arrow_schema(result)), result)

    home = receivers.withColumns({"r": F.lit(None).cast("double"), "leaf": _leaf_of(trees, True)("t", "x")})
    radius = near(home).groupBy("t", "vec").agg(F.get(F.sort_array(F.collect_list("d")), F.lit(k - 1)).alias("r"))
    bounded = receivers.join(radius, ["t", "vec"], "left").select("t", "vec", "x", "r")
    reached = written(bounded.mapInArrow(_reached(boxes, p, to_arrow_schema(shape)), shape))
    imputed = _first_k(near(reached), ["t", "vec"], ["d", "dkey"], k).groupBy("t", "vec").agg(F.avg("val").alias("imp"))

    fills = missing.join(imputed, ["t", "vec"], "left").groupBy("dkey").agg(
        *[F.max(F.when(F.col("t") == t, F.coalesce("imp", F.lit(st[f"m_{t}"]).cast("double")))).alias(f"_f{t}") for t in todo])
    out = df.join(fills.withColumnRenamed("dkey", "_knn_key"), df[key] == F.col("_knn_key"), "left")
    filled = {cols[t]: t for t in todo}
    return out.select(*[(F.coalesce(df[c].cast("double"), F.col(f"_f{filled[c]}")).alias(c) if c in filled else df[c]) for c in df.columns])
