"""Embedding near-dedup (operator 2).

Sorted projection passes: each pass draws random hyperplanes through the mean
of a label's unit vectors, orders the label's vectors lexicographically by
their concatenated sign bits, and compares each vector with its neighbours in
windows of that order.  Verified links of all passes are united to components.
All passes go through one range shuffle by (pass, label, bits), so a label of
any size is dealt to many tasks.  Windows go on across the edge of two tasks'
ranges: the rows next to it are compared by a second, small grouping.  (A range
of fewer rows than a window ends the window there; the other passes have
other ranges.)

An exact check follows: within a component that the passes have found, all
vectors are compared in tiles, so that ``n_links`` counts every link of the
component, however dense it is, and no pairs are written out.  A link is
lost only if no pass found any link between its two components.

Equal vectors of a label are one node with a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import written

from .common import record
from .graph import connected_components
from .simhash import forest

KEYED = pa.schema([("pass", pa.int32()), ("label", pa.string()), ("dim", pa.int32()), ("key", pa.binary()),
                   ("node", pa.int64()), ("vec", pa.list_(pa.float64()))])
SHAPE = "pass int, label string, dim int, key binary, node long, vec array<double>"
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("edge", pa.int32()), *KEYED])
SUMS = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("total", pa.list_(pa.float64())), ("n", pa.int64())])
LINKS = pa.schema([("node", pa.int64()), ("links", pa.int64())])


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def planes(number: int, dim: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, number, dim]).standard_normal((dim, bits))


def _rows(column: pa.Array) -> list[np.ndarray]:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    sizes = np.asarray(column.value_lengths())
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a batch's unit vectors by label and dimension."""
    for batch in batches:
        totals: dict[tuple, list] = {}
        for label, vec in zip(batch.column("label").to_pylist(), _rows(batch.column("vec")), strict=True):
            totals.setdefault((label, len(vec)), []).append(vec)
        yield record(SUMS, label=[k[0] for k in totals], dim=[k[1] for k in totals],
                     total=[units(np.stack(v)).sum(axis=0) for v in totals.values()], n=[len(v) for v in totals.values()])


def means(nodes: DataFrame) -> DataFrame:
    """(label, dim, mean): the mean unit vector of every label and dimension."""
    parts = nodes.select("label", "vec").mapInArrow(_sums, "label string, dim int, total array<double>, n long")
    each = (parts.select("label", "dim", "n", F.posexplode("total")).groupBy("label", "dim", "pos")
            .agg((F.sum("col") / F.sum("n")).alias("x")))
    return each.groupBy("label", "dim").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("m")).select(
        "label", "dim", F.col("m.x").alias("mean"))


def _keys(passes: int, bits: int, seed: int):
    """Each vector once a pass, with the pass's sign bits as a sortable key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, nodes, labels, middles = (_rows(batch.column("vec")), batch.column("node"), batch.column("label"),
                                            _rows(batch.column("mean")))
            dims = np.array([len(v) for v in vecs])
            for dim in np.unique(dims):
                which = np.flatnonzero(dims == dim)
                matrix = np.stack([vecs[i] for i in which])
                centred = units(matrix) - np.stack([middles[i] for i in which])
                for number in range(passes):
                    key = np.packbits(centred @ planes(number, int(dim), bits, seed) > 0, axis=1)
                    yield record(KEYED, **{"pass": np.full(len(which), number), "dim": np.full(len(which), dim)},
                                 label=labels.take(pa.array(which)), key=[k.tobytes() for k in key],
                                 node=nodes.take(pa.array(which)), vec=list(matrix))

    return run


def linked(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Whether rows of unit vectors reach the cosine; values next to it are summed again without cancelling."""
    cosine = left @ right.T
    close = np.argwhere(np.abs(cosine - threshold) < 1e-12)
    for i, j in close:
        cosine[i, j] = np.longdouble(left[i]) @ np.longdouble(right[j])
    return cosine >= threshold


def _spanning(nodes: np.ndarray, matrix: np.ndarray, old: int, threshold: float, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links between sorted rows at most ``window`` apart, the later one past the first ``old``."""
    def pairs():
        for at in range(max(old, 1), len(nodes), window):
            low = max(0, at - window)
            rows = slice(at, min(at + window, len(nodes)))
            i, j = np.nonzero(linked(matrix[rows], matrix[low:rows.stop], threshold))
            i, j = i + at, j + low
            ok = (j < i) & (i - j <= window)
            yield i[ok], j[ok]

    label = forest(len(nodes), pairs())
    which = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[which]], nodes[which]


def _windows(threshold: float, window: int):
    """Spanning edges within a task's range, and with ``edge`` the range's first and last rows.

    Edge ``p`` lies between the ranges of tasks ``p - 1`` and ``p``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple] = []  # the last rows of the current (pass, label, dim)
        first, head = None, 0  # the range's first group, and its rows handed out so far

        def border(rows: list[tuple], edge: int) -> pa.RecordBatch:
            number, label, dim = zip(*(r[0] for r in rows), strict=True)
            return record(FOUND, a=[None] * len(rows), b=[None] * len(rows), edge=[edge] * len(rows), **{"pass": number},
                          label=label, dim=dim, key=[r[3] for r in rows], node=[r[1] for r in rows], vec=[r[2] for r in rows])

        for batch in batches:
            rows = list(zip(zip(*(batch.column(c).to_pylist() for c in ("pass", "label", "dim")), strict=True),
                            batch.column("node").to_pylist(), _rows(batch.column("vec")),
                            batch.column("key").to_pylist(), strict=True))
            at = 0
            while at < len(rows):
                end = at
                while end < len(rows) and rows[end][0] == rows[at][0]:
                    end += 1
                old = held if held and held[0][0] == rows[at][0] else []
                group = old + rows[at:end]
                a, b = _spanning(np.array([g[1] for g in group]), units(np.stack([g[2] for g in group])), len(old),
                                 threshold, window)
                if len(a):
                    yield record(FOUND, a=a, b=b, **dict.fromkeys(["edge", *KEYED.names], [None] * len(a)))
                first = first or rows[at][0]
                if rows[at][0] == first and head < window:
                    lead = rows[at:min(end, at + window - head)]
                    head += len(lead)
                    yield border(lead, part)
                held, at = group[-window:], end
        if held:
            yield border(held, part + 1)

    return run


def _across(threshold: float, window: int):
    """Spanning edges between the rows on either side of an edge, which come as one sorted list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.column("rows"):
                nodes = np.asarray(one.values.field("node"))
                yield record(EDGES, **dict(zip("ab", _spanning(nodes, units(np.stack(_rows(one.values.field("vec")))), 0,
                                                              threshold, window), strict=True)))

    return run


def _tiles(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, links = [], []
            for row in range(batch.num_rows):
                one = {k: batch.column(k)[row] for k in batch.schema.names}
                left, right = ((np.asarray(one[f"{s}_nodes"].values), np.asarray(one[f"{s}_counts"].values),
                                units(np.stack(_rows(one[f"{s}_vecs"].values)))) for s in ("left", "right"))
                hit = linked(left[2], right[2], threshold)
                if one["left_tile"].as_py() == one["right_tile"].as_py():
                    np.fill_diagonal(hit, False)
                    nodes.append(left[0])
                    links.append(hit @ right[1])
                else:
                    nodes += [left[0], right[0]]
                    links += [hit @ right[1], left[1] @ hit]
            yield record(LINKS, node=np.concatenate(nodes) if nodes else [], links=np.concatenate(links) if links else [])

    return run


def sorted_links(keyed: DataFrame, threshold: float, window: int) -> DataFrame:
    """Spanning edges (a, b) of the links of all rows at most ``window`` apart in the order of their keys."""
    order = ["pass", "label", "dim", "key", "node"]
    found = written(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInArrow(_windows(threshold, window), f"a long, b long, edge int, {SHAPE}"))
    borders = (found.where("edge is not null").groupBy("edge", "pass", "label", "dim")
               .agg(F.sort_array(F.collect_list(F.struct("key", "node", "vec"))).alias("rows")))
    return found.where("edge is null").select("a", "b").unionByName(
        borders.select("rows").mapInArrow(_across(threshold, window), "a long, b long"))


def embedding_components(vectors: DataFrame, threshold: float = 0.98, passes: int = 20, bits: int = 48,
                         window: int = 64, tile: int = 1024, part: int = 16, seed: int = 11, id_col: str = "vec_id",
                         vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors link when labels and dimensions are equal and their cosine, in
    double precision, reaches ``threshold``.  A vector without a label, null,
    zero, or with null or non-finite components links with nothing.  Rows of
    one id are one vector (the smallest by label and components); a null id
    links with nothing and is its own null component.  An empty table gives no
    rows; other columns are neither read nor returned.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    single = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("v")).select("vec_id", "v.*")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # cosines don't depend on the scale; scaled components can't overflow or vanish in the products
    top = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    valid = (single.where("vec_id is not null and label is not null and vec is not null").where(finite)
             .where(F.exists("vec", lambda x: x != 0)).withColumn("top", top)
             .withColumn("vec", F.transform("vec", lambda x: x / F.col("top") + F.lit(0.0))).drop("top"))
    valid = written(valid)
    nodes = written(valid.groupBy("label", "vec").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    sized = nodes.withColumn("dim", F.size("vec"))
    keyed = (sized.join(written(means(nodes)), ["label", "dim"]).select("label", "node", "vec", "mean")
             .mapInArrow(_keys(passes, bits, seed), SHAPE))
    labels = connected_components(sorted_links(keyed, threshold, window)).withColumnRenamed("label", "comp")

    members = written(nodes.select("node", "copies", "vec").join(labels, "node"))
    sizes = written(members.groupBy("comp").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"),
                                                F.min("node").alias("component_id")))
    dealt = members.join(sizes, "comp").withColumn("tile", F.pmod(F.xxhash64(F.lit(1), "node"), "tiles"))
    # the tiles of a component meet in parts of ``part`` left tiles, so that a large component is many tasks
    parts = F.ceil(F.col("tiles") / part).cast("int")
    tiles = written(dealt.groupBy("comp", "tile", parts.alias("parts"))
                    .agg(F.collect_list(F.struct("node", "copies", "vec")).alias("t")))
    side = lambda s, dealt_to: tiles.select(
        "comp", dealt_to.alias("part"), F.col("tile").alias(f"{s}_tile"), F.col("t.node").alias(f"{s}_nodes"),
        F.col("t.copies").alias(f"{s}_counts"), F.col("t.vec").alias(f"{s}_vecs"))
    left, right = side("left", F.pmod("tile", "parts")), side("right", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = left.join(right, ["comp", "part"]).where("left_tile <= right_tile").drop("comp", "part")
    links = met.mapInArrow(_tiles(threshold), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    component = members.select("node", "comp").join(sizes, "comp").select("node", "component_id")
    judged = written(nodes.join(links, "node", "left").join(component, "node", "left").select(
        "label", "vec", "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "node").alias("component_id")))
    known = valid.join(judged, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    return rows.select("vec_id").join(known, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"))


def components_sql(embeddings: str = "embeddings", threshold: float = 0.98) -> str:
    """DuckDB SQL of `embedding_components`, over all pairs of a label."""
    return f"""
    WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM {embeddings}),
    ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL
           AND len([x for x in e if x IS NULL OR isnan(x) OR isinf(x)]) = 0
           AND len([x for x in e if x <> 0]) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
              ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_cosine_similarity(a.e, b.e) >= {threshold}),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
    FROM v JOIN component c ON c.a = v.vec_id LEFT JOIN degree d ON d.a = v.vec_id"""
