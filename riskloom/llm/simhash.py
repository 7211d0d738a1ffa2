"""SimHash near-duplicates (operator 9).

Fingerprints are 64 bits, a majority vote of the shingles' hashes.  Documents
of one fingerprint are one node.  Nodes are compared exactly, tile by tile,
with numpy's exclusive-or and bit counts; tile pairs are skipped by
population counts: a tile holds the fingerprints of equal counts in each of
the four 16-bit quarters, and every differing bit moves one quarter's count by
one, so only tiles whose counts differ by at most the radius in all can hold a
link.  Those neighbours are found by an equality join on the shifted counts
(at most 129 shifts at radius 3, and half of them by symmetry).

The comparison stays quadratic in the distinct fingerprints: the skipping
leaves some 4 % of all pairs at radius 3, whatever the size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import written

from .common import record, slices, utf8
from .graph import connected_components

PRINTS = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of a UTF-8 text; 0 without a word."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in parts), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a very long text stays within bounded memory
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _prints(shingle: int, seed: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = np.array([fingerprint(raw, shingle, seed) for raw in utf8(batch.column("text"))], dtype="<u8")
            others = {c: batch.column(c).to_pylist() for c in schema.names if c != "print"}
            yield record(schema, print=prints.view("<i8"), **others)

    return run


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index of each index's component; the pairs come in blocks."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            if (differ := low < high).any():
                np.minimum.at(label, high[differ], low[differ])
                while (label[label] != label).any():
                    label = label[label]
            else:
                break
    return label


def tile_edges(left: np.ndarray, right: np.ndarray, radius: int, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links within ``radius`` connect: no more than there are fingerprints."""
    values = np.concatenate([left, right])

    def pairs():
        for at in range(0, len(left), rows):
            i, j = np.nonzero(np.bitwise_count(left[at:at + rows, None] ^ right[None, :]) <= radius)
            if len(i):
                yield i + at, j + len(left)

    label = forest(len(values), pairs())
    which = np.flatnonzero(label != np.arange(len(values)))
    return values[label[which]], values[which]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            left, right = (batch.column(c) for c in ("left", "right"))
            for k in range(batch.num_rows):
                x, y = (np.asarray(c[k].values).view("<u8") for c in (left, right))
                lows, highs = tile_edges(x, y, radius)
                keep = lows != highs
                a.append(lows[keep])
                b.append(highs[keep])
            join = lambda xs: np.concatenate(xs).view("<i8") if xs else np.zeros(0, "<i8")
            yield record(EDGES, a=join(a), b=join(b))

    return run


def shifts(radius: int) -> list[list[int]]:
    """Half of the count differences of the four quarters that a link allows, the other half being their negatives."""
    every = itertools.product(range(-radius, radius + 1), repeat=4)
    return [list(x) for x in every if sum(map(abs, x)) <= radius and list(x) >= [0, 0, 0, 0]]


def simhash_links(prints: DataFrame, radius: int = 3, tile: int = 2048) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints (column ``print``) within ``radius`` bits of each other.

    ``tile`` bounds the fingerprints compared at once.  A cell of equal counts
    that holds more of them is dealt to several tiles, each of which meets all
    others; cells are at most 17^4, so their counts may be broadcast.
    """
    quarter = lambda k: F.bit_count(F.shiftrightunsigned("print", 16 * k).bitwiseAND(F.lit(0xFFFF).cast("long")))
    cell = F.array(*(quarter(k).cast("int") for k in range(4)))
    nodes = prints.select("print").distinct().withColumn("cell", cell)
    n_tiles = nodes.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    dealt = (nodes.join(F.broadcast(n_tiles), "cell")
             .withColumn("tile", F.pmod(F.xxhash64(F.lit(1), "print"), F.col("tiles")).cast("int")))
    tiles = written(dealt.groupBy("cell", "tile").agg(F.sort_array(F.collect_list("print")).alias("prints")))
    moves = F.array(*(F.array(*map(F.lit, x)) for x in shifts(radius)))
    left = (tiles.select("cell", F.col("tile").alias("left_tile"), F.col("prints").alias("left"), F.explode(moves).alias("move"))
            .withColumn("same", F.forall("move", lambda x: x == 0))
            .withColumn("cell", F.zip_with("cell", "move", lambda x, y: x + y)))
    right = tiles.select("cell", F.col("tile").alias("right_tile"), F.col("prints").alias("right"))
    met = left.join(right, "cell").where("not same or left_tile <= right_tile").select("left", "right")
    return met.mapInArrow(_compare(radius), "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42, tile: int = 2048,
                       id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id[, key, label]) of every whole text.

    The fingerprint is 16 lowercase hex digits; the component's id is the
    smallest doc_id that links reach.  A null, empty or blank text has
    fingerprint zero and links like any other; a text shorter than a shingle
    is one shingle.  Null ids share their fingerprint's component; repeated
    rows give a row each; an empty table gives no rows; other columns are
    neither read nor returned, but for ``key_col``, a string that names rows.
    With it ``label`` tells components apart whose ids are all null.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       *([F.col(key_col).alias("key")] if key_col else []))
    schema = PRINTS.append(pa.field("key", pa.string())) if key_col else PRINTS
    prints = written(rows.mapInArrow(_prints(shingle, seed, schema), "doc_id long, print long" + (", key string" if key_col else "")))
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("first"))
    labels = connected_components(simhash_links(prints, radius, tile))
    labelled = written(nodes.join(labels.withColumnRenamed("node", "print"), "print", "left")
                       .withColumn("label", F.coalesce("label", "print")))
    first = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    known = written(labelled.join(first, "label").select("print", "component_id", "label"))
    return (prints.join(known, "print")
            .select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id",
                    *(["key", "label"] if key_col else [])))
