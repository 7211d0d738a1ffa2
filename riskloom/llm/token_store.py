"""Token-id output in patched frame-of-reference blocks (operator 10).

File format, one payload per shard (all integers little-endian)::

    header  "PFR1", block size u4, ids u8, documents u4, blocks u4
    index   start of each block in the body, u8 each
    docs    ids of each document, u4 each
    body    blocks one after the other

    block   n u2, width u1, exceptions u2, minimum u4,
            n values less the minimum, `width` low bits each,
            exception positions u2, exception high parts u4

The minimum is subtracted, the width is the bit length that ``percentile`` of
the block's values fit in, and what is beyond it is patched from the
exception list.  Any id in 0..2^32-1 comes back exactly.  Shards are rows of a
Parquet table, so that the format works on every store Spark can write.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import shared_dir

from .common import record, slices
from .tokens import encoder

MAGIC = b"PFR1"
HEAD = struct.Struct("<4sIQII")
BLOCK_HEAD = np.dtype([("n", "<u2"), ("width", "u1"), ("exceptions", "<u2"), ("low", "<u4")])
SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_id", pa.list_(pa.int64())), ("payload", pa.binary())])
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids_crc32", pa.int64())])


def bit_length(x: np.ndarray) -> np.ndarray:
    """Bits of unsigned 32-bit values (0 for 0)."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values, each value in its ``width`` low bits, as rows of bytes."""
    wide = np.unpackbits(np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(*values.shape, 4),
                         axis=-1, bitorder="little", count=width) if width else np.zeros((*values.shape, 0), np.uint8)
    return np.packbits(wide.reshape(len(values), -1), axis=1, bitorder="little")


def unpack(packed: np.ndarray, n: int, width: int) -> np.ndarray:
    """Rows of bytes back to rows of ``n`` values."""
    bits = np.unpackbits(packed, axis=1, bitorder="little", count=n * width).reshape(len(packed), n, width)
    wide = np.zeros((len(packed), n, 16 if width <= 16 else 32), np.uint8)
    wide[:, :, :width] = bits
    whole = np.packbits(wide, axis=2, bitorder="little")
    return whole.view("<u2" if width <= 16 else "<u4").reshape(len(packed), n).astype("<u4")


def _encode_blocks(rows: np.ndarray, percentile: float) -> list[bytes]:
    """Blocks (rows of equal length) as bytes each; blocks of a width are packed together."""
    n = rows.shape[1]
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    bits = bit_length(rest)
    at = min(n - 1, max(0, int(np.ceil(n * percentile / 100)) - 1))
    widths = np.partition(bits, at, axis=1)[:, at]
    out: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths):
        which = np.flatnonzero(widths == width)
        part, over = rest[which], bits[which] > width
        packed = pack(part & np.uint32((1 << int(width)) - 1), int(width))
        for k, i in enumerate(which):
            pos = np.flatnonzero(over[k])
            head = np.array([(n, width, len(pos), low[i])], dtype=BLOCK_HEAD)
            out[i] = b"".join([head.tobytes(), packed[k].tobytes(), pos.astype("<u2").tobytes(),
                               (part[k, pos] >> np.uint32(width)).astype("<u4").tobytes()])
    return out


def write_shard(docs: list[bytes], block: int = 1024, percentile: float = 98.0) -> bytes:
    """One payload from documents' ids (bytes of unsigned 32-bit integers)."""
    ids = np.frombuffer(b"".join(docs), dtype="<u4")
    full = len(ids) // block * block
    blocks = _encode_blocks(ids[:full].reshape(-1, block), percentile) if full else []
    if full < len(ids):
        blocks += _encode_blocks(ids[full:].reshape(1, -1), percentile)
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])[:len(blocks)]
    return b"".join([HEAD.pack(MAGIC, block, len(ids), len(docs), len(blocks)), starts.astype("<u8").tobytes(),
                     np.array([len(d) // 4 for d in docs], dtype="<u4").tobytes(), *blocks])


def read_shard(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the shard, ids of each document) from one payload."""
    magic, block, n_ids, n_docs, n_blocks = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token shard")
    at = HEAD.size
    starts = np.frombuffer(payload, "<u8", n_blocks, at).astype(np.int64)
    sizes = np.frombuffer(payload, "<u4", n_docs, at + 8 * n_blocks)
    body = at + 8 * n_blocks + 4 * n_docs
    raw = np.frombuffer(payload, np.uint8)
    out = np.empty(n_ids, dtype="<u4")
    if n_blocks:
        heads = raw[(body + starts)[:, None] + np.arange(BLOCK_HEAD.itemsize)].view(BLOCK_HEAD).reshape(-1)
        for n, width in set(zip(heads["n"].tolist(), heads["width"].tolist(), strict=True)):
            which = np.flatnonzero((heads["n"] == n) & (heads["width"] == width))
            size = -(-n * width // 8)
            data = (body + starts[which] + BLOCK_HEAD.itemsize)[:, None] + np.arange(size)
            values = unpack(raw[data], n, width) if width else np.zeros((len(which), n), "<u4")
            for k, i in enumerate(which):
                if e := int(heads["exceptions"][i]):
                    first = int(body + starts[i] + BLOCK_HEAD.itemsize + size)
                    pos = np.frombuffer(payload, "<u2", e, first)
                    values[k, pos] |= np.frombuffer(payload, "<u4", e, first + 2 * e) << np.uint32(width)
            values += heads["low"][which][:, None]
            out[(which * block)[:, None] + np.arange(n)] = values
    return out, sizes


def _write(path: str, end_id: int, shard_ids: int, block: int, percentile: float):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, number, start = encoder(path), TaskContext.get().partitionId(), 0, 0
        names: list = []
        docs: list[bytes] = []
        size = 0

        def shard() -> pa.RecordBatch:
            return record(SHARDS, part=[part], shard=[number], start=[start], n_ids=[size // 4], doc_id=[names],
                          payload=[write_shard(docs, block, percentile)])

        for batch in slices(batches):
            for name, ids in zip(batch.column("doc_id").to_pylist(), enc.all(batch.column("text")), strict=True):
                names.append(name)
                docs.append(ids + end)
                size += len(docs[-1])
                if size >= 4 * shard_ids:
                    yield shard()
                    number, start, names, docs, size = number + 1, start + size // 4, [], [], 0
        if names:
            yield shard()

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, sizes = read_shard(row["payload"])
            ends = np.cumsum(sizes, dtype=np.int64)
            crc = [zlib.crc32(ids[e - s:e].tobytes()) for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
            yield record(DOCS, doc_id=row["doc_id"], start=row["start"] + ends - sizes, n_tokens=sizes, ids_crc32=crc)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_ids: int = 1 << 20, block: int = 1024,
                 percentile: float = 98.0) -> str:
    """Write ids of all texts, each followed by ``end_id``, to ``path`` in ascending id order.

    Documents are range-partitioned and sorted by id, so any number of them
    goes through bounded tasks; a shard holds about ``shard_ids`` ids.  Null
    ids come first; equal ids are ordered by text, repeated rows are written
    once each; a null text is empty and gives the end id alone; an empty table
    gives no shard.  ``block`` is at most 65,535.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (rows.mapInArrow(_write(tokenizer_path, end_id, shard_ids, block, percentile),
                     "part int, shard int, start long, n_ids long, doc_id array<long>, payload binary")
     .write.option("compression", "none").parquet(path))
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written store: (doc_id, start, n_tokens, ids_crc32).

    Starts count from the store's first id: each shard has its start within
    its range of ids, and the ranges' totals are summed up.  Those totals are
    a row per range, so they are broadcast.
    """
    shards = spark.read.parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = F.broadcast(totals.select("part", before.alias("base")))
    return (shards.join(bases, "part")
            .select("doc_id", (F.col("start") + F.col("base")).alias("start"), "payload")
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def store_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}"
