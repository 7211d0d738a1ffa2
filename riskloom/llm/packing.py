"""Packing documents into training sequences (operator 7).

Cutting-stock column generation:

1. Every document is cut into full sequences and one rest; the rests' lengths
   are rounded up to classes of ``width`` tokens and counted (at most
   ``capacity / width`` counts reach the driver).
2. The linear program "fewest sequences that hold all rests" is solved over
   patterns (how many rests of each class share a sequence).  Patterns are
   priced by a knapsack dynamic program on the program's duals and added
   until none improves it.
3. Pattern uses are rounded down; what is left over (a few rests per pattern)
   is packed by first-fit decreasing.  Sequences of that last step that stay
   less than ``min_fill`` full are not used: their documents' rests are cut at
   powers of two, which need no padding.
4. Rests are ranked within their class, and ranks are dealt to the pattern
   slots; offsets are running sums within a sequence.

Ranks are taken per bucket of documents and shifted by the buckets' totals, so that no class, however large, meets in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import written

from .common import record, slices
from .tokens import encoder

CUT = pa.schema([("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("full_crc", pa.list_(pa.int64())),
                 ("rest", pa.int32()), ("rest_crc", pa.int64()), ("bit_crc", pa.list_(pa.int64()))])
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("slot", pa.int64())])
DDL = {pa.int64(): "long", pa.int32(): "int", pa.list_(pa.int64()): "array<long>"}


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {DDL[f.type]}" for f in schema)


# --- the linear program (driver; at most capacity / width rows) ------------------------------


def knapsack(value: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """Best value of items of size 1..len(value), any number of each, in ``units``; counts by size."""
    best, pick = np.zeros(units + 1), np.zeros(units + 1, dtype=np.int64)
    top = len(value)
    for u in range(1, units + 1):
        k = min(u, top)
        gain = value[:k] + best[u - k:u][::-1]
        i = int(gain.argmax())
        best[u], pick[u] = (gain[i], i + 1) if gain[i] > best[u - 1] else (best[u - 1], 0)
    counts, u = np.zeros(top, dtype=np.int64), units
    while u > 0:
        if pick[u]:
            counts[pick[u] - 1] += 1
        u -= pick[u] or 1
    return float(best[units]), counts


def refined(inverse: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """One Newton step on an inverse that many updates have worn (einsum: no threads on a busy driver)."""
    return 2 * inverse - np.einsum("ij,jk,kl->il", inverse, basis, inverse, optimize=["einsum_path", (0, 1), (0, 1)])


def patterns(demand: np.ndarray, units: int, gap: float = 3e-4) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as rows of counts by class, uses) of the cutting-stock program.

    Columns are added until the duals prove that no solution is better by more
    than the share ``gap`` of the sequences, or by half a sequence.
    """
    size = np.flatnonzero(demand) + 1
    n = len(size)
    if not n:
        return np.zeros((0, len(demand)), dtype=np.int64), np.zeros(0)
    d = demand[size - 1].astype(float)
    basis = np.diag((units // size).astype(float))  # columns are patterns
    inverse, value = np.diag(1 / np.diag(basis)), np.zeros(int(size.max()))
    for step in range(40 * n + 100):
        dual = inverse.sum(axis=0)  # every pattern costs one sequence
        value[:] = 0
        value[size - 1] = np.maximum(dual, 0)
        worth, counts = knapsack(value, units)
        x = (inverse * d).sum(axis=1)
        bound = value[size - 1] @ d / max(worth, 1)
        if worth <= 1 + 1e-7 or x.sum() - bound <= max(0.5, gap * bound):
            break
        column = counts[size - 1].astype(float)
        y = (inverse * column).sum(axis=1)
        ratio = np.where(y > 1e-9, np.maximum(x, 0) / np.where(y > 1e-9, y, 1), np.inf)
        leave = int(ratio.argmin())
        basis[:, leave] = column
        row = inverse[leave] / y[leave]
        inverse = inverse - y[:, None] * row
        inverse[leave] = row
        if step % 200 == 199:
            inverse = refined(inverse, basis)
    x = np.maximum((refined(inverse, basis) * d).sum(axis=1), 0)
    out = np.zeros((n, len(demand)), dtype=np.int64)
    out[:, size - 1] = basis.T.round().astype(np.int64)
    return out, x


@dataclass
class Plan:
    """Where the ranks of each class go; ``alone[c]``: first rank of class c that is cut at powers of two."""

    first: dict[int, np.ndarray]  # class -> first rank of each run of slots
    per: dict[int, np.ndarray]  # slots of the class in one sequence of the run
    sequence: dict[int, np.ndarray]  # the run's first sequence
    alone: dict[int, int]
    sequences: int


def plan(histogram: dict[int, int], units: int, min_fill: float) -> Plan:
    """``histogram``: rests by class (1..units)."""
    demand = np.zeros(units, dtype=np.int64)
    for c, n in histogram.items():
        demand[c - 1] = n
    rows, uses = patterns(demand, units)
    runs = [(row, int(np.floor(x + 1e-6))) for row, x in zip(rows, uses, strict=True)]
    left = demand - sum((row * k for row, k in runs), np.zeros(units, dtype=np.int64))
    while (left < 0).any():  # the solution's last digits: take a use back
        j = next(j for j, (row, k) in enumerate(runs) if k and (row * (left < 0)).any())
        runs[j] = (runs[j][0], runs[j][1] - 1)
        left += runs[j][0]
    bins: list[np.ndarray] = []
    room: list[int] = []
    for c in range(units, 0, -1):
        for _ in range(int(left[c - 1])):
            at = next((i for i, r in enumerate(room) if r >= c), None)
            if at is None:
                at = len(bins)
                bins.append(np.zeros(units, dtype=np.int64))
                room.append(units)
            bins[at][c - 1] += 1
            room[at] -= c
    runs += [(b, 1) for b, r in zip(bins, room, strict=True) if r <= (1 - min_fill) * units]
    out, base, taken = Plan({}, {}, {}, {}, 0), 0, np.zeros(units, dtype=np.int64)
    lists: dict[int, list[tuple[int, int, int]]] = {}
    for row, k in runs:
        if k:
            for c in np.flatnonzero(row):
                lists.setdefault(int(c) + 1, []).append((int(taken[c]), int(row[c]), base))
                taken[c] += row[c] * k
            base += k
    for c, n in histogram.items():
        runs_of = lists.get(c, [])
        out.first[c], out.per[c], out.sequence[c] = (np.array([r[i] for r in runs_of], dtype=np.int64) for i in range(3))
        out.alone[c] = int(taken[c - 1])
    out.sequences = base
    return out


# --- tasks ----------------------------------------------------------------------------------


def _cut(path: str, end_id: int, capacity: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, crc = encoder(path), zlib.crc32
        for batch in slices(batches):
            cols: dict[str, list] = {f.name: [] for f in CUT}
            for ids in enc.all(batch.column("text")):
                ids += end
                n = len(ids) // 4
                full, at = n // capacity, n // capacity * capacity
                cols["doc_tokens"].append(n)
                cols["full_crc"].append([crc(ids[4 * k * capacity:4 * (k + 1) * capacity]) for k in range(full)])
                cols["rest"].append(n - at)
                cols["rest_crc"].append(crc(ids[4 * at:]))
                bits = []
                for size in powers(n - at):
                    bits.append(crc(ids[4 * at:4 * (at + size)]))
                    at += size
                cols["bit_crc"].append(bits)
            yield record(CUT, **{**cols, "doc_id": batch.column("doc_id").to_pylist()})

    return run


def powers(n: int) -> list[int]:
    """The powers of two that make up ``n``, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def _deal(where: Plan, buckets: int, capacity: int):
    """Full sequences get odd numbers, counted within a bucket; all others even ones."""
    wide = capacity.bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in PIECES}

            def piece(row, start, length, crc, sequence, slot):
                for k, v in (("doc_id", row["doc_id"]), ("start", start), ("length", length), ("ids_crc32", crc),
                             ("doc_tokens", row["doc_tokens"]), ("sequence_id", sequence), ("slot", slot)):
                    out[k].append(v)

            for row in batch.to_pylist():
                for k, crc in enumerate(row["full_crc"]):
                    piece(row, k * capacity, capacity, crc, 2 * ((row["first_full"] + k) * buckets + row["bucket"]) + 1, 0)
                c, rank, start = row["class"], row["rank"], len(row["full_crc"]) * capacity
                if c and rank < where.alone[c]:
                    j = int(np.searchsorted(where.first[c], rank, "right")) - 1
                    use, slot = divmod(rank - int(where.first[c][j]), int(where.per[c][j]))
                    piece(row, start, row["rest"], row["rest_crc"], 2 * (int(where.sequence[c][j]) + use),
                          c * (capacity + 1) + slot)
                elif c:
                    own = where.sequences + ((rank - where.alone[c]) * (capacity + 1) + c) * wide
                    for k, (size, crc) in enumerate(zip(powers(row["rest"]), row["bit_crc"], strict=True)):
                        piece(row, start, size, crc, 2 * (own + k), 0)
                        start += size
            yield record(PIECES, **out)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048, width: int = 8,
                   min_fill: float = 0.98, rows_per_bucket: int = 50_000, seed: int = 7, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document's ids are those of its whole text and ``end_id``; every id lies
    in one piece, and a sequence holds at most ``capacity`` ids, gapless from
    offset 0.  ``capacity`` is a power of two and a multiple of ``width``.

    A null or empty text is the end id alone; null ids are kept; rows repeated
    exactly are packed as often as they come; an empty table gives no rows;
    other columns are neither read nor returned.  Sequence ids are unique, but
    not gapless.
    """
    units = capacity // width
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cut = written(rows.mapInArrow(_cut(tokenizer_path, end_id, capacity), ddl(CUT)))
    cut = cut.withColumn("class", F.ceil(F.col("rest") / width).cast("int")).withColumn("n_full", F.size("full_crc"))
    histogram = {r["class"]: r["n"] for r in cut.groupBy("class").agg(F.count("*").alias("n")).collect()}
    n_docs = sum(histogram.values())
    histogram.pop(0, None)
    buckets = max(1, -(-n_docs // rows_per_bucket))
    key = F.xxhash64(F.lit(seed), "doc_id", "rest_crc", "doc_tokens")
    placed = cut.withColumn("key", key).withColumn("bucket", F.pmod("key", F.lit(buckets)))

    # (bucket, class) totals are at most buckets x units rows; a window below holds a bucket's documents or a class's totals
    totals = placed.groupBy("bucket", "class").agg(F.count("*").alias("n"))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = totals.select("bucket", "class", before("n", Window.partitionBy("class").orderBy("bucket")).alias("shift"))
    where = plan(histogram, units, min_fill)

    order: list[Column] = [F.col(c) for c in ("key", "doc_id", "rest_crc")]
    in_bucket, in_class = Window.partitionBy("bucket").orderBy("class", *order), Window.partitionBy("bucket", "class").orderBy(*order)
    ranked = (placed
              .withColumn("first_full", before("n_full", in_bucket))
              .withColumn("rank", F.row_number().over(in_class) - 1)
              .join(shifts, ["bucket", "class"])
              .withColumn("rank", F.col("rank") + F.col("shift")))
    pieces = (ranked.select("doc_id", "doc_tokens", "full_crc", "rest", "rest_crc", "bit_crc", "class", "rank", "bucket", "first_full")
              .mapInArrow(_deal(where, buckets, capacity), ddl(PIECES)))
    within = Window.partitionBy("sequence_id").orderBy(F.desc("slot"))
    return pieces.withColumn("offset", before("length", within)).drop("slot")
