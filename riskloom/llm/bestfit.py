"""Best-fit packing planned on the histogram of lengths (operator 11).

1. Every document is cut into pieces of at most ``capacity`` ids (`cut_pieces`,
   written once).  While a task writes its pieces, it counts them by length, so
   each piece has its rank within (task, length) and no key is shuffled for it.
2. Totals by (task, length) turn those into ranks within a length.
3. Best-fit decreasing runs on the driver over counts (`plan`): groups of
   equally full sequences take as many pieces of a length as they hold, at
   once.  It sees at most ``capacity`` counts, however many documents there
   are, and fills as many sequences as best-fit over the single pieces would.
4. A piece takes the slot that the plan keeps for its rank within its length
   (`place_pieces`).
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.session import written

from .common import record, slices
from .tokens import encoder

CUT = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("start", pa.int64()),
                 ("length", pa.int64()), ("rank", pa.int64()), ("ids", pa.binary())])
CUT_DDL = "doc_id long, part int, piece int, start long, length long, rank long, ids binary"
RANK_BITS = 44


@dataclass
class Plan:
    """Runs of slots, sorted by (length, first rank): a run's ``per`` slots a sequence begin at ``offset`` there."""

    key: np.ndarray  # length << RANK_BITS | first rank
    per: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def slots(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by their rank within their length."""
        key = (length << RANK_BITS) | rank
        run = np.searchsorted(self.key, key, "right") - 1
        use, slot = np.divmod(key - self.key[run], self.per[run])
        return self.sequence[run] + use, self.offset[run] + slot * length


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over counts: ``histogram`` has the number of pieces of each length (1..capacity).

    Sequences with equal room form groups (first, number).  A length goes to
    the groups of the least room that holds it.  A sequence entered has the
    least room of all that fit until nothing more fits, so each takes
    ``room // length`` pieces before the next one is looked at.  A group splits
    in at most three per length, and a sequence holds at most about
    sqrt(2 * capacity) different lengths, which bounds the plan whatever the
    number of pieces.
    """
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []  # sorted keys of the groups that are not empty
    runs: list[tuple[int, int, int, int]] = []
    sequences = 0

    def put(room: int, first: int, number: int) -> None:
        if room and number:
            if not groups[room]:
                insort(rooms, room)
            groups[room].append((first, number))

    for length in sorted((n for n, c in histogram.items() if c), reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = groups[room].pop()
                if not groups[room]:
                    del rooms[at]
            else:
                room, first, number = capacity, sequences, -(-left // (capacity // length))
                sequences += number
            per = room // length
            full = min(number, left // per)
            last = min(left - full * per, per) if full < number else 0  # pieces of one more sequence
            for uses, held, begin in ((full, per, first), (1 if last else 0, last, first + full)):
                if uses:
                    runs.append(((length << RANK_BITS) | rank, held, begin, capacity - room))
                    rank, left = rank + uses * held, left - uses * held
                    put(room - held * length, begin, uses)
            used = full + (1 if last else 0)
            put(room, first + used, number - used)
    key, per, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*sorted(runs), strict=True)) if runs else (
        np.zeros(0, np.int64) for _ in range(4))
    return Plan(key, per, sequence, offset, sequences)


def _cut(path: str, end_id: int, capacity: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(path), defaultdict(int)
        for batch in slices(batches):
            cols: dict[str, list] = {f.name: [] for f in CUT}
            names, parts = batch.column("doc_id").to_pylist(), batch.column("part").to_pylist()
            for name, part, ids in zip(names, parts, enc.all(batch.column("text")), strict=True):
                ids += end
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    length = min(capacity, total - start)
                    row = (name, part, piece, start, length, seen[length], ids[4 * start:4 * (start + length)])
                    for column, value in zip(cols.values(), row, strict=True):
                        column.append(value)
                    seen[length] += 1
            yield record(CUT, **cols)

    return run


def _slots(where: Plan, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = where.slots(length, rank)
            out = {"sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())}
            yield pa.RecordBatch.from_arrays([out.get(f.name, None) if f.name in out else batch.column(f.name).cast(f.type)
                                              for f in schema], schema=schema)

    return run


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The documents' ids in pieces: (doc_id, part, piece, start, length, rank, ids), a written table.

    ``ids`` are little-endian unsigned 32-bit integers: those of the whole text
    and ``end_id``.  Only documents of more than ``capacity`` ids are cut.
    ``rank`` counts the pieces of one ``length`` in one ``part`` (the task that
    wrote them) from 0.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.spark_partition_id().alias("part"))
    return written(rows.mapInArrow(_cut(tokenizer_path, end_id, capacity), CUT_DDL))


def place_pieces(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (part, length, rank and any other columns) with ``sequence_id`` and ``offset``, without part and rank."""
    totals = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    shifts = totals.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranked = (pieces.join(shifts, ["part", "length"])
              .withColumn("rank", F.col("rank") + F.col("shift")).drop("shift", "part"))
    out = ranked.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    return ranked.mapInArrow(_slots(plan(histogram, capacity), to_arrow_schema(out)), out).drop("rank")


def pack_best_fit(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Pieces of all documents in few sequences: (doc_id, piece, start, length, ids, sequence_id, offset).

    A sequence holds at most ``capacity`` ids, gapless from offset 0; a
    document of at most ``capacity`` ids stays whole.

    A null or empty text is the end id alone; null ids are kept; rows repeated
    exactly are packed as often as they come; very long texts become many
    pieces; an empty table gives no rows; other columns are neither read nor
    returned.  Sequence numbers run from 0 without gaps.
    """
    return place_pieces(cut_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col), capacity).select(
        "doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_ids, ids): the packed pieces joined in order of their offsets."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), parts.alias("parts")).select(
        "sequence_id", "n_ids", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
