"""Sharding by a permutation-filled lookup table (operator 5).

Each shard has its own permutation of the slots of a prime-sized table and the
shards take turns: each claims the first slot of its permutation that is
still free, until all are claimed.  Slots per shard differ by at most one, and
when a shard comes or goes few slots change hands.  Placing a document is one
hash and one look into the broadcast table, whose size is the table's alone.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], slots: int) -> list[int]:
    """The shard (its index in ``shards``) of each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct, and at least one")
    if not is_prime(slots) or slots < len(shards):
        raise ValueError("the table's size must be a prime, not below the number of shards")
    offset = [xxhash.xxh64_intdigest(name, 1) % slots for name in shards]
    skip = [xxhash.xxh64_intdigest(name, 2) % (slots - 1) + 1 if slots > 2 else 1 for name in shards]
    order = sorted(range(len(shards)), key=lambda i: shards[i])  # turns depend on names, not on the list's order
    table, step, filled = [-1] * slots, [0] * len(shards), 0
    while True:
        for i in order:
            while table[at := (offset[i] + step[i] * skip[i]) % slots] >= 0:
                step[i] += 1
            table[at] = i
            step[i] += 1
            filled += 1
            if filled == slots:
                return table


def assign_shards(docs: DataFrame, shards: list[str], slots: int = 65_537, id_col: str = "doc_id") -> DataFrame:
    """All rows and columns with two more, ``slot`` and ``shard`` (columns of these names are replaced).

    The slot is the id's xxHash64 modulo ``slots``.  Rows of one id meet in
    one shard; null ids share the slot of the hash's seed.  The table has
    ``slots`` rows, which bounds the broadcast.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    table = spark.createDataFrame([(k, shards[i]) for k, i in enumerate(lookup_table(shards, slots))], "slot int, shard string")
    slot = F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string")), F.lit(slots)).cast("int")
    # the row is one value, so that no column of it can bear a name used here
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), slot.alias("slot"))
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("slot", "shard")]
    return packed.join(F.broadcast(table), "slot").select(*kept, "slot", "shard")


def write_shards(docs: DataFrame, path: str, shards: list[str], slots: int = 65_537, id_col: str = "doc_id",
                 rows_per_file: int = 100_000) -> None:
    """One Parquet folder per shard, written by as many tasks as give them ``rows_per_file`` rows on average.

    Rows are dealt to a shard's tasks by id and content, so neither null ids
    nor many versions of one id meet in one task; only equal rows do.
    """
    files = max(1, -(-docs.count() // (len(shards) * rows_per_file)))
    placed = assign_shards(docs, shards, slots, id_col)
    content = [c for c, kind in placed.dtypes if "map<" not in kind and "variant" not in kind]  # these have no hash
    part = F.pmod(F.xxhash64(F.lit(3), *(F.col(f"`{c}`") for c in content)), F.lit(files))
    (placed.repartition(len(shards) * files, "shard", part)
     .write.partitionBy("shard").parquet(path))
