"""Token counts (operator 1).

Pieces are counted once per distinct pre-token of the corpus; documents hold
only pre-token frequencies, and no token id is kept anywhere:

1. Each block of documents (bounded in bytes) becomes one row: its distinct
   pre-tokens, and per document the frequencies over them as compressed
   integers.
2. The blocks' pre-tokens are shuffled and sorted by pre-token, so that the
   library counts each distinct one once, in a streaming pass.
3. The counts join their block's frequencies and are multiplied with them.

The shuffles carry distinct pre-tokens of blocks, not words of documents.  A
pre-token that every document holds is there once a block.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import written

from .common import record, slices, utf8
from .tokens import byte_level, load

BLOCKS = pa.schema([("block", pa.int64()), ("words", pa.list_(pa.string())), ("doc_id", pa.list_(pa.int64())),
                    ("n_bytes", pa.list_(pa.int64())), ("n_distinct", pa.list_(pa.int64())),
                    ("n_special", pa.list_(pa.int64())), ("at", pa.binary()), ("freq", pa.binary())])
COUNTED = pa.schema([("of_block", pa.int64()), ("pos", pa.int32()), ("n", pa.int32())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

#: Latin text without the characters that Python's and the library's classes tell apart.
_PLAIN = re.compile("[^\x00-\x1b\x20-\x84\x86-\xa9\xab-\xb1\xb4-\xb8\xbb\xbf-ɏ]")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class PreTokens:
    """Splits texts as the tokenizer does before it looks for pieces."""

    def __init__(self, path: str) -> None:
        self.tok = load(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") \
                or spec.get("normalizer") or any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"]
                                                 for x in spec["added_tokens"]):
            raise ValueError("token counts by pre-token need a byte-level tokenizer without a normalizer")
        special = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and how many special strings the text holds (a token each)."""
        parts = self.special.split(text) if self.special else [text]
        out = self.part(parts[0])
        for part in parts[1:]:
            out += self.part(part)
        return out, len(parts) - 1

    def part(self, text: str) -> list[str]:
        if not _PLAIN.search(text):
            return _PIECE.findall(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]


def pack(xs: list[np.ndarray]) -> bytes:
    """Unsigned 32-bit integers as compressed planes of equal bytes."""
    flat = np.concatenate([np.zeros(0, "<u4"), *xs]).astype("<u4")
    return pa.compress(flat.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, "<u4")
    planes = np.frombuffer(pa.decompress(packed, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(n)


def _blocks(path: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, number = PreTokens(path).split, 0
        for batch in _gathered(slices(batches, block_bytes), block_bytes):
            vocabulary: dict[str, int] = {}
            at, freq, n_distinct, n_special, n_bytes = [], [], [], [], []
            for raw in utf8(batch.column("text")):
                pieces, special = split(raw.decode("utf-8", "replace"))
                counts = Counter(pieces)
                places = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in counts], dtype=np.int64)
                order = np.argsort(places)
                at.append(np.diff(places[order], prepend=0))
                freq.append(np.array(list(counts.values()), dtype=np.int64)[order])
                n_distinct.append(len(counts))
                n_special.append(special)
                n_bytes.append(len(raw))
            yield record(BLOCKS, block=[(TaskContext.get().partitionId() << 32) + number], words=[list(vocabulary)],
                         doc_id=[batch.column("doc_id").to_pylist()], n_bytes=[n_bytes], n_distinct=[n_distinct],
                         n_special=[n_special], at=[pack(at)], freq=[pack(freq)])
            number += 1

    return run


def _gathered(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to ``block_bytes``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > block_bytes:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def _count(path: str):
    """Counts of rows that come sorted by word: each distinct word goes to the library once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, last, last_n = load(path), None, 0
        for batch in batches:
            words = batch.column("word").dictionary_encode()
            distinct = words.dictionary.to_pylist()
            known = bool(distinct) and distinct[0] == last
            n = [len(tok.model.tokenize(byte_level(word))) for word in distinct[known:]]
            n = [last_n] * known + n
            if distinct:
                last, last_n = distinct[-1], n[-1]
            yield record(COUNTED, of_block=batch.column("block"), pos=batch.column("pos"),
                         n=np.array(n, dtype=np.int32)[words.indices.to_numpy()])

    return run


def _sum(block: pa.Table, counted: pa.Table) -> pa.Table:
    row = {k: block.column(k)[0].as_py() for k in block.column_names}
    n = np.zeros(counted.num_rows, dtype=np.int64)
    n[counted.column("pos").to_numpy()] = counted.column("n").to_numpy()
    sizes = np.array(row["n_distinct"], dtype=np.int64)
    ends, entries = np.cumsum(sizes), int(sizes.sum())
    steps = np.concatenate([[0], np.cumsum(unpack(row["at"], entries), dtype=np.int64)])
    places = steps[1:] - np.repeat(steps[ends - sizes], sizes)
    total = np.concatenate([[0], np.cumsum(n[places] * unpack(row["freq"], entries))])
    n_tokens = total[ends] - total[ends - sizes] + np.array(row["n_special"], dtype=np.int64)
    return pa.table({"doc_id": row["doc_id"], "n_bytes": row["n_bytes"], "n_tokens": n_tokens}, schema=RESULT)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = 32 << 20) -> DataFrame:
    """UTF-8 bytes and tokens of every whole text: (doc_id, n_bytes, n_tokens).

    ``tokenizer_path`` names a byte-level ``tokenizers`` file; no begin, end or
    added tokens are counted, but special strings inside a text are one token
    each, as the library's default has it.  ``block_bytes`` bounds a block's
    text, and so a task's memory, except for one longer text.

    A null or empty text has 0 bytes and 0 tokens; a row with a null id keeps
    it; repeated rows give one row each; an empty table gives no rows; other
    columns are neither read nor returned.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = ("block long, words array<string>, doc_id array<long>, n_bytes array<long>, n_distinct array<long>, "
              "n_special array<long>, at binary, freq binary")
    blocks = written(rows.mapInArrow(_blocks(tokenizer_path, block_bytes), schema))
    words = blocks.select("block", F.posexplode("words").alias("pos", "word"))
    counted = (words.repartition("word").sortWithinPartitions("word")
               .mapInArrow(_count(tokenizer_path), "of_block long, pos int, n int"))
    return (blocks.drop("words").groupBy("block").cogroup(counted.groupBy("of_block"))
            .applyInArrow(_sum, "doc_id long, n_bytes long, n_tokens long"))
