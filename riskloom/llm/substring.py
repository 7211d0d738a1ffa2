"""Substring dedup with repeated-phrase automata (operator 6).

A window is ``window`` consecutive words.  A word goes when a window that
covers it also starts in a document with a smaller id.

1. Winnowing: of all ``phrase``-word phrases of a window, the one of the
   smallest hash is chosen.  Equal windows choose equal phrases, so a window
   that recurs holds a chosen phrase that recurs.  Phrases chosen in two or
   more documents are the recurring phrases.
2. Each recurring phrase belongs to its first holder, the smallest id, which
   gives its text.  The phrases of one holder share a shard (a shard: about
   ``shard_phrases`` phrases; the phrases of longer holders are dealt to
   several), as copies of a document meet few shards that way.
3. A document is streamed past every shard that one of its chosen phrases
   leads to.  The shard's Aho-Corasick automaton over words, compiled from the
   phrase texts, locates every occurrence of every phrase of the shard; nothing
   else tells where phrases are.  The documents of a shard are dealt to parts
   of about ``shard_docs``, each with the shard's phrases, so that a passage in
   any number of documents is spread over tasks.
4. Confirmation: each occurrence has a context, all windows that hold it, with
   a 128-bit hash.  A document that is not the first of its context loses the
   whole context.  The first document of a context loses the windows that
   occur in an earlier document with another context of the same phrase;
   those are compared window by window, only for phrases of several contexts.

Every group is pre-aggregated (smallest id); joins back to documents read
written tables on both sides, which lets adaptive execution split hot keys.
Nothing is collected but one document's own phrases, shards and ranges.
Phrases are named by 64-bit hashes, contexts and windows by 128 bits.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import discard, written

from .common import record, slices, utf8

GRAMS = pa.schema([("doc_id", pa.int64()), ("grams", pa.list_(pa.int64()))])
WINDOWS = pa.schema([("doc_id", pa.int64()), ("tk", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()),
                     ("start", pa.int32())])
STREAM = pa.schema([("shard", pa.int64()), ("doc_id", pa.int64()), ("tk", pa.int64()), ("gram", pa.int64()),
                    ("text", pa.binary())])
FOUND = pa.schema([(c, pa.int64()) for c in ("doc_id", "tk", "gram", "c1", "c2", "at", "start", "end")])
FIRST, SECOND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd multipliers of the rolling hashes


@functools.lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..n and its inverse's powers, modulo 2^64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n + 1, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that equal low bits of sums don't order alike."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)


def rolling(hashes: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums from which `span` takes the hash of any run of words."""
    up, _ = _powers(base, 1 << int(len(hashes)).bit_length())
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:len(hashes)], dtype=np.uint64)])


def span(prefix: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _powers(base, 1 << int(len(prefix) - 1).bit_length())
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every run of ``width`` values."""
    done = 1
    while 2 * done <= width:
        x, done = op(x[:-done], x[done:]), 2 * done
    rest = width - done
    return op(x[:len(x) - rest], x[rest:]) if rest else x


def chosen(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions of values that are the smallest of some run of ``width`` values."""
    low = sliding(grams, width, np.minimum)
    pad = np.zeros(width - 1, dtype=np.uint64)
    return np.flatnonzero(sliding(np.concatenate([pad, low, pad]), width, np.maximum) == grams)


def phrases(words: list[bytes], phrase: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, positions of chosen phrases, their hashes) of a text of at least ``window`` words."""
    hashes = word_hashes(words)
    starts = np.arange(len(words) - phrase + 1)
    grams = span(rolling(hashes, FIRST), FIRST, starts, starts + phrase)
    at = chosen(grams, window - phrase + 1)
    return hashes, at, grams[at].view(np.int64)


def _choose(phrase: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, grams = [], []
            for name, raw in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text")), strict=True):
                words = raw.split()
                if len(words) >= window:
                    names.append(name)
                    grams.append(np.unique(phrases(words, phrase, window)[2]))
            yield record(GRAMS, doc_id=names, grams=grams)

    return run


def sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _occurrences(words: list[bytes], hashes: np.ndarray, matches: list[tuple[int, int]], phrase: int,
                 window: int) -> dict[str, np.ndarray]:
    """Contexts of the matches (position, phrase hash): what all windows around a match hold."""
    at = np.array([m[0] for m in matches], dtype=np.int64)
    side = window - phrase
    start, end = np.maximum(at - side, 0), np.minimum(at + window, len(words))
    shape = (at - start) * (side + 1) + (end - at)  # where the text's ends cut the context
    first, second = (span(rolling(hashes, b), b, start, end) for b in (FIRST, SECOND))
    return {"gram": np.array([m[1] for m in matches], dtype=np.int64), "start": start, "end": end, "at": at,
            "c1": mix(first + shape.astype(np.uint64)).view(np.int64), "c2": second.view(np.int64)}


def _spread(phrase: int, window: int):
    """A document's rows: the texts of the phrases that it holds first, and itself once a shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {f.name: [] for f in STREAM}

            def put(*row):
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)

            for name, tk, raw, shards, own in zip(
                    *(batch.column(c).to_pylist() for c in ("doc_id", "tk")), utf8(batch.column("text")),
                    *(batch.column(c).to_pylist() for c in ("shards", "own")), strict=True):
                words = raw.split()
                if len(words) < window:
                    continue
                if own:
                    _, at, values = phrases(words, phrase, window)
                    where = dict(zip(values.tolist(), at.tolist(), strict=True))
                    for o in own:
                        if (p := where.get(o["gram"])) is not None:
                            put(o["shard"], None, None, o["gram"], b" ".join(words[p:p + phrase]))
                for shard in shards:
                    put(shard, name, tk, None, raw)
            yield record(STREAM, **out)

    return run


def compiled(texts: list[tuple[int, bytes]]):
    """(vocabulary, automaton) of (hash, phrase) pairs; the automaton reads the vocabulary's numbers."""
    import ahocorasick

    vocabulary: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for gram, text in texts:
        automaton.add_word(tuple(vocabulary.setdefault(w, len(vocabulary) + 1) for w in text.split()), gram)
    automaton.make_automaton()
    return vocabulary, automaton


def _locate(phrase: int, window: int):
    """Occurrences in the documents of each (shard, part), whose phrases come first in the sorted stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, texts, machine = None, [], None
        for batch in slices(batches):
            out: dict[str, list] = {f.name: [] for f in FOUND}
            keys = zip(batch.column("shard").to_pylist(), batch.column("part").to_pylist(), strict=True)
            for key, name, tk, gram, raw in zip(keys, *(batch.column(c).to_pylist() for c in ("doc_id", "tk", "gram")),
                                                utf8(batch.column("text")), strict=True):
                if key != current:
                    current, texts, machine = key, [], None
                if name is None:
                    texts.append((gram, raw))
                    continue
                if not texts:
                    continue
                machine = machine or compiled(texts)
                words = raw.split()
                numbers = tuple(machine[0].get(w, 0) for w in words)
                matches = [(end - phrase + 1, value) for end, value in machine[1].iter(numbers)]
                if matches:
                    found = _occurrences(words, word_hashes(words), matches, phrase, window)
                    found |= {"doc_id": np.full(len(matches), name), "tk": np.full(len(matches), tk)}
                    for c, values in found.items():
                        out[c].append(values)
            yield record(FOUND, **{c: np.concatenate(v) if v else [] for c, v in out.items()})

    return run


def _windows(phrase: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {f.name: [] for f in WINDOWS}
            for name, tk, raw, at in zip(batch.column("doc_id").to_pylist(), batch.column("tk").to_pylist(),
                                         utf8(batch.column("text")), batch.column("ats"), strict=True):
                words = raw.split()
                hashes = word_hashes(words)
                near = np.asarray(at.values, dtype=np.int64)[:, None] - np.arange(window - phrase + 1)
                start = np.unique(near[(near >= 0) & (near + window <= len(words))])
                out["doc_id"].append(np.full(len(start), name))
                out["tk"].append(np.full(len(start), tk))
                out["start"].append(start)
                for c, base in (("w1", FIRST), ("w2", SECOND)):
                    out[c].append(span(rolling(hashes, base), base, start, start + window).view(np.int64))
            yield record(WINDOWS, **{k: np.concatenate(v) if v else [] for k, v in out.items()})

    return run


def kept_text(raw: bytes, words: list[bytes], keep: np.ndarray) -> bytes:
    """The runs of kept words as the text has them, one blank between runs."""
    at, runs, start, pos = 0, [], None, 0
    for word, k in zip(words, keep.tolist(), strict=True):
        at = raw.index(word, pos)
        if k and start is None:
            start = at
        elif not k and start is not None:
            runs.append(raw[start:pos])
            start = None
        pos = at + len(word)
    if start is not None:
        runs.append(raw[start:pos])
    return b" ".join(runs)


def _remove(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n_words, removed, digests, texts = [], [], [], []
            for raw, ranges in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("ranges").to_pylist(),
                                   strict=True):
                words = (raw or b"").split()
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                for r in ranges or ():
                    edge[r["start"]] += 1
                    edge[r["end"]] -= 1
                keep = np.cumsum(edge[:-1]) == 0
                n_words.append(len(words))
                removed.append(int((~keep).sum()))
                digests.append(sha([w for w, k in zip(words, keep.tolist(), strict=True) if k] if ranges else words))
                texts.append(kept_text(raw, words, keep) if ranges and "text" in schema.names else raw)
            out = {c: batch.column(c) for c in ("doc_id", "carry")}
            out |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string()), "text": pa.array(texts, pa.binary()).cast(pa.string())}
            yield pa.RecordBatch.from_arrays([out[f.name].cast(f.type) for f in schema], schema=schema)

    return run


def remove_repeats(docs: DataFrame, window: int = 50, phrase: int = 20, shard_phrases: int = 8_192,
                   shard_docs: int = 1_024, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, text][, carry]) of every document.

    ``kept_sha256`` is of the kept words joined by one blank; ``text`` has the
    kept runs as they stood, and is unchanged where nothing is removed; ``carry`` names columns returned unchanged in the
    struct ``carry``, whatever their names.

    A null text has no words.  Texts of fewer than ``window`` words lose
    nothing and take nothing from others.  A row with a null id is returned
    whole and takes nothing from others.  Rows of one id count as one document
    (none is earlier than the other); each is returned.  An empty table gives
    no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.lit(True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), rest.alias("carry"))
    known = rows.select("doc_id", "text").where("doc_id is not null")
    named = known.withColumn("tk", F.xxhash64("text"))
    grams = written(known.mapInArrow(_choose(phrase, window), "doc_id long, grams array<long>")
                    .select("doc_id", F.explode("grams").alias("gram")))
    recurring = written(grams.groupBy("gram").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                        .where("first < last").select("gram", "first"))

    shards = max(1, -(-recurring.count() // shard_phrases))
    held = recurring.groupBy("first").agg(F.ceil(F.count("*") / shard_phrases).alias("pieces"))
    shard = F.pmod(F.xxhash64("first", F.pmod(F.xxhash64("gram"), "pieces")), F.lit(shards))
    home = recurring.join(held, "first").select("gram", "first", shard.alias("shard"))
    own = F.when(F.col("doc_id") == F.col("first"), F.struct("gram", "shard"))
    routes = written(grams.join(home, "gram").groupBy("doc_id").agg(
        F.collect_set("shard").alias("shards"), F.collect_set(own).alias("own")))
    for used in (grams, recurring):  # nothing reads them any more
        discard(used)
    parts = (routes.select(F.explode("shards").alias("shard")).groupBy("shard")
             .agg(F.ceil(F.count("*") / shard_docs).alias("parts")))
    stream = named.join(routes, "doc_id").mapInArrow(
        _spread(phrase, window), "shard long, doc_id long, tk long, gram long, text binary").join(parts, "shard")
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)  # phrases go to all parts of their shard
    mine = F.array(F.pmod(F.xxhash64("doc_id", "tk"), F.col("parts")))
    dealt = (stream.withColumn("part", F.explode(F.when(F.col("doc_id").isNull(), every).otherwise(mine))).drop("parts")
             .repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("doc_id").asc_nulls_first()))
    occurrences = written(dealt.mapInArrow(_locate(phrase, window), ", ".join(f"`{f.name}` long" for f in FOUND)))
    discard(routes)

    contexts = written(occurrences.groupBy("gram", "c1", "c2").agg(F.min("doc_id").alias("first")))
    several = written(contexts.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"))
    judged = occurrences.join(contexts, ["gram", "c1", "c2"])
    later = judged.where(f"doc_id > first and end - start >= {window}").select("doc_id", "tk", "start", "end")
    open_at = (judged.where("doc_id = first").join(several, "gram", "left_semi")
               .groupBy("doc_id", "tk").agg(F.collect_set("at").alias("ats")))
    windows = written(named.join(open_at, ["doc_id", "tk"]).mapInArrow(
        _windows(phrase, window), "doc_id long, tk long, w1 long, w2 long, start int"))
    seen = written(windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                   .where("first < last").select("w1", "w2", "first"))
    again = (windows.join(seen, ["w1", "w2"]).where("doc_id > first")
             .select("doc_id", "tk", F.col("start").cast("long"), (F.col("start") + window).cast("long").alias("end")))
    ranges = written(later.unionByName(again).groupBy("doc_id", "tk").agg(
        F.collect_set(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))).alias("ranges")))
    for used in (occurrences, contexts, several, windows, seen):
        discard(used)

    kind = dict(rows.dtypes)["carry"]
    out = f"doc_id long, n_words long, n_removed long, kept_sha256 string, carry {kind}" + ", text string" * with_text
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], out).schema)
    result = rows.withColumn("tk", F.xxhash64("text")).join(ranges, ["doc_id", "tk"], "left").mapInArrow(_remove(schema), out)
    return result if carry else result.drop("carry")


def remove_repeats_sql(documents: str = "documents", window: int = 50) -> str:
    """DuckDB SQL of `remove_repeats` (without text), over all windows' words; ids don't repeat."""
    return rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM {documents}),
    places AS (SELECT doc_id, words, unnest(range(1, len(words) - {window} + 2)) AS i FROM d WHERE len(words) >= {window}),
    windows AS (SELECT doc_id, i, md5(array_to_string(words[i:i + {window} - 1], ' ')) AS g FROM places),
    later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM windows) WHERE doc_id > first),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS i FROM later),
    every AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
    kept AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS text, count(*) AS n
             FROM every e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i WHERE g.i IS NULL GROUP BY e.doc_id)
    SELECT d.doc_id, len(d.words)::BIGINT AS n_words, (len(d.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
           sha256(coalesce(k.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id"""
