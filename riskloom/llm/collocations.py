"""Phrase collocations by SON partitioning (operator 12).

A phrase that occurs ``min_count`` times in all documents occurs at least
``min_count / shards`` times in one of ``shards`` parts of them.

1. Documents are dealt to shards by hash.  Each shard is mined completely at
   that lowered support, level by level: words and pairs first, then phrases
   of one more word whose two shorter phrases are frequent in the shard.
   Phrases count as 64-bit hashes here (two that share a hash can only be
   counted too often, so none is lost), summed per task before the shuffle.
2. What is frequent in some shard is a candidate.
3. All documents are read once more, and the candidates are counted in all of
   them, by their text.

Only candidates and what a Bloom filter takes for one reach the last shuffle.
The filters have a fixed number of bits (``filter_bits``), whatever the
corpus; beyond it they let more phrases through, which costs shuffle and
changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import written

from .common import record, slices
from .substring import mix

#: Bytes that end a piece, and those between words (fixed values).
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
LOCAL = pa.schema([("shard", pa.int32()), ("level", pa.int32()), ("h", pa.int64()), ("n", pa.int64())])
LOCAL_DDL = "shard int, level int, h long, n long"
COUNTS = pa.schema([("lang", pa.string()), ("level", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
COUNTS_DDL = "lang string, level int, phrase string, n long"
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))  # odd multipliers of the hashes
BITMAP = 32768  # values per bitmap of Spark's bitmap functions (fixed value)


def _fold() -> np.ndarray:
    """Each byte in lower case (A-Z only), ends of pieces as line feeds and tabs as blanks."""
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    fold[list(ENDS)], fold[list(BLANKS)] = 10, 32
    return fold


FOLD = _fold()
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * ODD[0])  # a random number per byte


class Tokens:
    """The words of some texts as hashes, with the pieces and texts that they stand in."""

    def __init__(self, texts: list[bytes], salts: np.ndarray) -> None:
        self.raw = FOLD[np.frombuffer(b"\n".join(texts), dtype=np.uint8)]
        self.inner = (self.raw != 10) & (self.raw != 32)
        edge = np.flatnonzero(np.diff(self.inner.view(np.int8), prepend=0, append=0))
        self.start, self.end = edge[::2], edge[1::2]
        ends = np.cumsum(self.raw == 10)
        self.same_piece = ends[self.start[1:]] == ends[self.end[:-1] - 1]  # word i + 1 is in the piece of word i
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        self.text = np.searchsorted(begins, self.start, "right") - 1
        self.salt = salts[self.text]

    def words(self, odd: np.uint64) -> np.ndarray:
        """A polynomial hash of each word and its text's language."""
        size = self.end - self.start
        place = np.concatenate([[0], np.cumsum(size)])
        within = np.arange(place[-1]) - np.repeat(place[:-1], size)
        powers = np.full(int(size.max(initial=0)) + 1, odd)
        powers[0] = 1
        values = BYTE[self.raw[self.inner]] * np.multiply.accumulate(powers)[within]
        word = np.add.reduceat(values, place[:-1]) if len(size) else np.zeros(0, np.uint64)
        return mix(mix(word + size.astype(np.uint64) * odd) ^ self.salt)

    def levels(self, upto: int, odd: np.uint64 = ODD[1]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words in a phrase, first words of all phrases of that many words, their hashes)."""
        words = self.words(odd)
        at, h = np.arange(len(words)), words
        yield 1, at, h
        for level in range(2, upto + 1):
            longer = at + level - 1 < len(words)
            longer[longer] = self.same_piece[at[longer] + level - 2]
            at = at[longer]
            h = mix(h[longer] * odd + words[at + level - 1])
            yield level, at, h

    def phrase(self, first: int, level: int) -> bytes:
        """The words from ``first`` on, one blank between them."""
        return b" ".join(self.raw[self.start[first]:self.end[first + level - 1]].tobytes().split())


def blocks(batches: Iterator[pa.RecordBatch], max_bytes: int = 2 << 20) -> Iterator[tuple[list[bytes], list[str], np.ndarray]]:
    """(texts, languages, shards) of about ``max_bytes``; a longer text comes in several, cut at ends of pieces."""
    for batch in slices(batches, max_bytes):
        langs, shards = batch.column("lang").to_pylist(), batch.column("shard").to_numpy(zero_copy_only=False)
        texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
        if len(texts) > 1 or len(texts[0]) <= 2 * max_bytes:
            yield texts, langs, shards
            continue
        text, at = texts[0], 0
        folded = text.translate(FOLD.tobytes())
        while at < len(text):
            cut = folded.find(b"\n", at + max_bytes)
            cut = len(text) if cut < 0 else cut + 1
            yield [text[at:cut]], langs, shards
            at = cut


def salts(langs: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(x) for x in langs], dtype=np.uint64)


class Bloom:
    """A set of hashes as bits; two bits per hash."""

    def __init__(self, bits: bytes) -> None:
        self.bits, self.mask = np.frombuffer(bits, dtype=np.uint8), np.uint64(8 * len(bits) - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), dtype=bool)
        for p in (h & self.mask, (h >> np.uint64(32)) & self.mask):
            out &= (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def bloom(hashes: DataFrame, filter_bits: int) -> bytes:
    """The filter of a column ``h``: bitmaps of 4 KB aggregated by Spark, ``filter_bits / 8`` bytes in all."""
    places = hashes.select(F.explode(F.array(F.col("h"), F.shiftrightunsigned("h", 32))).alias("p")).select(
        F.col("p").bitwiseAND(F.lit(filter_bits - 1)).alias("p"))
    maps = places.groupBy(F.floor(F.col("p") / BITMAP).alias("b")).agg(
        F.bitmap_construct_agg(F.pmod("p", F.lit(BITMAP))).alias("bits")).collect()
    out = bytearray(filter_bits // 8)
    for r in maps:
        out[r["b"] * (BITMAP // 8):(r["b"] + 1) * (BITMAP // 8)] = r["bits"]
    return bytes(out)


def shard_salts(shards: int) -> np.ndarray:
    """What a phrase's hash is combined with (exclusive or) to tell its shards apart."""
    return mix(np.arange(1, shards + 1, dtype=np.uint64) * ODD[2])


def _mine(levels: tuple[int, ...], shards: int, shorter):
    """Counts per shard of the phrases of some levels; of level 3 and beyond, those whose shorter phrases are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, salt = Bloom(shorter.value) if shorter is not None else None, shard_salts(shards)
        for texts, langs, dealt in blocks(batches):
            tokens = Tokens(texts, salts(langs))
            frequent = np.zeros(len(tokens.start) + 1, dtype=bool)  # by first word, of the level below
            for level, at, h in tokens.levels(max(levels)):
                shard = dealt[tokens.text[at]]
                if level not in levels:
                    if level == min(levels) - 1:
                        frequent[at] = known.has(h ^ salt[shard])
                    continue
                if known is not None:
                    both = frequent[at] & frequent[at + 1]
                    h, shard = h[both], shard[both]
                for s in np.unique(shard):
                    value, n = np.unique(h[shard == s], return_counts=True)
                    yield record(LOCAL, shard=np.full(len(value), s), level=np.full(len(value), level),
                                 h=value.view(np.int64), n=n)

    return run


def _count(upto: int, candidates):
    """Counts of the candidates by text, and of all words by language (``level`` 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Bloom(candidates.value)
        for texts, langs, _ in blocks(batches):
            tokens = Tokens(texts, salts(langs))
            words = np.bincount(tokens.text, minlength=len(texts))
            yield record(COUNTS, lang=langs, level=np.zeros(len(langs), np.int32), phrase=[None] * len(langs), n=words)
            for (level, at, h), (_, _, h2) in zip(tokens.levels(upto), tokens.levels(upto, ODD[2]), strict=True):
                keep = known.has(h)
                at, h, h2 = at[keep], h[keep], h2[keep]
                order = np.argsort(h, kind="stable")
                at, h, h2 = at[order], h[order], h2[order]
                # two phrases of one hash differ in the second one; a phrase in several runs is summed by its text later
                first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])])) if len(h) else at
                n, at = np.diff(np.append(first, len(h))), at[first]
                phrases = [tokens.phrase(i, level) for i in at.tolist()]
                yield record(COUNTS, lang=[langs[i] for i in tokens.text[at].tolist()], level=np.full(len(at), level),
                             phrase=pa.array(phrases, pa.binary()).cast(pa.string()), n=n)

    return run


def rows_of(docs: DataFrame, shards: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, shard, text); a row's shard follows from its id and text."""
    text = F.col(text_col)
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.pmod(F.xxhash64(F.col(id_col).cast("string"), text), F.lit(shards)).cast("int").alias("shard"),
                       text.alias("text"))


def local_candidates(rows: DataFrame, support: int, max_words: int, shards: int, filter_bits: int) -> DataFrame:
    """(h) of the phrases that reach ``support`` in some shard: each shard mined completely, level by level."""
    salt = F.array(*(F.lit(int(s)) for s in shard_salts(shards).view(np.int64)))
    found: list[DataFrame] = []
    for level in range(2, max_words + 1):
        shorter = None
        if found:
            below = found[-1].where(F.col("level") == level - 1)
            marked = below.select(F.col("h").bitwiseXOR(F.get(salt, F.col("shard"))).alias("h"))
            shorter = rows.sparkSession.sparkContext.broadcast(bloom(marked, filter_bits))
        local = rows.mapInArrow(_mine((1, 2) if level == 2 else (level,), shards, shorter), LOCAL_DDL)
        found.append(written(local.groupBy("shard", "level", "h").agg(F.sum("n").alias("n"))
                             .where(F.col("n") >= support).select("shard", "level", "h")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("h")


def phrase_counts(docs: DataFrame, min_count: int = 10, max_words: int = 3, shards: int = 4, filter_bits: int = 1 << 27,
                  id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, level, phrase, n): exact counts of all phrases of up to ``max_words`` words that occur ``min_count``
    times (and of some others), by language; ``level`` is the number of words, and level 0 counts all words.

    Every phrase and part of a phrase of ``min_count`` occurrences is among
    them: parts occur at least as often.
    """
    rows = rows_of(docs, shards, id_col, text_col, lang_col)
    candidates = local_candidates(rows, -(-min_count // shards), max_words, shards, filter_bits)
    known = docs.sparkSession.sparkContext.broadcast(bloom(candidates, filter_bits))
    return written(rows.mapInArrow(_count(max_words, known), COUNTS_DDL)
                   .groupBy("lang", "level", "phrase").agg(F.sum("n").alias("n")))


def collocations(docs: DataFrame, min_count: int = 10, max_words: int = 3, top: int = 2000, inside_percent: int = 50,
                 shards: int = 4, filter_bits: int = 1 << 27, rank_buckets: int = 64, id_col: str = "doc_id",
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The best ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends
    and into words at blanks; phrases do not cross pieces.  ``a`` counts a
    phrase of 2 to ``max_words`` words (at least ``min_count``); of its cuts
    into ``l`` and ``r`` the one of the least score floor(10^6 a a / (l r))
    counts, then the first.  Phrases inside a longer one of at least
    ``inside_percent`` % of their count are left out.  Ranked by score, count
    (both descending) and phrase (by UTF-8 bytes).

    A null language is ``und``; a null or empty text has no words; null ids
    and repeated rows count like others; a text longer than a block is read in
    blocks cut at ends of pieces; an empty table gives no rows; other columns
    are not read.
    """
    counts = phrase_counts(docs, min_count, max_words, shards, filter_bits, id_col, text_col, lang_col)
    words = F.split("phrase", " ", -1)
    run = lambda first, size: F.array_join(F.slice(F.col("words"), first, size), " ")
    frequent = counts.where((F.col("level") > 1) & (F.col("n") >= min_count)).select(
        "lang", "phrase", "level", F.col("n").alias("a"))
    split = frequent.withColumn("words", words)

    # every cut asks for two parts; one join on (lang, part) answers all
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("level") - 1)))
    sides = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("left"), run(F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit(False).alias("left"), run(F.col("k") + 1, F.col("level") - F.col("k")).alias("part")))).alias("s"))
    asked = sides.select("lang", "phrase", "a", "k", "s.left", F.col("s.part").alias("part"))
    parts = counts.where("level > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    both = asked.join(parts, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.expr("(cast(1000000 as decimal(7,0)) * a * a) div (l * r)")
    scored = (both.withColumns({c: exact(c) for c in ("a", "l", "r")}).withColumn("score", score)
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))

    # phrases that lie in a longer one
    sizes = F.explode(F.sequence(F.lit(2), F.col("level") - 1))
    inner = (split.where("level > 2").withColumn("size", sizes)
             .withColumn("first", F.explode(F.sequence(F.lit(1), F.col("level") - F.col("size") + 1)))
             .select("lang", run(F.col("first"), F.col("size")).alias("phrase"), "a"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = (scored.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))))

    # the best of each bucket first, so that no language meets in one task
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    flat = left.select("lang", "phrase", *(F.col(c).cast("long").alias(c) for c in ("a", "cut.l", "cut.r", "cut.score")))
    flat = flat.toDF("lang", "phrase", "a", "l", "r", "score").withColumn("b", F.pmod(F.xxhash64("phrase"), F.lit(rank_buckets)))
    best = (flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "b").orderBy(*order)))
            .where(F.col("rank") <= top).drop("b", "rank"))
    total = counts.where("level = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (ranked.where(F.col("rank") <= top).join(total, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", F.col("n").cast("long").alias("n"), "score"))


def collocations_sql(documents: str = "documents", min_count: int = 10, top: int = 2000, inside_percent: int = 50) -> str:
    """DuckDB SQL of `collocations` for phrases of 2 and 3 words, without shards."""
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
               FROM {documents}),
    pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    grams AS (
      SELECT lang, 1 AS level, unnest(w) AS phrase FROM w
      UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) > 1)
      UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
                FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
    f AS (SELECT lang, level, phrase, count(*) AS n FROM grams GROUP BY ALL),
    total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE level = 1 GROUP BY lang),
    cand AS (SELECT lang, level, phrase, n AS a, string_split(phrase, ' ') AS p FROM f WHERE level > 1 AND n >= {min_count}),
    cuts AS (SELECT lang, phrase, a, 1 AS k, p[1] AS x, array_to_string(p[2:], ' ') AS y FROM cand
             UNION ALL SELECT lang, phrase, a, 2, p[1] || ' ' || p[2], p[3] FROM cand WHERE level = 3),
    scored AS (SELECT c.lang, c.phrase, c.a, c.k, x.n AS l, y.n AS r,
                      (1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n) AS score
               FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y),
    least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    longer AS (SELECT lang, phrase, max(a) AS a FROM (
                 SELECT lang, p[1] || ' ' || p[2] AS phrase, a FROM cand WHERE level = 3
                 UNION ALL SELECT lang, p[2] || ' ' || p[3], a FROM cand WHERE level = 3) GROUP BY ALL),
    kept AS (SELECT s.* FROM least s LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
             WHERE o.a IS NULL OR 100 * o.a < {inside_percent} * s.a)
    SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, k.a DESC, phrase) AS rank, phrase,
           k.a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n, score::BIGINT AS score
    FROM kept k JOIN total t ON t.lang = k.lang
    QUALIFY rank <= {top}"""
