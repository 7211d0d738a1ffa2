"""Quality rules with cross-document line frequency (operator 3).

DataFrame functions only.  Per document: counts of words, symbols, repeated
lines and repeated 3-word windows, and base rules on them.  Across documents:
normalised lines are hashed, the distinct documents that hold a line are
counted per host, lines above the limits are removed, and documents that lose
too much are rejected.

Documents of one text are one document: copies of a page don't make its lines
common.

Words and repeats are counted in arrays of one document, without a shuffle.
Lines are a row each from the start: (host, line, document) is aggregated in
the tasks before it is shuffled, and the lines above the limits are joined back
to the lines, which are written once as hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import discard, written

from .common import WORD

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"


def windows(words: Column) -> Column:
    """(hash, position) of each 3-word window of an array (``words`` must be a plain column)."""
    return F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
                       lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))


def covered(sorted_grams: Column) -> Column:
    """Words covered by the windows whose hash comes twice, from sorted (hash, position) pairs."""
    same = lambda g, i: F.get(sorted_grams, i)["h"] == g["h"]
    repeats = F.filter(sorted_grams, lambda g, i: ((i > 0) & F.coalesce(same(g, F.greatest(i - 1, F.lit(0))), F.lit(False)))
                       | F.coalesce(same(g, i + 1), F.lit(False)))
    places = F.sort_array(F.transform(repeats, lambda g: g["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
    return F.aggregate(places, start, step, lambda a: a["n"])


def base_counts(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, tk, host, text) with the base counts, without the text."""
    split = rows.select("doc_id", "tk", F.filter(F.split("text", BLANKS, -1), lambda w: w != "").alias("words"),
                        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
                        (F.size(F.split("text", SYMBOL, -1)) - 1).cast("long").alias("n_symbols"))
    grams = split.select("doc_id", "tk", F.size("words").cast("long").alias("n_words"),
                         F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
                         (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                         windows(F.col("words")).alias("grams"))
    hashes = grams.withColumn("repeats", F.size("grams") > F.size(F.array_distinct(F.col("grams.h"))))
    ordered = hashes.withColumn("grams", F.when(F.col("repeats"), F.sort_array("grams")))
    return ordered.withColumn("n_repeat_words", F.when(F.col("repeats"), covered(F.col("grams"))).otherwise(F.lit(0).cast("long"))) \
                  .drop("grams", "repeats")


def normal(line: Column) -> Column:
    """A line in lower case, with single blanks and every digit as 0."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(line, BLANKS, " "))), r"[0-9]", "0")


def line_hash(line: Column) -> Column:
    """128 bits of a normalised line."""
    return F.md5(normal(line))


def document_lines(rows: DataFrame) -> DataFrame:
    """(tk, host, document, at, line, words): a row for each non-blank line."""
    raw = rows.select("tk", "host", "document", F.posexplode(F.split("text", "\n", -1)).alias("at", "raw")).where(F.col("raw").rlike(WORD))
    words = F.size(F.split(F.trim(F.regexp_replace("raw", BLANKS, " ")), " "))
    return raw.select("tk", "host", "document", "at", line_hash(F.col("raw")).alias("line"), words.alias("words"))


def distinct_documents(rows: DataFrame, by: list[str]) -> DataFrame:
    """The number of distinct documents of each group; a hot group is spread over its documents first."""
    return rows.groupBy(*by, "document").agg(F.lit(1).alias("one")).groupBy(*by).agg(F.count("*").alias("n"))


def common_lines(rows: DataFrame, lines: DataFrame, min_docs: int, host_share: float) -> DataFrame:
    """(host, line) of the lines above the limits: in at least ``min_docs`` distinct documents of the host, and in
    at least ``host_share`` of them."""
    of_host = distinct_documents(rows, ["host"]).withColumnRenamed("n", "docs")
    counts = distinct_documents(lines, ["host", "line"]).where(F.col("n") >= min_docs)
    return counts.join(of_host, "host").where(F.col("n") >= host_share * F.col("docs")).select("host", "line")


def text_digest(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def row_key(id_col: str, text_col: str, host_col: str) -> Column:
    """Tells rows of one id and different texts or hosts apart (128 bits)."""
    known = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    return F.md5(F.concat_ws("\u0000", known, host(host_col), text_digest(text_col)))


def host(host_col: str) -> Column:
    return F.coalesce(F.col(host_col).cast("string"), F.lit("\u0000"))


def judge(docs: DataFrame, min_docs: int = 20, host_share: float = 0.05, max_removed: float = 0.7,
          min_words: int = 50, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          with_common: bool = False) -> DataFrame:
    """(doc_id, tk, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_common_words, base_failed, kept[, common]).

    ``base_failed``: fewer than ``min_words`` words, or more than half of them
    in repeated 3-word windows.  ``n_common_words`` counts the words of lines
    above the limits (`common_lines`), whose hashes ``common`` lists.  A
    document is kept if it has not failed and loses at most ``max_removed`` of
    its words with those lines.  ``tk`` is `row_key`.

    A null text is empty: no words, hence failed.  A null host is a host of
    its own.  Rows with null ids and repeated rows are judged like others, a
    row each; an empty table gives no rows; other columns are neither read nor
    returned.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col, host_col).alias("tk"),
                       host(host_col).alias("host"), text_digest(text_col).alias("document"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = written(document_lines(rows), "snappy")
    common = written(common_lines(rows, lines, min_docs, host_share), "snappy")
    held = lines.join(common, ["host", "line"]).groupBy("tk", "at").agg(  # repeated rows have one key
        F.first("words").alias("words"), F.first("line").alias("line"))
    removed = written(held.groupBy("tk").agg(F.sum("words").cast("long").alias("n_common_words"), F.collect_set("line").alias("common")), "snappy")
    for used in (lines, common):  # nothing reads them any more
        discard(used)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counts = written(base_counts(rows), "snappy")  # else a filter on the verdict would be pushed into the arrays' expressions
    return (counts.join(removed if with_common else removed.drop("common"), "tk", "left")
            .withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0).cast("long")))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("n_common_words") <= max_removed * F.col("n_words"))))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **options) -> DataFrame:
    """The kept rows of ``docs``, all columns, their texts without the lines above the limits (see `judge`)."""
    verdict = judge(docs, id_col=id_col, text_col=text_col, host_col=host_col, with_common=True, **options)
    kept = verdict.where("kept").select("tk", "common").dropDuplicates(["tk"])
    # the input row is one struct, so that no column of it can bear a name used here
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text_col}`").alias("text"),
                      row_key(id_col, text_col, host_col).alias("tk")).join(kept, "tk")
    left = F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains("common", line_hash(x)))
    text = F.when(F.col("common").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return row.select(*((text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def judge_sql(documents: str = "documents", min_docs: int = 20, host_share: float = 0.05, max_removed: float = 0.7,
              min_words: int = 50) -> str:
    """DuckDB SQL of `judge` over ids that don't repeat, without ``tk``."""
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text FROM {documents}),
    w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
    places AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2),
    grams AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM places),
    twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE n > 1)
                GROUP BY doc_id),
    raw AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS l FROM d),
    lines AS (SELECT doc_id, host, l,
                     md5(regexp_replace(lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))), '[0-9]', '0', 'g')) AS line,
                     len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS words
              FROM raw WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
    doubled AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id),
    texts AS (SELECT doc_id, host, md5(text) AS document FROM d),
    hosts AS (SELECT host, count(DISTINCT document) AS docs FROM texts GROUP BY host),
    counts AS (SELECT l.host, l.line, count(DISTINCT t.document) AS n FROM lines l JOIN texts t ON l.doc_id = t.doc_id GROUP BY ALL),
    common AS (SELECT c.host, c.line FROM counts c JOIN hosts h ON c.host = h.host
               WHERE c.n >= {min_docs} AND c.n >= {host_share} * h.docs),
    removed AS (SELECT l.doc_id, sum(l.words) AS n FROM lines l JOIN common c ON l.host = c.host AND l.line = c.line GROUP BY l.doc_id),
    base AS (
      SELECT w.doc_id, len(w.words)::BIGINT AS n_words, length(array_to_string(w.words, ''))::BIGINT AS word_chars,
             (length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(b.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             coalesce(r.n, 0)::BIGINT AS n_common_words
      FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id LEFT JOIN doubled b ON b.doc_id = w.doc_id
      LEFT JOIN removed r ON r.doc_id = w.doc_id),
    verdict AS (SELECT *, n_words < {min_words} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
    SELECT *, NOT base_failed AND n_common_words <= {max_removed} * n_words AS kept FROM verdict"""
