"""Corpus pipeline: from raw documents to packed training sequences.

STAGES are applied one after the other, each to all that its predecessor
kept, with what it returned written as Parquet and read again in between.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import mixing, packing, quality_rules, simhash, substring
from riskloom.llm.common import WORD
from riskloom.session import ship_package, written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines above the limits.

    A null or empty text is rejected; a null source is a source of its own; repeated rows are judged alike.
    """
    return _measured(quality_rules.clean(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints stays, one of the smallest id (null after all others).

    Rows of one id, or without one, are documents of their own: only linked texts are copies.  Null and empty texts
    are linked with each other.
    """
    ship_package(spark)
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5(F.coalesce("text", F.lit(""))),
                       F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns)).cast("string"))
    rows = docs.select(_row(docs), "doc_id", "text", name.alias("key"))
    groups = simhash.simhash_components(rows, key_col="key")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")).alias("least")
    stay = groups.groupBy("label").agg(least).select(F.col("least.key").alias("key"))
    return rows.join(stay, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document holds go; a document that loses none stays as it was."""
    ship_package(spark)
    out = substring.remove_repeats(docs, with_text=True, carry=[c for c in docs.columns if c != "text"])
    rest = [F.col("text") if c == "text" else F.col(f"carry.`{c}`").alias(c) for c in docs.columns]
    return _measured(out.select(*rest), docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document; the last one may be its first words only.

    Texts without words are not taken.  Rows of one id and text are taken as one, in the order of their other columns.
    """
    ship_package(spark)
    taken = mixing.mix(docs).where("taken > 0").groupBy("key").agg(F.sum("taken").alias("taken"), F.min("size").alias("size"))
    other = F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns))
    rows = (docs.select(_row(docs), mixing.order_key("doc_id", "text").alias("key"), other.alias("other"))
            .groupBy("key").agg(F.min_by("row", "other").alias("row")).join(taken, "key")
            .withColumn("pass", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size"))))))
    words = F.least(F.col("size"), F.col("taken") - (F.col("pass") - 1) * F.col("size"))
    part = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0)), F.lit(1), words.cast("int")), " ")
    text = F.when(words < F.col("size"), part).otherwise(F.col("row.text"))
    return _measured(rows.select(*((text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns)), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null or empty text is its end id alone."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def _row(docs: DataFrame) -> Column:
    """An input row as one value, so that no column of it can bear a name used here."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars``, where there is one, follows the text."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(columns)


STAGES = [("quality rules", rules), ("simhash near-dedup", near_duplicates), ("substring dedup", repeated_passages),
          ("mixing", mixture), ("packing", packed)]

#: SQL can't express the fingerprints and the linear program.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
