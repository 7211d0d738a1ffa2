"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import ship_package

from . import bestfit, classifier, collocations, embeddings, mixing, quality_rules, repair, sharding, simhash, substring
from .common import table
from .packing import pack_documents
from .token_counts import token_counts
from .token_store import read_tokens, store_path, write_tokens

OVER_LIMIT = 1024
SHARDS = [f"shard-{i:03d}" for i in range(128)]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > OVER_LIMIT)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_components(table(spark, sf_dir, "embeddings"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("tk")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))  # a null id is not held out
    ranking = classifier.fit_on(docs.where(~held_out), labels.where(~held_out).select("doc_id", "quality"))
    return classifier.score_documents(docs, ranking).withColumn("held_out", held_out)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store_path(spark, f"shards-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    sharding.write_shards(docs, path, SHARDS)
    schema = sharding.assign_shards(docs, SHARDS).schema  # else an empty table couldn't be read back
    return spark.read.schema(schema).parquet(path).select("doc_id", "slot", "shard")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store_path(spark, f"tokens-{uuid.uuid4().hex}")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_tokens(spark, path)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = bestfit.cut_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return bestfit.place_pieces(digests).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = repair.repair(repair.damage(rows)).withColumnRenamed("conv_id", "found_id")
    every = rows.select("conv_id").distinct()
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(run)
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    return call


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _query(f) for f in (
    op1_token_counts, op2_embedding_dedup, op3_quality_rules, op4_quality_classifier, op5_sharding, op6_substring_dedup,
    op7_packing, op8_mixing, op9_simhash, op10_token_store, op11_best_fit_packing, op12_collocations, op13_conversation_repair, pipeline)}

#: DuckDB SQL of the queries that SQL can express; the others are tested against brute force.
ORACLES: dict[str, str] = {
    "op2_embedding_dedup": embeddings.components_sql(),
    "op3_quality_rules": quality_rules.judge_sql(),
    "op6_substring_dedup": substring.remove_repeats_sql(),
    "op8_mixing": mixing.mix_sql(),
    "op12_collocations": collocations.collocations_sql(),
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
