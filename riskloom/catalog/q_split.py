"""Registered split and balance queries (SP1, SP2, BA1-BA5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.registry import register, table, view, view_sql
from riskloom.operators import balance as BA
from riskloom.operators import split as SP

EV = view_sql("events_n")
# an ordering both engines can compute (xxhash64 has no DuckDB twin)
ORDER_SQL = "(event_id * 7919) % 10007"
RANK = f"row_number() OVER (PARTITION BY label ORDER BY {ORDER_SQL}, event_id)"


def _events(spark, sf):
    return view(spark, sf, "events_n").select("event_id", "label")


@register("stratified_split",
          f"SELECT event_id, label, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split "
          f"FROM (SELECT event_id, label, {RANK} AS rn, count(*) OVER (PARTITION BY label) AS n "
          f"FROM {EV} AS e) AS t", operators="SP1")
def stratified_split(spark, sf):
    return SP.stratified_split(_events(spark, sf), "label", ["event_id"], 0.2,
                               order=F.expr(ORDER_SQL))


@register("stratified_folds",
          f"SELECT event_id, label, CAST((rn - 1) % 5 AS INTEGER) AS fold "
          f"FROM (SELECT event_id, label, {RANK} AS rn FROM {EV} AS e) AS t", operators="SP2")
def stratified_folds(spark, sf):
    return SP.stratified_folds(_events(spark, sf), "label", ["event_id"], 5, order=F.expr(ORDER_SQL))


@register("undersample",
          f"WITH c AS (SELECT label, count(*) AS n FROM {EV} AS e GROUP BY label), "
          f"k AS (SELECT c.label, CASE WHEN c.n = (SELECT max(n) FROM c) "
          f"THEN CAST(floor((SELECT min(n) FROM c) / 0.5) AS BIGINT) ELSE c.n END AS keep FROM c) "
          f"SELECT event_id, label FROM (SELECT event_id, label, {RANK} AS rn FROM {EV} AS e) AS t "
          f"JOIN k USING (label) WHERE rn <= keep", operators="BA2")
def undersample(spark, sf):
    return BA.undersample(_events(spark, sf), "label", ["event_id"], 0.5, order=F.expr(ORDER_SQL))


@register("class_weights",
          "SELECT quality, count(*) AS count, CAST((SELECT count(*) FROM labels) AS DOUBLE) / "
          "((SELECT count(DISTINCT quality) FROM labels) * count(*)) AS weight FROM labels GROUP BY quality",
          ["weight"], "BA3")
def class_weights(spark, sf):
    return BA.class_weight_table(table(spark, sf, "labels"), "quality")


@register("cost_weights",
          "SELECT doc_id, quality, CASE WHEN quality = 1 THEN 10.0 ELSE 1.0 END * "
          "(SELECT CAST(count(*) AS DOUBLE) / sum(CASE WHEN quality = 1 THEN 10.0 ELSE 1.0 END) FROM labels) "
          "AS weight FROM labels", ["weight"], "BA4")
def cost_weights(spark, sf):
    return BA.cost_sensitive_weights(table(spark, sf, "labels"), "quality").select(
        "doc_id", "quality", "weight")


@register("scale_pos_weight",
          "SELECT doc_id, toxic, CASE WHEN toxic = 1 THEN (SELECT CAST(sum(1 - toxic) AS DOUBLE) / "
          "sum(toxic) FROM labels) ELSE 1.0 END AS weight FROM labels", ["weight"], "BA5")
def scale_pos_weight(spark, sf):
    return BA.with_scale_pos_weight(table(spark, sf, "labels"), "toxic").select("doc_id", "toxic", "weight")


@register("smote", None, operators="BA1")
def smote(spark, sf):
    emb = table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"),
        (F.col("label") == 0).cast("int").alias("label"))
    return BA.smote(emb, "label", "embedding", "vec_id", 5)


@register("smote_class_counts",
          "WITH c AS (SELECT CAST(coalesce(label = 0, false) AS INTEGER) AS label, count(*) AS n FROM embeddings GROUP BY 1) "
          "SELECT label, (SELECT max(n) FROM c) AS n, (SELECT max(n) FROM c) - n AS n_synthetic FROM c", operators="BA1")
def smote_class_counts(spark, sf):
    return smote(spark, sf).groupBy("label").agg(
        F.count("*").alias("n"), F.sum("synthetic").cast("long").alias("n_synthetic"))
