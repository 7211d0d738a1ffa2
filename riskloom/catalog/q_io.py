"""Registered source/sink queries (IO1-IO7)."""

from __future__ import annotations

import uuid

from riskloom.catalog.registry import register, table
from riskloom.operators.fairness import compute_slice_metrics
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import io as IO

ORDERS_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                 "o_orderpriority string")


@register("csv_roundtrip",
          "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
          operators="IO1, IO2, IO3, IO5")
def csv_roundtrip(spark, sf):
    src = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                            "o_totalprice", "o_orderpriority")
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    IO.save(src, path, "csv")  # written in parallel, one file per partition
    back = IO.load(spark, path, "csv", schema=ORDERS_SCHEMA)
    features, label = IO.split_features_target(back, "o_orderpriority")
    return back.select(*features, label)


@register("csv_quarantine",
          "SELECT CASE WHEN o_custkey % 10 <> 0 THEN o_orderkey END AS o_orderkey, "
          "CASE WHEN o_custkey % 10 <> 0 AND o_custkey % 10 <> 1 THEN o_totalprice END AS o_totalprice, "
          "CASE WHEN o_custkey % 10 <> 0 THEN o_orderpriority END AS o_orderpriority, "
          "CASE WHEN o_custkey % 10 = 0 THEN o_orderkey || ',unpriced,' || o_orderpriority END AS line FROM orders",
          operators="IO1")
def csv_quarantine(spark, sf):
    """Orders as CSV in which some prices are a word and some an NA token: rows that load, and the lines that don't."""
    price = "CASE o_custkey % 10 WHEN 0 THEN 'unpriced' WHEN 1 THEN 'N/A' ELSE CAST(o_totalprice AS STRING) END AS o_totalprice"
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    IO.save(table(spark, sf, "orders").selectExpr("o_orderkey", price, "o_orderpriority"), path, "csv")
    good, bad = IO.load_quarantined(spark, path, "o_orderkey long, o_totalprice double, o_orderpriority string")
    return good.unionByName(bad, allowMissingColumns=True)


@register("markdown_report", None, operators="IO4, EV8")
def markdown_report(spark, sf):
    from riskloom.catalog.q_metrics import scored_by

    slices = compute_slice_metrics(scored_by(spark, sf, "score_mix"),
                                   slice_features=["l_linestatus", "qty_band"])
    return IO.to_markdown_lines(slices)


@register("preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5", operators="IO7")
def preview(spark, sf):
    return IO.preview(table(spark, sf, "orders"), "o_orderkey")
