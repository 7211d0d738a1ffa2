"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``edges`` (a, b: long); the label is a node of the component.

    Each round, every node points to its smallest neighbour (or itself), the
    pointers are followed four steps, and the edges are drawn between what they
    end at.  Nothing but counts reaches the driver.  A hub is pre-aggregated
    in the minimum, and its rows in the joins come from written tables, which
    lets adaptive execution split it.
    """
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    spark, mapping = edges.sparkSession, None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                     .select("node", F.least("node", "b").alias("to")))
        for _ in range(2):  # every jump doubles the steps
            up = written(_follow(up, up))
        mapping = up if mapping is None else written(_follow(mapping, up))
        ends = [up.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab"]
        edges = written(edges.join(ends[0], "a").join(ends[1], "b")
                        .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
                        .where("a <> b").distinct())
    if mapping is None:
        return spark.createDataFrame([], "node long, label long")
    return mapping.withColumnRenamed("to", "label")


def _follow(mapping: DataFrame, up: DataFrame) -> DataFrame:
    """Where ``mapping`` leads after one more step along ``up``."""
    step = up.select(F.col("node").alias("to"), F.col("to").alias("next"))
    return mapping.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
