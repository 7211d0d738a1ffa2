"""Recursive elimination of features: its many fits read rows that are kept once."""

import os

import pytest
from pyspark.sql import functions as F

from riskloom import config, session
from riskloom.operators.encode import select_features_with_rfe


@pytest.mark.parametrize("per_bucket", [1000, 100])
def test_the_rows_are_computed_once_for_all_fits(spark, monkeypatch, tmp_path, per_bucket):
    """Below and above the size where the rows go to even files, which are deleted at the end."""
    monkeypatch.setattr(config, "ROWS_PER_BUCKET", per_bucket)
    if per_bucket == 100:
        monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def label(i):
        seen.add(1)
        return float(i % 7 > 2)

    rows = spark.range(300).select(label("id").alias("label"), (F.col("id") % 2).cast("int").alias("fold"),
                                   (F.col("id") % 7).cast("double").alias("told"), (F.col("id") % 5).cast("double").alias("a"),
                                   (F.col("id") % 3).cast("double").alias("b"))
    best, scores = select_features_with_rfe(rows, "label", ["a", "told", "b"], min_features_to_select=1, num_trees=3)
    assert best == ["told"] and [len(s) for s in scores] == [3, 2, 1] and scores[("told",)] == 1.0
    assert seen.value <= 2 * 300  # one pass may count the rows
    assert not os.listdir(tmp_path)
