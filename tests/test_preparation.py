"""Preparation of model rows: medians near a bracket, one rank for split and folds, no tables left over."""

import os

import numpy as np
from pyspark.sql import functions as F

from riskloom import config, session, workflow
from riskloom.operators.split import stratified_folds, stratified_split, stratified_split_folds
from riskloom.plans import quantiles
from riskloom.plans.quantiles import exact_median


def test_medians_of_large_tables_stack_few_rows(spark, monkeypatch):
    """Ties, nulls, NaN, infinities and a column without values: as numpy's; only values near the median are stacked."""
    rng = np.random.default_rng(1)
    n = 4000
    cols = {"even": rng.normal(size=n), "tied": rng.integers(0, 3, n).astype(float), "same": np.full(n, 7.0),
            "wild": np.where(rng.random(n) < 0.3, np.inf, rng.normal(size=n)), "gaps": rng.random(n)}
    rows = [(*(float(v[i]) for v in cols.values()), None, float("nan") if i % 7 else float(i)) for i in range(n)]
    rows = [(*r[:4], None if i % 3 == 0 else r[4], *r[5:]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in (*cols, "none", "nans"))).repartition(3)
    expected = {c: float(np.median(v)) for c, v in cols.items() if c != "gaps"}
    expected["gaps"] = float(np.median([r[4] for r in rows if r[4] is not None]))
    expected["nans"] = float(np.median([i for i in range(n) if i % 7 == 0]))
    monkeypatch.setattr(quantiles, "quantile_table", None)  # the way that stacks every value of every row
    found = exact_median(df, [*cols, "none", "nans"], rows_per_bucket=16)
    assert found == expected


def test_a_missed_bracket_is_found_again(spark, monkeypatch):
    """A sample that doesn't bracket the median changes the work, not the result."""
    monkeypatch.setattr(quantiles, "SAMPLE", 3)
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    assert exact_median(df, ["v"], rows_per_bucket=100) == {"v": 500.0}


def test_split_and_folds_follow_from_one_rank(spark):
    df = spark.range(500).select("id", (F.col("id") % 3 == 0).cast("double").alias("label"))
    both = stratified_split_folds(df, "label", ["id"], rows_per_bucket=64)
    apart = stratified_folds(stratified_split(df, "label", ["id"]), "label", ["id"])
    key = lambda d: sorted(tuple(r) for r in d.select("id", "split", "fold").collect())
    assert key(both) == key(apart)


def test_only_the_encoded_rows_of_a_large_table_stay(spark, monkeypatch, tmp_path):
    """Between its steps the preparation keeps no checkpoint and no table."""
    monkeypatch.setattr(config, "ROWS_PER_BUCKET", 100)
    monkeypatch.setattr(workflow, "cut_lineage", None)
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    rows = [(float(i % 40 + 30), None if i % 9 == 0 else float(i % 17), "Yes" if i % 2 else "No", "Yes" if i % 5 == 0 else "No")
            for i in range(300)]
    df = spark.createDataFrame(rows, "age double, bmi double, smoking string, heart_disease_status string")
    p = workflow.prepare(df)
    assert set(os.listdir(tmp_path)) == {os.path.basename(x.written_path) for x in (p.train, p.test)}
    assert p.train.count() + p.test.count() == df.distinct().count() and config.ROWS_PER_FILE > 300


def test_medians_of_more_rows_than_a_sample_are_bracketed(spark, monkeypatch):
    """A table of fewer rows than a bucket, but more than the sample, does not stack its values either."""
    monkeypatch.setattr(quantiles, "SAMPLE", 1000)
    monkeypatch.setattr(quantiles, "quantile_table", None)
    rows = spark.range(1001).selectExpr("cast(id * 5 % 1001 as double) AS v", "cast(id % 2 as double) AS w")
    assert exact_median(rows, ["v", "w"]) == {"v": 500.0, "w": 0.0}
