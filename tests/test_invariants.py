"""Invariants for splits, folds, balance, weights and the scalable plans."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import balance as BA
from riskloom.operators import split as SP
from riskloom.plans.running import exact_rank, running_totals

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return (spark.read.parquet(f"{SF}/events.parquet")
            .withColumn("label", (F.col("event_type") == "purchase").cast("int")))


def test_split_exact_and_disjoint(events):
    out = SP.stratified_split(events, "label", ["event_id"], 0.2).cache()
    counts = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    for lab in (0, 1):
        n = counts[(lab, "test")] + counts[(lab, "train")]
        assert counts[(lab, "test")] == -(-2 * n // 10)  # ceil(0.2 n)
    assert out.count() == events.count() == out.select("event_id").distinct().count()


def test_split_same_rows_under_other_partitioning(spark, events):
    a = {r.event_id for r in SP.stratified_split(events, "label", ["event_id"]).where("split='test'").collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = {r.event_id for r in SP.stratified_split(events.repartition(5), "label", ["event_id"],
                                                     rows_per_bucket=37).where("split='test'").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_folds_balanced_within_one(events):
    out = SP.stratified_folds(events, "label", ["event_id"], 5)
    for lab in (0, 1):
        sizes = [r["count"] for r in out.where(F.col("label") == lab).groupBy("fold").count().collect()]
        assert max(sizes) - min(sizes) <= 1 and len(sizes) == 5


def test_bucketed_running_totals_equal_single_bucket(spark, events):
    spec = [("value", False), ("event_id", True)]
    one = exact_rank(events, ["label"], spec, rows_per_bucket=10**9)
    many = exact_rank(events, ["label"], spec, rows_per_bucket=50)
    a = {r.event_id: r["rank"] for r in one.collect()}
    b = {r.event_id: r["rank"] for r in many.collect()}
    assert a == b
    s = running_totals(events, [], [("event_id", True)], {"cum": F.col("value")}, rows_per_bucket=64)
    rows = sorted((r.event_id, r.cum, r.value) for r in s.collect())
    acc = 0.0
    for _, cum, v in rows:
        acc += v
        assert cum == pytest.approx(acc)


def test_undersample_ratio(events):
    out = BA.undersample(events, "label", ["event_id"], 0.5)
    c = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert c[0] == int(c[1] / 0.5)


def test_cost_weights_mean_one(events):
    w = BA.cost_sensitive_weights(events, "label").agg(F.avg("weight")).first()[0]
    assert w == pytest.approx(1.0)


def test_smote_parity_and_between_minority_rows(spark):
    emb = (spark.read.parquet(f"{SF}/embeddings.parquet")
           .select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"),
                   (F.col("label") == 0).cast("int").alias("label")))
    out = BA.smote(emb, "label", "embedding", "vec_id", 5).cache()
    c = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert c[0] == c[1]
    syn = out.where("synthetic = 1").collect()
    minority = [r.embedding for r in emb.where("label = 1").collect()]
    lo = [min(v[i] for v in minority) for i in range(len(minority[0]))]
    hi = [max(v[i] for v in minority) for i in range(len(minority[0]))]
    for r in syn:
        assert all(lo[i] - 1e-9 <= x <= hi[i] + 1e-9 for i, x in enumerate(r.embedding))


@pytest.mark.parametrize("kind", ["constant", "text", "nulls", "nan"])
@pytest.mark.parametrize("asc", [True, False])
def test_ranks_of_an_order_that_the_first_column_does_not_split(spark, kind, asc):
    from riskloom.plans.running import bucketed, exact_rank

    lead = {"constant": lambda i: 1.0, "text": lambda i: "xyz"[i % 3], "nulls": lambda i: None if i % 2 else float(i),
            "nan": lambda i: None if i % 97 == 0 else float("nan") if i % 89 == 0 else float(i)}[kind]
    rows = [(i, lead(i), "ab"[i % 2]) for i in range(2000)]
    df = spark.createDataFrame(rows, f"id long, lead {'string' if kind == 'text' else 'double'}, cls string").repartition(6)
    order = [("lead", asc), ("id", not asc)]
    sizes = [r["count"] for r in bucketed(df, order, 10).groupBy("_bucket").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 400
    got = {(r.cls, r.rank): r.id for r in exact_rank(df, ["cls"], order, rows_per_bucket=200).collect()}

    def key(r):  # Spark's order: NULL, values, NaN
        v = r[1]
        return (0, 0) if v is None else (2, 0) if v != v else (1, v)

    for cls in "ab":
        mine = sorted((r for r in rows if r[2] == cls), key=lambda r: r[0], reverse=asc)
        mine.sort(key=key, reverse=not asc)
        assert [got[cls, i + 1] for i in range(len(mine))] == [r[0] for r in mine]
