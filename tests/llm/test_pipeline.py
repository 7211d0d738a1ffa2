import corpus_pipeline
from riskloom.llm import simhash


def test_stages_follow_the_contract(spark, odd_docs, no_docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == odd_docs.columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, "").collect() == []


def test_near_duplicates_leave_one_of_each_group(spark, docs):
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    groups = {r.component_id for r in simhash.simhash_components(docs).collect()}
    assert sorted(r.doc_id for r in kept) == sorted(groups)


def test_near_duplicates_keep_unlinked_rows_of_one_id_and_of_none(spark, docs):
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abxy"}
    rows = [(3, text["a"], "s"), (5, text["a"], "s"), (5, text["b"], "s"), (None, text["a"], "s"), (None, text["x"], "s"),
            (None, text["x"], "s"), (None, text["x"], None), (None, text["y"], "s")]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "")
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, text["x"]), (0, text["y"]), (3, text["a"]), (5, text["b"])]


def test_repeated_passages_leave_other_texts_as_they_are(spark, docs):
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    assert set(before) == set(after) and any(before[k] == after[k] for k in before) and any(before[k] != after[k] for k in before)


def test_mixture_repeats_rows_as_taken(spark, docs):
    from riskloom.llm import mixing

    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    got = {}
    for r in corpus_pipeline.mixture(spark, docs, "").collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len((r.text or "").encode().split())
    assert got == {k: v for k, v in taken.items() if v}


NAMES = ["_shard", "_slot", "_key", "_tk", "_common", "_taken", "_size", "_pass", "row", "taken", "size", "pass", "other", "common", "host"]


def test_stages_keep_columns_of_any_name(spark, docs):
    """Columns that bear names used inside come back with their own values."""
    import pyspark.sql.functions as F

    named = docs.select("doc_id", "text", "source", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in NAMES))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, named, "")
        assert out.columns == named.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in NAMES)


def test_mixture_takes_the_same_one_of_equal_rows(spark, docs):
    import pyspark.sql.functions as F

    twice = docs.unionByName(docs.withColumn("key", F.lit("z")))
    runs = [sorted(map(str, corpus_pipeline.mixture(spark, twice.repartition(n), "").collect())) for n in (1, 6)]
    assert runs[0] == runs[1]
