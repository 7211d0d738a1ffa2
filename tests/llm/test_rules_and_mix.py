import itertools
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from riskloom.llm import classifier, mixing, quality_rules, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {p for i, g in enumerate(zip(words, words[1:], words[2:], strict=False)) if grams[g] > 1 for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_base_counts(odd_docs):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality_rules.judge(odd_docs).collect())
    want = Counter()
    for r in odd_docs.collect():
        b = brute_base(r.text or "")
        want[(r.doc_id, *b, b[0] < 50 or 100 * b[4] > 50 * b[0])] += 1
    assert got == want


def test_rules_of_nothing(no_docs):
    assert quality_rules.judge(no_docs).collect() == [] and quality_rules.clean(no_docs).collect() == []


LEGAL = "All rights reserved " + "and so on for a very long legal note " * 9


@pytest.fixture(scope="module")
def hosted(spark, docs):
    """One host whose 40 pages share a footer, one page that is footers, 30 copies of one page, and 40 pages whose
    longest line is one legal note."""
    rng = np.random.default_rng(0)
    line = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    footer, page = "Imprint  and 2024 TERMS of use", "\n".join(line(12) for _ in range(8))
    rows = [(i, "\n".join([line(30), line(40), footer.replace("2024", str(2000 + i))]), "h") for i in range(40)]
    rows.append((100, "\n".join([footer] * 20 + [line(13)]), "h"))
    rows += [(200 + i, page, "h") for i in range(30)]
    rows += [(400 + i, line(40) + "\n" + line(41) + "\n" + LEGAL, "h") for i in range(40)]
    rows += [(300 + i, line(60) + "\n" + footer, "other") for i in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_common_lines_go_and_copies_stay(hosted):
    got = {r.doc_id: r for r in quality_rules.judge(hosted).collect()}
    assert all(got[i].n_common_words == 6 and got[i].kept for i in range(40))
    assert not got[100].kept and got[100].n_common_words == 120
    assert all(got[i].n_common_words == 0 and got[i].kept for i in [*range(200, 230), *range(300, 305)])
    assert all(got[i].n_common_words == len(LEGAL.split()) and got[i].kept for i in range(400, 440))
    texts = {r.doc_id: r.text for r in quality_rules.clean(hosted).collect()}
    assert set(texts) == set(got) - {100} and not any("Imprint" in texts[i] for i in range(40))
    assert all("Imprint" in texts[i] for i in range(300, 305))


def test_rules_equal_the_sql(hosted):
    con = duckdb.connect()
    con.register("documents", hosted.toPandas())
    got = quality_rules.judge(hosted).drop("tk").toPandas().sort_values("doc_id")
    want = con.sql(quality_rules.judge_sql()).df().sort_values("doc_id")
    assert got.values.tolist() == want[list(got.columns)].values.tolist()


def test_clean_keeps_other_columns(odd_docs):
    out = quality_rules.clean(odd_docs, min_words=0)
    assert out.columns == odd_docs.columns and out.count() > 0


# --- classifier ----------------------------------------------------------------------------


def test_ranking_learns_held_out_preferences(spark, docs):
    rng = np.random.default_rng(4)
    line = lambda n, vocabulary: " ".join(rng.choice(vocabulary, n))
    good = [line(80, ["the", "river", "Berlin", "goes,", "slowly.", "and", "house", "over"]) for _ in range(150)]
    bad = [line(60, ["BUY!!", "NOW", "||", "###", "$$$", "x"]) for _ in range(60)]
    rows = [(i, t, int(i < 150)) for i, t in enumerate([*good, *bad])] + [(900, None, None), (901, "", None), (None, "x", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    train = frame.where("doc_id % 3 > 0")
    ranking = classifier.fit_on(train.drop("quality"), train.select("doc_id", "quality"))
    out = classifier.score_documents(frame, ranking)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == 213 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [i for i in range(210) if i % 3 == 0]
    assert np.mean([got[i].predicted == int(i < 150) for i in held]) > 0.95
    assert min(got[i].score for i in held if i < 150) > max(got[i].score for i in held if i >= 150)


def test_ranking_without_pairs_scores_the_cut(spark, docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (3, None)], "doc_id long, quality int")
    ranking = classifier.fit_on(docs, labels)
    assert {(round(r.score, 9), r.predicted) for r in classifier.score_documents(docs, ranking).collect()} <= {(0.3, 1), (0.3, 0)}
    assert classifier.score_documents(no_docs, ranking).collect() == []


def test_features_see_the_whole_text():
    text = b"word " * 5000
    assert len(classifier.features(text)) == classifier.FEATURES == len(classifier.features(b"")) == len(classifier.features(b" \n"))
    assert classifier.features(text) != classifier.features(text + b"END###")


# --- sharding ------------------------------------------------------------------------------


@pytest.mark.parametrize("n,slots", [(1, 2), (3, 7), (16, 1009), (128, 65_537)])
def test_table_is_even_and_moves_little(n, slots):
    names = [f"s{i}" for i in range(n)]
    table = sharding.lookup_table(names, slots)
    counts = Counter(table)
    assert len(counts) == n and max(counts.values()) - min(counts.values()) <= 1
    shuffled = names[::-1]
    assert [names[i] for i in table] == [shuffled[i] for i in sharding.lookup_table(shuffled, slots)]
    if n >= 16:
        fewer = sharding.lookup_table(names[:-1], slots)
        moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != n - 1)
        assert moved < 0.2 * slots


def test_bad_tables_are_refused():
    for names, slots in ((["a"], 8), ([], 7), (["a", "a"], 7), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(names, slots)


def test_every_row_is_placed_by_the_table(odd_docs, no_docs):
    names = ["x", "y", "z"]
    table = sharding.lookup_table(names, 101)
    out = sharding.assign_shards(odd_docs, names, 101)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(r.shard == names[table[r.slot]] for r in rows)
    assert "shard" in out.columns and len(set(out.columns)) == len(out.columns)
    assert sharding.assign_shards(no_docs, names, 101).collect() == []


def test_slots_are_claimed_in_turns():
    import xxhash

    names, slots = ["b", "a", "c"], 31
    wish = {n: [(xxhash.xxh64_intdigest(n, 1) + k * (xxhash.xxh64_intdigest(n, 2) % (slots - 1) + 1)) % slots
                for k in range(slots)] for n in names}
    owner = {}
    for turn in range(slots):
        n = sorted(names)[turn % 3]
        owner[next(x for x in wish[n] if x not in owner)] = n
    assert [names[i] for i in sharding.lookup_table(names, slots)] == [owner[k] for k in range(slots)]


def test_columns_of_any_name_are_placed(spark):
    frame = spark.createDataFrame([(1, 2, "x", {"k": 1}), (None, 3, "y", None)],
                                  "doc_id long, _slot int, _shard string, `row.a` map<string, int>")
    rows = sharding.assign_shards(frame, ["x", "y"], 101).collect()
    assert sorted((r._slot, r._shard, r["row.a"]) for r in rows) == [(2, "x", {"k": 1}), (3, "y", None)]


def test_null_ids_are_written_by_many_tasks(spark, tmp_path):
    frame = spark.createDataFrame([(None, f"t{i}") for i in range(400)], "doc_id long, text string")
    sharding.write_shards(frame, f"{tmp_path}/s", ["x", "y"], 101, rows_per_file=25)
    back = spark.read.parquet(f"{tmp_path}/s")
    # eight (shard, part) groups, of which some may fall to one task by their hashes
    assert back.count() == 400 and len(back.inputFiles()) >= 4


def test_shards_are_written_apart(spark, odd_docs, tmp_path):
    sharding.write_shards(odd_docs, f"{tmp_path}/s", ["x", "y"], 101)
    assert spark.read.parquet(f"{tmp_path}/s").count() == odd_docs.count()


def test_the_query_writes_whole_documents_and_reads_their_places(spark, docs, monkeypatch, tmp_path):
    from riskloom.llm import catalog

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(catalog, "store_path", lambda _, name: f"{tmp_path}/out")
    got = catalog.op5_sharding(spark, str(tmp_path)).collect()
    names = catalog.SHARDS
    table = sharding.lookup_table(names, 65_537)
    assert len(got) == docs.count() and all(r.shard == names[table[r.slot]] for r in got)
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert set(stored.columns) == {*docs.columns, "slot", "shard"}
    assert sorted(map(str, stored.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))


# --- mixing --------------------------------------------------------------------------------


def test_targets_fill_by_weight_below_the_cap():
    got = mixing.targets([100, 10, 1000], [1, 2, 3], 1110, 3)
    assert got == [270.0, 30.0, 810.0]
    assert mixing.targets([0, 0], [1, 2], 0, 3) == [0, 0] and mixing.targets([], [], 0, 3) == []


def cost(patterns, given, repeats):
    total = 0
    for (_, size), share in zip(patterns, given, strict=True):
        taken = sum(share.values())
        assert taken <= repeats * size
        total += sum(min(size, max(0, taken - k * size)) * (k + 1) for k in range(repeats))
    return total


def test_flow_is_the_cheapest():
    patterns, quotas = [((0,), 2), ((0, 1), 2), ((1,), 1)], [4, 3]
    given = mixing.route(patterns, quotas, 3)
    assert [sum(g.get(s, 0) for g in given) for s in (0, 1)] == quotas
    best = None
    for a, b0, b1, c in itertools.product(range(7), range(7), range(7), range(4)):
        if a + b0 == 4 and b1 + c == 3 and b0 + b1 <= 6:
            value = cost(patterns, [{0: a}, {0: b0, 1: b1}, {1: c}], 3)
            best = value if best is None else min(best, value)
    assert cost(patterns, given, 3) == best


@pytest.mark.parametrize("per", [20_000, 3])
def test_mix_meets_targets(odd_docs, per):
    got = mixing.mix(odd_docs, rows_per_bucket=per).collect()
    again = mixing.mix(odd_docs.repartition(3), rows_per_bucket=per).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == odd_docs.count()
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    by_target = defaultdict(int)
    for r in got:
        by_target[(r.source_size, r.target)] += r.taken
    assert all(abs(taken - target) <= 0.5 for (_, target), taken in by_target.items())
    assert sum(t for _, t in by_target) == pytest.approx(sum(r.size for r in got))


def test_mix_equals_the_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas())
    got = mixing.mix(docs).toPandas().sort_values("doc_id")
    want = con.sql(mixing.mix_sql()).df().sort_values("doc_id")
    assert got.values.tolist() == want[list(got.columns)].values.tolist()


def test_mix_of_overlapping_sources(spark, docs):
    rows = [(i, "w " * 10, [["a"], ["a", "b"], ["b", "a", "a"], [None], [], None][i % 6]) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = mixing.mix(frame, total=300).collect()
    assert len(got) == 60 and sum(r.taken for r in got) == 300
    # the bound is on the two patterns of the overlapping sources, not on all three
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(frame, total=300, max_patterns=2).collect()))
    with pytest.raises(ValueError):
        mixing.mix(frame, max_patterns=1)


def test_any_number_of_sources_without_overlaps(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 40:02}" if i % 11 else None) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(map(str, mixing.mix(frame, max_patterns=0).collect())) == sorted(map(str, mixing.mix(frame).collect()))


def test_targets_of_a_table_equal_those_of_a_list(spark):
    sizes, weights = [0, 1, 5, 10, 400, 800], [1.0, 2.0, 3.0, 1.0, 2.0, 3.0]
    frame = spark.createDataFrame([(i, s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "i int, own long, weight double")
    for total in (0, 100, 1216, 3648, 5000):
        got = [r.target for r in mixing.source_targets(frame, total, 3).sort("i").collect()]
        assert got == mixing.targets(sizes, weights, total, 3)


def test_sources_are_ranked_in_code_point_order(spark):
    names = ["b", None, "a", "", "\uffee", "\U0001f600", "Z"]
    got = mixing.ranked(spark.createDataFrame([(n,) for n in names], "source string")).sort("rank").collect()
    assert [r.source for r in got] == ["", "Z", "a", "b", "\uffee", "\U0001f600", None]


def test_mix_of_nothing(no_docs):
    assert mixing.mix(no_docs).collect() == []
