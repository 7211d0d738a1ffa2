import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import substring
from riskloom.llm.embeddings import SHAPE, embedding_components, sorted_links
from riskloom.llm.graph import connected_components
from riskloom.llm.simhash import fingerprint, shifts, simhash_components, simhash_links, tile_edges
from riskloom.llm.substring import chosen, remove_repeats


def brute_components(n, linked):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(n)]


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(odd_docs):
    got = sorted(map(tuple, simhash_components(odd_docs, tile=4).collect()), key=str)
    rows = odd_docs.collect()
    prints = [brute_print(r.text) for r in rows]
    root = brute_components(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    first = {c: min((r.doc_id for r, x in zip(rows, root, strict=True) if x == c and r.doc_id is not None), default=None) for c in set(root)}
    assert got == sorted(((r.doc_id, f"{p:016x}", first[c]) for r, p, c in zip(rows, prints, root, strict=True)), key=str)


def test_simhash_of_nothing(no_docs):
    assert simhash_components(no_docs).collect() == []


def test_fingerprint_of_a_long_text():
    text = " ".join(f"w{i}" for i in range(70_000)).encode()
    assert fingerprint(text) == brute_print(text.decode())


@pytest.mark.parametrize("tile", [2048, 3])
def test_links_connect_what_brute_force_connects(spark, docs, tile):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(6))]))
    signed = values.view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "print long")
    edges = simhash_links(prints, tile=tile).collect()
    at = {v: i for i, v in enumerate(signed)}
    pairs = {(at[e.a], at[e.b]) for e in edges}
    assert all((int(values[i]) ^ int(values[j])).bit_count() <= 64 for i, j in pairs)
    want = brute_components(len(values), lambda i, j: (int(values[i]) ^ int(values[j])).bit_count() <= 3)
    assert brute_components(len(values), lambda i, j: (i, j) in pairs or (j, i) in pairs) == want


def test_skipping_by_counts_allows_every_link():
    moves = {tuple(x) for x in shifts(3)}
    for bits in ([0, 1, 2], [0, 20, 63], [5], [], [17, 18]):
        a = 0x0123456789ABCDEF
        b = a
        for x in bits:
            b ^= 1 << x
        d = tuple((b >> 16 * k & 0xFFFF).bit_count() - (a >> 16 * k & 0xFFFF).bit_count() for k in range(4))
        assert d in moves or tuple(-x for x in d) in moves


def test_tile_edges_span_without_all_pairs():
    values = np.arange(8, dtype=np.uint64)  # all within 3 bits of each other
    a, b = tile_edges(values, values, 3)
    keep = a != b
    assert len({*a[keep].tolist(), *b[keep].tolist()}) == 8 and keep.sum() <= 16


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, x) for x in range(501, 540)] + [(7, 7), (9, 8), (8, 9), (-5, 9)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[x] for x in range(500, 540)} == {500}
    assert {got[x] for x in (8, 9, -5)} == {-5} and 7 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_repeats(rows, window):
    split = [((r.text or "").encode().split(), r.doc_id) for r in rows]
    first = {}
    for words, name in split:
        if name is not None:
            for i in range(len(words) - window + 1):
                g = tuple(words[i:i + window])
                first[g] = min(first.get(g, name), name)
    out = []
    for words, name in split:
        gone = set()
        if name is not None:
            for i in range(len(words) - window + 1):
                if first[tuple(words[i:i + window])] < name:
                    gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((name, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


@pytest.mark.parametrize("window,phrase,shard", [(50, 20, 10_000), (50, 20, 1), (6, 2, 5), (3, 3, 100)])
def test_repeats_equal_brute_force(odd_docs, window, phrase, shard):
    got = sorted(map(tuple, remove_repeats(odd_docs, window, phrase, shard).collect()), key=str)
    assert got == sorted(brute_repeats(odd_docs.collect(), window), key=str)


def test_repeats_return_texts_and_columns(docs):
    out = remove_repeats(docs, with_text=True, carry=docs.columns)
    for r in out.collect():
        words = (r.text or "").encode().split()
        assert len(words) == r.n_words - r.n_removed
        assert hashlib.sha256(b" ".join(words)).hexdigest() == r.kept_sha256 and r.carry.key == "k"


def test_automata_decide_what_goes(spark, monkeypatch):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(i, f"a{i} {passage} z{i}") for i in range(5)], "doc_id long, text string")
    removed = lambda: sorted(r.n_removed for r in remove_repeats(rows, shard_docs=2).collect())
    assert removed() == [0, 60, 60, 60, 60]
    # emptied automata find nothing, so nothing goes
    monkeypatch.setattr(substring, "_locate", lambda phrase, window: lambda batches: substring_none(batches))
    assert removed() == [0] * 5


def substring_none(batches):
    for _ in batches:
        yield substring.record(substring.FOUND, **{f.name: [] for f in substring.FOUND})


def test_phrases_are_located_by_their_words():
    vocabulary, automaton = substring.compiled([(7, b"a b c"), (8, b"b c d"), (9, b"c cc c")])
    words = b"x a b c d a bb c cc c".split()
    found = [(end - 2, gram) for end, gram in automaton.iter(tuple(vocabulary.get(w, 0) for w in words))]
    assert found == [(1, 7), (2, 8), (7, 9)]


def test_repeats_of_nothing(no_docs):
    assert remove_repeats(no_docs).collect() == []


def test_chosen_phrases_depend_on_the_window_alone():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 50, 300).astype(np.uint64), rng.integers(0, 50, 200).astype(np.uint64)
    b[60:100] = a[120:160]
    x, y = set(chosen(a, 9).tolist()), set(chosen(b, 9).tolist())
    for s in range(40 - 9 + 1):
        mine = {p - 120 - s for p in x if 120 + s <= p < 129 + s and a[p] == a[120 + s:129 + s].min()}
        assert mine and mine == {p - 60 - s for p in y if 60 + s <= p < 69 + s and b[p] == b[60 + s:69 + s].min()}


def vectors(seed=2, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((12, dim))
    out = []
    for k in range(260):
        v = base[k % 12] + rng.standard_normal(dim) * (0.02 if k % 5 else 0.2)
        out.append((k, [float(x) for x in v], k % 3 if k % 17 else None))
    out += [(300, None, 1), (301, [0.0] * dim, 1), (302, [float("nan")] * dim, 1), (303, [None] * dim, 1), (304, out[4][1], 1),
            (305, [2 * x for x in out[4][1]], 1), (306, [1.0, 2.0], 1), (307, [1.0, 2.0], 1), (308, [float("inf")] * dim, 1), (309, [], 1),
            (None, out[4][1], 1), (4, out[4][1], 1), (310, [1e200 * x for x in out[4][1]], 1)]
    return out


@pytest.mark.parametrize("window,passes,tile", [(64, 20, 1024), (4, 40, 5)])
def test_embeddings_equal_brute_force(spark, docs, window, passes, tile):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("x"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_components(frame, window=window, passes=passes, tile=tile).collect()}
    known = {}
    for name, v, label in rows:
        if name is not None:
            known.setdefault(name, (v, label))
    names = sorted(known)

    def usable(x):
        v, label = known[x]
        return label is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)

    def linked(i, j):
        x, y = names[i], names[j]
        if not usable(x) or not usable(y) or known[x][1] != known[y][1] or len(known[x][0]) != len(known[y][0]):
            return False
        a, b = (np.array(known[z][0]) / max(map(abs, known[z][0])) for z in (x, y))
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98

    root = brute_components(len(names), linked)
    for i, x in enumerate(names):
        n = sum(linked(i, j) for j in range(len(names)) if j != i)
        assert got[x] == (n, names[root[i]], root[i] == i), x
    assert got[None] == (0, None, True) and len(got) == len(names) + 1


def test_windows_go_on_across_ranges(spark, docs):
    """A chain in which only neighbours link stays one piece however many tasks sort it."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        chain = [(0, "a", 2, i.to_bytes(2, "big"), i, [float(np.cos(0.19 * i)), float(np.sin(0.19 * i))]) for i in range(30)]
        keyed = spark.createDataFrame(chain, SHAPE).repartition(3)
        assert keyed.repartitionByRange("key").select(F.spark_partition_id()).distinct().count() > 3
        pairs = {(min(r), max(r)) for r in sorted_links(keyed, 0.98, 2).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    root = brute_components(30, lambda i, j: (min(i, j), max(i, j)) in pairs)
    assert set(root) == {0}


def test_embeddings_away_from_the_origin(spark, docs):
    """Vectors whose mean cosine is 0.9: planes through the origin would hardly tell them apart."""
    rng = np.random.default_rng(5)
    dim, n = 32, 3000
    base = 3 * np.ones(dim) + rng.standard_normal((n, dim))
    base[n // 2:] = base[:n // 2] + 0.5 * rng.standard_normal((n // 2, dim))
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & ~np.eye(n, dtype=bool)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(base)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding_components(frame.repartition(8), tile=100, part=3).collect()}
    root = brute_components(n, lambda i, j: near[i, j])
    assert near.sum() > 2000 and np.mean([got[i].n_links == near[i].sum() for i in range(n)]) >= 0.999
    assert np.mean([got[i].component_id == root[i] for i in range(n)]) >= 0.999


def test_embeddings_of_nothing(spark, docs):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_components(empty).collect() == []
