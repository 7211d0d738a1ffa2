"""Best-fit packing, phrase collocations and conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import bestfit, catalog, collocations, repair
from riskloom.llm.tokens import DocEncoder

from .test_tokens import ids_of

WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- best-fit packing -----------------------------------------------------------------------


def single_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if not fits:
            rooms.append(capacity)
            fits = [len(rooms) - 1]
        rooms[min(fits, key=lambda i: rooms[i])] -= n
    return rooms


def fewest(lengths, capacity):
    """The least number of sequences, by trying every assignment."""
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {rooms[k]: k for k in range(len(rooms)) if rooms[k] >= lengths[i]}.values():
            go(i + 1, [r - lengths[i] * (j == k) for j, r in enumerate(rooms)])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best


def occupied(where, histogram):
    """sequence -> its pieces (offset, length), by the plan."""
    out = defaultdict(list)
    for length, n in histogram.items():
        sequence, offset = where.slots(np.full(n, length, np.int64), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            out[s].append((o, length))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_plan_over_counts_equals_best_fit_over_pieces(lengths):
    histogram = Counter(lengths)
    where = bestfit.plan(histogram, 20)
    held = occupied(where, histogram)
    assert where.sequences == len(held) == len(single_best_fit(lengths, 20))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
def test_plan_is_close_to_the_fewest(lengths):
    n = bestfit.plan(Counter(lengths), 12).sequences
    assert fewest(sorted(lengths, reverse=True), 12) <= n <= fewest(sorted(lengths, reverse=True), 12) * 11 / 9 + 6 / 9


def test_large_counts_are_planned_at_once():
    histogram = {n: 10**9 + n for n in range(1, 4097)}
    where = bestfit.plan(histogram, 4096)
    least = sum(n * c for n, c in histogram.items()) / 4096
    assert least <= where.sequences < 1.01 * least and len(where.key) < 20_000


def check_pieces(pieces, rows, capacity):
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        of_doc[p.doc_id].append(p)
        of_sequence[p.sequence_id].append(p)
    for held in of_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= capacity
    wanted = defaultdict(Counter)
    for r in rows:
        ids = ids_of(WORDS, r.text, 1)
        for k, start in enumerate(range(0, len(ids), capacity)):
            cut = np.array(ids[start:start + capacity], "<u4").tobytes()
            wanted[r.doc_id][(k, start, len(cut) // 4, cut)] += 1
    assert {d: Counter((p.piece, p.start, p.length, bytes(p.ids)) for p in ps) for d, ps in of_doc.items()} == wanted
    return of_sequence


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pieces_cover_all_documents(odd_docs, capacity):
    pieces = bestfit.pack_best_fit(odd_docs, WORDS, capacity=capacity)
    got = pieces.collect()
    held = check_pieces(got, odd_docs.collect(), capacity)
    assert len(held) == len(single_best_fit([p.length for p in got], capacity))
    whole = {r.sequence_id: (r.n_ids, bytes(r.ids)) for r in bestfit.sequences(pieces).collect()}
    assert whole == {s: (sum(p.length for p in ps), b"".join(bytes(p.ids) for p in sorted(ps, key=lambda p: p.offset)))
                     for s, ps in held.items()}


def test_nothing_is_packed_from_nothing(no_docs):
    assert bestfit.pack_best_fit(no_docs, WORDS).collect() == []


def test_the_packing_query(spark, odd_docs, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.QUERIES["op11_best_fit_packing"](spark, str(tmp_path)).collect()
    enc = DocEncoder(WORDS)
    want = Counter()
    for r in odd_docs.collect():
        ids = enc.ids((r.text or "").encode()) + np.array([1], "<u4").tobytes()
        for k in range(0, len(ids) // 4, 4096):
            cut = ids[4 * k:4 * (k + 4096)]
            want[(r.doc_id, k // 4096, k, len(cut) // 4, zlib.crc32(cut))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert dict(catalog.QUERIES["op11_best_fit_packing"](spark, str(tmp_path)).dtypes)["piece"] == "int"


# --- collocations ---------------------------------------------------------------------------


def brute_collocations(rows, min_count=10, top=2000, max_words=3, percent=50):
    f, n = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    f[(lang, tuple(words[i:i + k]))] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    out = defaultdict(list)
    for (lang, p), a in candidates.items():
        inside = [b for (o, q), b in candidates.items() if o == lang and len(q) > len(p)
                  and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= percent * a for b in inside):
            continue
        cuts = [(int(Fraction(10**6 * a * a, f[(lang, p[:k])] * f[(lang, p[k:])]).__floor__()), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[(lang, p[:k])], f[(lang, p[k:])]))
    return {(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
            for lang, xs in out.items() for i, x in enumerate(sorted(xs)[:top])}


@pytest.fixture(scope="module")
def phrases(spark):
    rng = random.Random(11)
    vocabulary = ["The", "cat", "sat", "ÉTÉ", "über", "x-1", "日本", "a\x1cb", "b", "c", "d", "no\xa0break"]
    rows = []
    for i in range(300):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\n", " \t ", "\x0b"]) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            words += ["new", "york", "city"]
        if i % 7 == 0:
            words += ["new", "york"]
        rows.append((i if i % 50 else None, " ".join(words), [None, "en", "en", "und", "fr"][i % 5], "k"))
    rows += [(7, None, "en", "k"), (8, "", "de", "k"), (9, " \t\n", "de", "k"), rows[1], rows[1]]
    rows += [(1000 + i, "one common passage of words", "en", "k") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, h string").repartition(7)


@pytest.mark.parametrize("options", [{"shards": 7, "filter_bits": 1 << 16}, {"top": 5, "rank_buckets": 3}, {"min_count": 31}])
def test_collocations_equal_brute_force(phrases, options):
    got = {tuple(r) for r in collocations.collocations(phrases, **options).collect()}
    want = brute_collocations([(r.lang, r.text) for r in phrases.collect()], options.get("min_count", 10), options.get("top", 2000))
    assert got == want and len(got) >= 5


def test_collocations_of_four_words(phrases):
    got = {tuple(r) for r in collocations.collocations(phrases, max_words=4).collect()}
    assert got == brute_collocations([(r.lang, r.text) for r in phrases.collect()], max_words=4)


def test_collocations_equal_the_sql(phrases):
    documents = phrases.toPandas()  # noqa: F841 - read by DuckDB
    want = duckdb.sql(collocations.collocations_sql()).fetchall()
    assert {tuple(r) for r in collocations.collocations(phrases).collect()} == set(want) and want


def test_only_mined_candidates_are_counted(phrases, monkeypatch):
    monkeypatch.setattr(collocations, "bloom", lambda hashes, bits: bytes(bits // 8))
    assert collocations.collocations(phrases).collect() == []


def test_long_texts_are_read_in_blocks(spark, monkeypatch):
    text = "new york city is big. " * 3000 + "é" * 500 + " " + "x y " * 9000
    rows = spark.createDataFrame([(1, text, "en", 3), (2, "new york", "en", 3)], "doc_id long, text string, lang string, shard int")
    batches = list(collocations.blocks(iter(rows.select("lang", "shard", "text").toArrow().to_batches()), max_bytes=1000))
    assert b"".join(x for texts, _, _ in batches for x in texts) == text.encode() + b"new york" and len(batches) > 50
    got = {tuple(r) for r in collocations.collocations(rows).collect()}
    assert got == brute_collocations([("en", text), ("en", "new york")])


def test_collocations_of_nothing(no_docs):
    assert collocations.collocations(no_docs).collect() == []


# --- conversation repair --------------------------------------------------------------------

BLANK = " \t\n\x0b\x0c\r"


def brute_faults(rows):
    """Rows (turn, role, text) in order, each with its first fault."""
    out, seen = [], set()
    for turn, role, text in rows:
        if not text.strip(BLANK):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "truncated" if text.rstrip(BLANK)[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def brute_edits(rows, most_inserts):
    """(cost, audit, repaired) of the cheapest edits, by trying all of them."""
    best = None
    legal = re.compile("(s?(ua)+)?")
    choices = []
    for _, role, text, fault in rows:
        options = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            extra = 5 if fault == "truncated" else 0
            options += [(extra, "K", (role, text)), (1 + extra, "R", ("user", text)), (1 + extra, "R", ("assistant", text))]
        choices.append(options)
    inserts = [()] + [c for k in range(1, most_inserts + 1) for c in itertools.product(("user", "assistant"), repeat=k)]
    for picked in itertools.product(*choices):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            n = sum(map(len, gaps))
            if n > most_inserts:
                continue
            cost = sum(c for c, _, _ in picked) + 5 * n
            if best and cost > best[0]:
                continue
            audit, lines = "", []
            for k in range(len(rows) + 1):
                audit += "I" * len(gaps[k])
                lines += [(r, "") for r in gaps[k]]
                if k < len(rows):
                    audit += picked[k][1]
                    lines += [picked[k][2]] if picked[k][2] else []
            if legal.fullmatch("".join(r[:1] or "-" for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in lines))
    return best


def brute_repair(rows):
    rows = brute_faults(rows)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults = Counter(f for *_, f in rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, text = brute_edits(rows, 1) if rows else (0, "", "")
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def sorted_rows(rows):
    """The operator's order: turn (nulls first), role, digest of the text."""
    clean = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(clean, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))


def random_conversations(n, seed):
    rng = random.Random(seed)
    out = {}
    for c in range(n):
        rows = []
        for k in range(rng.randint(1, 4)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice([f"Text {rng.randint(0, 3)}.", "Same.", "cut off", "done! \n", "Ende?\t", "", " \n", None, "日本", "e.."])
            rows.append((rng.choice([k, k, k, 2 * k, None]), role, text))
        if rng.random() < 0.3:
            rows.append(rows[-1])
        out[c if c else None] = rows
    return out


SCHEMA = "conv_id long, turn long, role string, text string, part string, later int, copies string"


def conversation_rows(spark, conversations):
    rows = [(c, t, r, x, "p", 1, "c") for c, rs in conversations.items() for t, r, x in rs]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_grammar_needs_four_stacks():
    table = repair.stacks()
    assert len(table.stacks) == 4 and [table.accepts(s) for s in table.stacks].count(True) == 2
    for roles in itertools.chain.from_iterable(itertools.product("sua", repeat=n) for n in range(7)):
        at = {0}
        for r in roles:
            at = {to for n in at for to in table.advance(n, r)}
        assert any(table.accepts(table.stacks[n]) for n in at) == bool(re.fullmatch("(s?(ua)+)?", "".join(roles)))


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_repair_equals_brute_force(spark, partitions):
    conversations = random_conversations(120, 2)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.conv_id: tuple(r)[1:] for r in repair.repair(conversation_rows(spark, conversations)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {c: brute_repair(sorted_rows(rows)) for c, rows in conversations.items()}


@pytest.mark.parametrize("room", [repair.TEXT_ROOM, 300])
def test_segments_of_any_size_give_the_same(spark, room):
    """One long conversation: cut anywhere, parsed as a whole, or from the stream of its rows."""
    rng = random.Random(4)
    rows = [(t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Yes.", "No", f"T{t}.", f"U{t}"])) for t in range(400)]

    def segments(cuts):
        seen, out, faults = set(), [], brute_faults(rows)
        for part, (a, b) in enumerate(itertools.pairwise([0, *cuts, len(rows)])):
            s = repair.Segment(9, part, True)
            s.room = room
            for turn, role, text, _ in faults[a:b]:
                s.add(turn, role, text.encode(), 1, (role, text) in seen)
                seen.add((role, text))
            out.append(s.result())
        return repair.joined(out)

    whole = segments([])
    for cuts in ([200], [1, 2, 3], [17, 90, 300, 399], list(range(1, 400, 7))):
        got = segments(cuts)
        assert {k: v for k, v in got.items() if k != "sha"} == {k: v for k, v in whole.items() if k != "sha"}
    frame = spark.createDataFrame([(9, t, r, x) for t, r, x in rows] + [(8, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in repair.repair(frame).collect()}
    assert found[9].audit == repair.audit(whole["ops"]) and found[9].cost == whole["cost"] and found[9].illegal == whole["illegal"]
    lines, ops = repair.Digest(), iter(whole["ops"])
    for _, role, text in rows:
        lines.edits(ops, role, text.encode())
    lines.rest(ops)
    assert found[9].repaired_sha256 == lines.sha.hexdigest() and (whole["sha"] is None) == (room == 300)


def test_repair_of_nothing(spark):
    assert repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out += [(conv, turn, "user" if lot == 4 else role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    return out


def test_the_repair_query(spark, tmp_path):
    conversations = {c: [(t, r, x) for t, (_, r, x) in enumerate(rows)] for c, rows in random_conversations(150, 8).items()}
    conversations[500] = [(None, None, None), (3, "user", "Hi.")]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    conversations[dropped] = [(0, "user", "Hi.")]
    frame = conversation_rows(spark, conversations)
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in catalog.QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    want = defaultdict(list, {c: [] for c in conversations})
    for conv, *row in brute_damage([(c, *r) for c, rows in conversations.items() for r in rows]):
        want[conv].append(row)
    assert got == {c: brute_repair(sorted_rows(rows)) for c, rows in want.items()}
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
