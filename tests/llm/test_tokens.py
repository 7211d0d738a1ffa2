import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskloom.llm.packing import knapsack, pack_documents, patterns, plan, powers
from riskloom.llm.token_counts import PreTokens, token_counts
from riskloom.llm.token_store import read_shard, read_tokens, write_shard, write_tokens
from riskloom.llm.tokens import DocEncoder, byte_level, load

BYTES, WORDS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TEXT = st.text(alphabet=st.sampled_from("aZéÉßİıŁΣςſ'’.,;:!|)-_0²ªº\x1c\x85\xa0 \n\tÅ日🙂ʼ"), max_size=25) | st.sampled_from(
    ["<|endoftext|>", "<|ENDOFTEXT|> x", "a  <|endoftext|> \n", "don't 'S 'll"])


def ids_of(path, text, end=None):
    ids = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids if path else []
    return ids + ([end] if end is not None else [])


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT)
def test_words_give_the_ids_of_the_whole_text(a, b):
    enc = ENCODER
    assert enc.ids((a + b).encode()) == np.array(enc.tok.encode(a + b, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT)
def test_pre_tokens_give_the_count_of_the_whole_text(a, b):
    pieces, special = SPLIT.split(a + b)
    tok = load(BYTES)
    assert special + sum(len(tok.model.tokenize(byte_level(w))) for w in pieces) == len(tok.encode(a + b, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.builds(str.__add__, TEXT, TEXT) | st.sampled_from(["it&&& (a##) x_y- b'&", "\x0b é### \x00 '' a<| b|>"]), max_size=6),
       st.integers(0, 2), st.sampled_from([pa.string(), pa.large_string()]))
def test_columns_give_the_ids_of_the_whole_texts(texts, skip, kind):
    tok = ENCODER.tok
    column = pa.array([None] * skip + texts, kind).slice(skip)
    assert ENCODER.all(column) == [np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_new_words_of_a_column_go_to_the_library_together(monkeypatch):
    enc = DocEncoder(WORDS)
    names = [a + b + c for a in "abcdefgh" for b in "éaüo" for c in "klmnprst"]
    text = " ".join(names) + " " + " ".join(f"{w}&&&" for w in names)
    alone = []
    monkeypatch.setattr(DocEncoder, "whole", lambda self, raw: alone.append(raw) or np.array(
        self.tok.encode(raw.decode(), add_special_tokens=False).ids, "<u4").tobytes())
    assert enc.all(pa.array([text, text]))[1] == np.array(enc.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert alone == [b"&&&"] and len(enc) == len(names) + 1


ENCODER, SPLIT = DocEncoder(WORDS, room=5), PreTokens(BYTES)


@pytest.mark.parametrize("block_bytes", [1, 300, 1 << 25])
def test_counts_equal_the_library(spark, odd_docs, block_bytes):
    got = sorted(map(tuple, token_counts(odd_docs, BYTES, block_bytes=block_bytes).collect()), key=str)
    tok = Tokenizer.from_file(BYTES)
    want = [(r.doc_id, len((r.text or "").encode()), len(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in odd_docs.collect()]
    assert got == sorted(want, key=str)


def test_counts_of_nothing(no_docs):
    assert token_counts(no_docs, BYTES).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(100, 120), max_size=40), max_size=12),
       st.sampled_from([1, 3, 8, 64]), st.sampled_from([0.0, 50.0, 98.0, 100.0]))
def test_shards_round_trip(docs, block, percentile):
    raw = [np.array(d, "<u4").tobytes() for d in docs]
    ids, sizes = read_shard(write_shard(raw, block, percentile))
    assert ids.tobytes() == b"".join(raw) and sizes.tolist() == [len(d) for d in docs]


def test_outliers_are_patched_not_widened():
    doc = np.r_[np.arange(1000) % 200, [2**31]].astype("<u4").tobytes()
    payload = write_shard([doc], 1024, 98.0)
    assert len(payload) < 1200 and read_shard(payload)[0].tobytes() == doc


def test_store_holds_all_documents_in_order(spark, odd_docs, tmp_path):
    path = write_tokens(odd_docs, f"{tmp_path}/t", WORDS, 2, shard_ids=700, block=64)
    got = [tuple(r) for r in read_tokens(spark, path).orderBy("start").collect()]
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    want, start, tok = [], 0, Tokenizer.from_file(WORDS)
    for r in rows:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_store_of_nothing(spark, no_docs, tmp_path):
    assert read_tokens(spark, write_tokens(no_docs, f"{tmp_path}/t", WORDS, 2)).collect() == []


def check_pack(docs, pieces, capacity):
    tok = Tokenizer.from_file(WORDS)
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(tok.encode(r.text or "", add_special_tokens=False).ids + [1])
    of_doc, of_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        of_doc[p.doc_id].append(p)
        of_seq[p.sequence_id].append((p.offset, p.length))
    assert set(of_doc) == set(want)
    for doc, texts in want.items():
        parts = of_doc[doc]
        assert sum(p.length for p in parts) == sum(map(len, texts))
        cover = sorted((p.doc_tokens, p.start, p.length, p.ids_crc32) for p in parts)
        known = {(len(t), p.start, p.length, zlib.crc32(np.array(t[p.start:p.start + p.length], "<u4").tobytes()))
                 for t in texts for p in parts if p.doc_tokens == len(t)}
        assert set(cover) <= known
    padding = 0
    for parts in of_seq.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
        padding += 0 if end & (end - 1) == 0 else capacity - end
    return padding / max(1, sum(p.length for p in pieces))


@pytest.mark.parametrize("capacity,per", [(2048, 50_000), (128, 7)])
def test_packing_covers_every_id_once(odd_docs, capacity, per):
    pieces = pack_documents(odd_docs, WORDS, capacity=capacity, width=8, rows_per_bucket=per).collect()
    assert check_pack(odd_docs, pieces, capacity) < 0.1


def test_packing_nothing(no_docs):
    assert pack_documents(no_docs, WORDS).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(0, 2), min_size=1, max_size=9), st.integers(1, 24))
def test_knapsack_is_optimal(value, units):
    best = [0.0] * (units + 1)
    for u in range(1, units + 1):
        best[u] = max([best[u - 1], *(v + best[u - s] for s, v in enumerate(value, 1) if s <= u)])
    worth, counts = knapsack(np.array(value), units)
    assert worth == pytest.approx(best[units])
    assert sum((i + 1) * c for i, c in enumerate(counts)) <= units
    assert sum(v * c for v, c in zip(value, counts, strict=True)) == pytest.approx(best[units])


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 500), max_size=20))
def test_plan_deals_every_rest(histogram):
    where = plan(histogram, 32, 0.98)
    used = defaultdict(int)
    for c in histogram:
        assert 0 <= where.alone[c] <= histogram[c]
        for rank in range(where.alone[c]):
            j = int(np.searchsorted(where.first[c], rank, "right")) - 1
            used[int(where.sequence[c][j]) + (rank - int(where.first[c][j])) // int(where.per[c][j])] += c
    assert all(u <= 32 for u in used.values())


def test_program_meets_the_known_bound():
    demand = np.zeros(100, dtype=np.int64)
    demand[[44, 35, 30, 13]] = [97, 610, 395, 211]  # a textbook instance; its optimum is 452.25
    rows, uses = patterns(demand, 100, gap=0.0)
    assert uses.sum() == pytest.approx(452.25, abs=0.5)
    assert np.allclose(uses @ rows, demand)


def test_powers():
    assert powers(1347) == [1024, 256, 64, 2, 1] and powers(0) == []
