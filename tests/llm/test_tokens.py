"""op4 and op7: round trips against the tokenizer itself."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_cases import corpus, documents  # noqa: F401

from gaugeflow.llm import bitplanes, packing, tokens
from gaugeflow.llm.common import ids_and_texts
from gaugeflow.llm.queries import vocabulary
from gaugeflow.session import fresh_dir


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_planes_round_trip(documents, corpus, tokenizer):
    found = bitplanes.token_ids(ids_and_texts(documents(corpus)), vocabulary(), block=1000)
    got = sorted(tuple(r) for r in found.collect())
    assert [r[0] for r in got] == sorted(i for i, _ in corpus)
    wanted = sorted(
        (i, crc(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in corpus
    )
    assert sorted((r[0], r[3]) for r in got) == wanted
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in by_start] == sorted(r[0] for r in by_start)
    ends = np.cumsum([r[2] for r in by_start]).tolist()
    assert [r[1] for r in by_start] == [0, *ends[:-1]]
    assert bitplanes.token_ids(ids_and_texts(documents([])), vocabulary()).count() == 0


def test_bit_planes_and_any_selection(spark, documents, corpus):
    docs = ids_and_texts(documents(corpus))
    folder = fresh_dir(spark, "bits")
    index = bitplanes.write_shards(docs, folder, vocabulary(), planes=32, block=64)
    placed = bitplanes.with_global_start(index)
    some = bitplanes.read_documents(placed.filter("doc_id % 7 = 3"), folder).collect()
    every = {tuple(r) for r in bitplanes.read_documents(placed, folder).collect()}
    assert some and {tuple(r) for r in some} <= every
    assert every == {tuple(r) for r in bitplanes.token_ids(docs, vocabulary()).collect()}


@pytest.mark.parametrize("planes", [4, 32])
def test_one_block(planes):
    ids = np.random.default_rng(3).integers(0, 1 << 32, 999, dtype=np.uint32)
    parts = list(bitplanes.planes_of(ids, planes))
    assert (bitplanes.ids_of(parts, len(ids)) == ids).all()


ENCODER = []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aBé'ñ.,-1 \n\t…É́'stıİ<|>", max_size=30), max_size=4))
def test_words_give_the_ids_of_the_whole_text(texts):
    from tokenizers import Tokenizer

    if not ENCODER:
        ENCODER.extend((tokens.WordEncoder(vocabulary(), 50), Tokenizer.from_file(vocabulary())))
    ids, counts = ENCODER[0].encode(pa.array(texts, pa.string()))
    wanted = [ENCODER[1].encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in wanted]
    assert ids.tolist() == [i for w in wanted for i in w]


def test_long_texts_are_cut_at_spaces(monkeypatch, tokenizer):
    monkeypatch.setattr(tokens, "_PIECE_BYTES", 64)
    text = "some longer text\nwith " * 30 + "x" * 200 + " end"
    batch = pa.RecordBatch.from_arrays([pa.array([text, None, "a"])], ["text"])
    got = dict(tokens.WordEncoder(vocabulary()).encode_rows(batch))
    assert got[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(got[1]) == 0 and len(got[2]) == 1


def test_packing(documents, corpus, tokenizer):
    docs = ids_and_texts(documents(corpus))
    packed = packing.pack(docs, vocabulary(), capacity=256).toPandas()
    wanted = sorted(crc(tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for _, t in corpus)
    pieces = sorted(
        crc(ids[k : k + 256])
        for _, t in corpus
        for ids in [tokenizer.encode(t or "", add_special_tokens=False).ids + [0]]
        for k in range(0, len(ids), 256)
    )
    assert sorted(packed.ids_crc32) == pieces and len(wanted) == len(corpus)
    in_order = packed.sort_values(["sequence_id", "offset"])
    before = in_order.groupby("sequence_id").length.cumsum() - in_order.length
    assert (before == in_order.offset).all()
    assert in_order.groupby("sequence_id").length.sum().max() <= 256
    counts = np.bincount(packed.length, minlength=257)
    alone = sum(n for _, n in packing.best_fit(counts))
    assert packed.sequence_id.nunique() <= alone + 1
    assert packing.pack(ids_and_texts(documents([])), vocabulary()).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=300))
def test_plan_uses_each_length_once(lengths):
    counts = np.bincount(lengths, minlength=65)
    plan = packing.plan_sequences(counts)
    used = np.zeros(65, int)
    for pattern, times in plan:
        assert times > 0 and sum(pattern) <= 64
        for length in pattern:
            used[length] += times
    assert (used == counts).all()


def test_empty_pieces_without_end_id(documents):
    packed = packing.pack(ids_and_texts(documents([(1, None), (2, "a b")])), vocabulary(), end_id=None)
    assert {r.doc_id: r.sequence_id for r in packed.collect()} == {1: None, 2: 0}


def test_sequences(spark, documents):
    docs = ids_and_texts(documents([(1, "a b c"), (2, "d e")]))
    packed = packing.pack(docs, vocabulary(), capacity=8)
    made = packing.sequence_ids(docs, packed, vocabulary(), 0).collect()
    assert sum(len(r.ids) for r in made) == 7


def test_new_words_of_a_batch_are_stored_at_once(monkeypatch):
    calls = []
    add = tokens.WordEncoder._add
    monkeypatch.setattr(
        tokens.WordEncoder, "_add", lambda self, words: calls.append(words) or add(self, words)
    )
    text = " ".join(f"wörd{n} Word{n}, x{n}" for n in range(3000))
    for cached in (0, 7, 100_000):
        calls.clear()
        encoder = tokens.WordEncoder(vocabulary(), cached)
        for _ in range(2):
            ids, counts = encoder.encode(pa.array([text, None, "", "Word1, word1"]))
            whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
            last = encoder.tokenizer.encode("Word1, word1", add_special_tokens=False).ids
            assert ids.tolist() == whole + last
            assert counts.tolist() == [len(whole), 0, 0, len(last)]
        assert len(calls) == 2 and len(calls[0]) > 9000
        assert encoder.n_slots == len(encoder.slot) <= cached
