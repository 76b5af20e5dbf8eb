"""op12: every id in one piece, full sequences, and the ids themselves."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_cases import corpus, documents  # noqa: F401

from gaugeflow.llm import windows
from gaugeflow.llm.queries import vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def unpadded(n: int, capacity: int) -> bool:
    return n == capacity or n & (n - 1) == 0


def check_sequences(pieces, capacity: int) -> None:
    by_sequence = defaultdict(list)
    for piece in pieces:
        by_sequence[piece.sequence_id].append((piece.offset, piece.length))
    lengths = []
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        lengths.append(at)
        assert at <= capacity and unpadded(at, capacity)
    short = [n for n in lengths if n < capacity]
    assert len(short) == len(set(short))


@pytest.mark.parametrize("capacity,most", [(2048, 32), (64, 4), (100, 1), (1, 3)])
def test_pieces_and_ids(spark, documents, corpus, tokenizer, capacity, most):
    if capacity == 1:
        corpus = [row for row in corpus if len(row[1] or "") < 300]
    docs = documents(corpus).repartition(3)
    found = windows.pack_online(docs, vocabulary(), capacity, 1, most, keep_ids=True).collect()
    check_sequences(found, capacity)
    ids = {}
    for doc_id, text in corpus:
        own = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        ids.setdefault(doc_id, []).append(own)
    by_doc = defaultdict(list)
    for piece in found:
        assert piece.ids_crc32 == crc(piece.ids) and piece.length == len(piece.ids)
        by_doc[piece.doc_id].append(piece)
    assert set(by_doc) == set(ids)
    for doc_id, pieces in by_doc.items():
        if len(ids[doc_id]) == 1:
            own = ids[doc_id][0]
            at = 0
            for piece in sorted(pieces, key=lambda p: p.start):
                assert piece.start == at and piece.doc_tokens == len(own)
                assert piece.ids == own[at : at + piece.length]
                at += piece.length
            assert at == len(own)
        else:
            assert sum(p.length for p in pieces) == sum(map(len, ids[doc_id]))


def test_padded_sequences(spark, documents, corpus):
    docs = documents(corpus)
    pieces = windows.pack_online(docs, vocabulary(), 100, 1, 4, keep_ids=True)
    kept = pieces.collect()
    made = windows.sequences(pieces, 100, pad_id=9).collect()
    assert sum(r.n_ids for r in made) == sum(p.length for p in kept)
    for row in made:
        whole = len(row.ids) == 100 or (len(row.ids) == row.n_ids and unpadded(row.n_ids, 100))
        assert whole and set(row.ids[row.n_ids :]) <= {9}


def test_without_an_end_id(spark, documents):
    rows = [(1, None), (2, ""), (3, "one"), (None, "two"), (None, "two")]
    found = windows.pack_online(documents(rows), vocabulary(), 8, None).collect()
    empty = [p for p in found if not p.length]
    assert sorted(p.doc_id for p in empty) == [1, 2]
    assert all(p.sequence_id is None and p.offset is None for p in empty)
    check_sequences([p for p in found if p.length], 8)
    assert windows.pack_online(documents([]), vocabulary()).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=30), st.integers(1, 64), st.integers(1, 5))
def test_open_windows(sizes, capacity, most):
    held = windows.OpenWindows(capacity, most)
    placed, at = [], 0
    for doc, size in enumerate(sizes):
        ids = np.arange(at, at + size)
        placed += [(p[2], p[4], p[5]) for p in held.add(doc, ids)]
        assert len(held.rooms) <= most
        at += size
    done = defaultdict(int)
    for ids, sequence, offset in placed:
        done[sequence] += len(ids)
    assert set(done.values()) <= {capacity}
    left, place = [], 0
    for piece in held.rest():
        assert piece[4] == place
        left.append(piece[2])
        place += len(piece[2])
    every = np.concatenate([np.zeros(0, int), *(p[0] for p in placed), *left])
    assert sorted(every.tolist()) == list(range(at))


@given(st.integers(0, 500), st.integers(1, 70), st.lists(st.integers(0, 500), max_size=6))
def test_cuts_of_what_is_left(total, capacity, edges):
    edges = sorted({0, total, *(e for e in edges if e < total)})
    seen = []
    for a, b in zip(edges, edges[1:], strict=False):
        parts = list(windows.cut_at(a, b, total, capacity))
        assert parts[0][0] == a and parts[-1][1] == b
        seen += parts
    by_sequence = defaultdict(list)
    for a, b, sequence, offset in seen:
        by_sequence[sequence].append((offset, b - a))
    for placed in by_sequence.values():
        ends = [offset + n for offset, n in sorted(placed)]
        assert [offset for offset, _ in sorted(placed)] == [0, *ends[:-1]]
        assert unpadded(ends[-1], capacity) and ends[-1] <= capacity
