"""op6 and op8 against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
import zstandard
from corpus_cases import collected, corpus, documents, prose  # noqa: F401

from gaugeflow.llm import factors, repeats, suffixes
from gaugeflow.llm.common import ids_and_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(sequences: list[tuple], length: int) -> list[bytearray]:
    """Symbols in a window that also starts in a sequence with a smaller id."""
    first: dict = {}
    for key, symbols in sequences:
        for k in range(len(symbols) - length + 1):
            window = symbols[k : k + length]
            first[window] = min(first.get(window, key), key)
    gone = []
    for key, symbols in sequences:
        marks = bytearray(len(symbols))
        for k in range(len(symbols) - length + 1):
            if first[symbols[k : k + length]] < key:
                marks[k : k + length] = b"\1" * length
        gone.append(marks)
    return gone


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def expected_bytes(pairs: list[tuple]) -> list[tuple]:
    texts = [(i, (t or "").encode()) for i, t in pairs]
    found = []
    for (i, text), gone in zip(texts, covered(texts, 50), strict=True):
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        found.append((i, len(text), sum(gone), spans, sha(kept)))
    return sorted(found, key=repr)


def expected_words(pairs: list[tuple]) -> list[tuple]:
    texts = [(i, tuple(WORD.findall(t or ""))) for i, t in pairs]
    found = []
    for (i, words), gone in zip(texts, covered(texts, 13), strict=True):
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        found.append((i, len(words), sum(gone), sha(kept.encode())))
    return sorted(found, key=repr)


def test_bytes_against_brute_force(documents, corpus):
    found = suffixes.digest_repeats(ids_and_texts(documents(corpus)))
    assert collected(found) == expected_bytes(corpus)


def test_words_against_brute_force(documents, corpus):
    found = factors.digest_repeats(ids_and_texts(documents(corpus)))
    assert collected(found) == expected_words(corpus)


def test_real_outputs(documents, corpus):
    docs = ids_and_texts(documents(corpus))
    texts = sorted(((t or "").encode() for _, t in corpus))
    kept = suffixes.remove_repeats(docs).collect()
    assert sum(len(r.kept) for r in kept) + sum(s.end - s.start for r in kept for s in r.spans) == sum(
        map(len, texts)
    )
    carried = factors.remove_repeats(
        documents(corpus).na.fill({"text": ""}), carry=("lang", "source", "words")
    )
    for row in carried.collect():
        assert row.source == "s" and row.words == "clash"
        if row.n_removed == 0:
            assert (row.doc_id, row.text) in {(i, t or "") for i, t in corpus}


def test_null_id_is_last_and_empty_table(documents):
    text = "x y z " * 20
    found = suffixes.digest_repeats(ids_and_texts(documents([(None, text), (3, text)])))
    assert {r.doc_id: r.n_removed for r in found.collect()} == {None: len(text), 3: 0}
    assert suffixes.digest_repeats(ids_and_texts(documents([]))).count() == 0
    assert factors.digest_repeats(ids_and_texts(documents([]))).count() == 0


@pytest.mark.parametrize("words", [False, True])
def test_every_window_is_in_one_slice(corpus, words):
    shape = repeats.Shape(13, 7, True) if words else repeats.Shape(50, 26, False)
    import pyarrow as pa

    block = repeats.block_of(np.arange(len(corpus)), pa.array([t or "" for _, t in corpus]))
    found = repeats.symbols(block, words)
    got = repeats.slices(found, shape)
    windows = repeats.ranges(got.start, got.windows)
    sizes = np.diff(found.edges) - (0 if words else 1)
    starts = [
        a + k for a, n in zip(found.edges, sizes, strict=False) for k in range(n - shape.window + 1)
    ]
    assert sorted(windows.tolist()) == starts
    assert got.windows.max() <= shape.choices


@pytest.mark.parametrize("limit", [1, 200])
def test_hot_minimisers_against_brute_force(documents, corpus, monkeypatch, limit):
    monkeypatch.setattr(repeats, "HOT_WINDOWS", limit)
    docs = ids_and_texts(documents(corpus))
    assert collected(suffixes.digest_repeats(docs)) == expected_bytes(corpus)
    assert collected(factors.digest_repeats(docs)) == expected_words(corpus)


def test_a_hot_minimiser_is_dealt_over_buckets(documents):
    """A short shared passage between other words gives each document a slice of its own."""
    shared = "here stands a sentence that all documents have"
    rows = [(k, f"{prose(12, 2 * k)} {shared} {prose(12, 2 * k + 1)}") for k in range(300)]
    shape, blocks = suffixes._shape(50), repeats.pack(ids_and_texts(documents(rows)))
    texts = blocks.drop("digests", "bytes").join(repeats.copies(blocks), "block", "left")
    sent = repeats.anchors(texts, shape, 16)

    def largest(limit: int) -> int:
        routed = repeats.route(texts, repeats.repeated(sent, shape, limit), shape, 16)
        found: dict[int, int] = {}
        for row in routed.collect():
            windows = np.frombuffer(zstandard.decompress(row.windows), "u1")
            found[row.bucket] = found.get(row.bucket, 0) + int(windows.sum())
        return max(found.values())

    whole = largest(10**9)
    assert whole > 300 * shape.choices // 2
    assert largest(500) < whole / 3
