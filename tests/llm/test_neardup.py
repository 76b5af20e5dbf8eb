"""op9 against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
from corpus_cases import collected, corpus, documents  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeflow.llm import neardup
from gaugeflow.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text: str | None, size: int) -> frozenset:
    words = tuple(WORD.findall((text or "").translate(LOWER)))
    if len(words) < size:
        return frozenset([words] if words else [])
    return frozenset(words[k : k + size] for k in range(len(words) - size + 1))


def expected(pairs: list[tuple], size: int) -> list[tuple]:
    sets = [(i, shingles(t, size)) for i, t in pairs]
    root = {i: i for i, _ in pairs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if i != j and a and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return sorted(
        ((i, len(s), find(i) if s else i, (find(i) if s else i) == i) for i, s in sets), key=repr
    )


@pytest.mark.parametrize("size", [2, 5])
def test_against_brute_force(documents, corpus, size):
    # A doc_id with two texts is one node; the empty ones are linked with nothing.
    found = neardup.near_duplicates(documents(corpus), neardup.Rules(shingle=size))
    assert collected(found) == expected(corpus, size)


def test_parts_of_a_large_cluster(documents):
    base = [f"w{k}" for k in range(100)]
    pairs = []
    for k in range(30):
        words = list(base)
        for j in range(k % 6):
            words[(k * 7 + j * 13) % 100] = f"x{k}-{j}"
        pairs.append((k, " ".join(words)))
    rules = neardup.Rules(shingle=2, together=400)
    assert collected(neardup.near_duplicates(documents(pairs), rules)) == expected(pairs, 2)


def test_empty_table_and_null_id(documents):
    assert neardup.near_duplicates(documents([])).count() == 0
    text = "a b c d e f g"
    found = neardup.near_duplicates(documents([(None, text), (1, text), (2, text)]))
    assert {r.doc_id: (r.component_id, r.kept) for r in found.collect()} == {
        None: (None, True),
        1: (1, True),
        2: (1, False),
    }


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), max_size=14), max_size=12))
def test_links_within_a_task(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    label = neardup.link(arrays, 80)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i < j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    assert label.tolist() == [find(i) for i in range(len(sets))]


def test_sketch_agrees_as_the_sets_do():
    draw = np.random.default_rng(5)
    shared = draw.integers(0, 1 << 63, 400).astype(np.uint64)
    own = draw.integers(0, 1 << 63, (2, 50)).astype(np.uint64)
    sets = [np.unique(np.concatenate([shared, o])) for o in own]
    a, b = neardup.sketch(sets, 720)
    assert (a != np.iinfo(np.uint64).max).all()
    assert abs((a == b).mean() - 0.8) < 0.06
    one = neardup.sketch([np.array([7], np.uint64)], 40)
    assert (one != np.iinfo(np.uint64).max).all()


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 200), (200, 150), (7, 7), (300, 300)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {**{k: 0 for k in range(51)}, 100: 100, 200: 100, 150: 100}
