"""op11: runs against a plain search over all periods."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_cases import corpus, documents, prose  # noqa: F401

from gaugeflow.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) by start, then period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)  # smaller periods came first
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def echoed(doc_id, words: list[str]) -> list[str]:
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def kept_words(words: list[str], runs: list[tuple]) -> list[str]:
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return [w for k, w in enumerate(words) if k not in gone]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@st.composite
def texts(draw) -> list[int]:
    words = draw(st.lists(st.integers(0, draw(st.sampled_from([0, 1, 2, 8]))), max_size=70))
    if draw(st.booleans()) and words:
        a = draw(st.integers(0, len(words) - 1))
        p = draw(st.integers(1, len(words) - a))
        words = words[:a] + [words[a + k % p] for k in range(len(words) - a)]
    return words


@settings(max_examples=400, deadline=None)
@given(st.lists(texts(), max_size=4), st.sampled_from([2, 3, 12, 20]))
def test_runs_equal_a_plain_search(docs, least):
    codes = np.array([w for words in docs for w in words], np.int64)
    edges = np.cumsum([0, *map(len, docs)])
    found = [[] for _ in docs]
    for text, *run in zip(*(c.tolist() for c in periodic.find_runs(codes, edges, least)), strict=True):
        found[text].append(tuple(run))
    assert [sorted(runs) for runs in found] == [plain_runs(words, least) for words in docs]


def test_long_periods():
    draw = np.random.default_rng(2)
    words = [int(w) for w in draw.integers(0, 400, 300)]
    for a, p in [(0, 90), (40, 55), (100, 8), (10, 7), (3, 33)]:
        text = [words[i] if i < a else words[a + (i - a) % p] for i in range(300)]
        found = periodic.find_runs(np.array(text), np.array([0, 300]))
        assert [tuple(r) for r in np.stack(found[1:], 1).tolist()] == plain_runs(text)


@pytest.fixture(scope="module")
def repeating(corpus) -> list[tuple]:
    rows = [(200 + k, prose(40 + 9 * k, k)) for k in range(60)]
    rows += [(300, "x " * 5000), (301, " ".join(prose(30, 1).split() * 9)), (302, "\x1c \x85 a " * 9)]
    rows += [(303, "a b c " * 3 + "a b c"), (304, "a b c d e f " * 2), (305, "a b c d e f " * 2 + "a")]
    return [row for row in corpus if len(row[1] or "") < 20_000] + rows + [(None, "a b " * 20)] * 2


def test_detect(documents, repeating):
    found = periodic.detect(documents(repeating)).collect()
    wanted = []
    for doc_id, text in repeating:
        words = WORD.findall(text or "")
        runs = plain_runs(words)
        wanted.append((doc_id, len(words), runs, " ".join(kept_words(words, runs))))
    got = [(r.doc_id, r.n_words, [tuple(run) for run in r.runs], r.collapsed) for r in found]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_digests(documents, repeating):
    found = periodic.digest_runs(documents(repeating))
    wanted, planted = [], 0
    for doc_id, text in repeating:
        words = WORD.findall(text or "")
        if doc_id is not None:
            planted += echoed(doc_id, words) != words
            words = echoed(doc_id, words)
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(kept_words(words, runs))
        wanted.append((doc_id, len(runs), *shown, sha(lines), sha(kept)))
    assert planted > 3
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(wanted, key=repr)
    kinds = dict(found.dtypes)
    assert {kinds[c] for c in ("n_runs", "start", "length", "period", "exponent_milli")} == {"bigint"}


def test_nothing_to_read(documents):
    assert periodic.detect(documents([])).count() == 0
    found = periodic.digest_runs(documents([(1, None), (2, " \n")])).collect()
    assert all(r.n_runs == 0 and r.start is None and r.collapsed_sha256 == sha("") for r in found)
