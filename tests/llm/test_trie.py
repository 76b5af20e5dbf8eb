"""op13: the trie against a plain one, over whole tables of odd conversations."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from gaugeflow.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, t1 int, part int"


def said(rows: list[tuple]) -> dict[int, list[tuple]]:
    """Turns of each conversation; equal numbers in the order of what they say."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, digest, role, text))
    return {conv: [t[3:] for t in sorted(turns)] for conv, turns in found.items()}


def rebuilt(convs: dict[int, list]) -> dict[int, list]:
    result = {}
    for conv, turns in convs.items():
        h = zlib.crc32(str(conv).encode()) % 6
        result[conv] = convs.get(conv - conv % 100, [])[:h] + turns[h:]
    return result


def nodes(convs: dict[int, list]) -> list[tuple]:
    members = defaultdict(list)
    for conv in sorted(convs):
        for d in range(len(convs[conv]) + 1):
            members[tuple(convs[conv][:d])].append(conv)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(own) - 1) * len(path[-1][1]) if path else 0
    rows = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in own if len(convs[c]) == len(path))
        parent = members[path[:-1]][0] if path else None
        key = own[0], len(path), parent, len(own), children[path], leaves[path], saved[path]
        rows.append((*key, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def talks() -> list[tuple]:
    draw = random.Random(4)
    say = lambda: "".join(draw.choices("abç𝒳 ", k=draw.randint(0, 9)))
    rows = []
    opening = [("user", say()) for _ in range(40)]
    for conv in [*range(0, 12), 100, 101, 205, 4095, 4096, 9000, 123456789012]:
        n = draw.choice([1, 2, 3, 7, 8, 9, 16, 17, 40])
        shared = draw.choice([0, 3, 8, 16, 40])
        turns = opening[:shared][:n] + [("bot", say()) for _ in range(n - shared)]
        rows += [(conv, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(30, 5, None, None), (30, None, "user", "x"), (30, 5, "user", None), (30, 5, "", "")]
    rows += [(31, 1, "user", "same"), (31, 1, "user", "same"), (31, 1, "a", "bc"), (31, 1, "ab", "c")]
    rows += [(300, 0, "user", "only"), (399, 0, "user", "own"), (399, 1, "user", "more")]
    rows += [(None, 0, "user", "no conversation"), (500, None, None, None)]
    bare = next(c for c in range(601, 700) if zlib.crc32(b"%d" % c) % 6)
    rows.append((bare, 0, "user", "lost with its head"))
    draw.shuffle(rows)
    return rows


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(*row, "clash", 1, 2, 3) for row in rows], SCHEMA)


@pytest.mark.parametrize("stretch", [8, 16, 512])
def test_trie_equals_a_plain_one(spark, talks, stretch):
    turns = trie.numbered_turns(frame(spark, talks))
    found = trie.prefix_trie(turns, stretch=stretch)
    rows = sorted((tuple(r) for r in found.drop("turn_id").collect()), key=repr)
    assert rows == nodes(said(talks))


def test_shared_openings(spark, talks):
    found = trie.shared_openings(frame(spark, talks))
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    ]
    rows = sorted((tuple(r) for r in found.collect()), key=repr)
    convs = rebuilt(said(talks))
    assert any(not turns for turns in convs.values())
    assert rows == nodes(convs)


def test_copies_and_long_conversations(spark):
    rows = [(c, k, "user", f"turn {k}") for c in range(60) for k in range(20)]
    rows += [(7000, k, "user", f"turn {min(k, 50)}") for k in range(1100)]
    rows += [(c, 0, "user", "word " * 30_000) for c in (7100, 7200)]
    found = trie.prefix_trie(trie.numbered_turns(frame(spark, rows)), stretch=64)
    assert sorted((tuple(r) for r in found.drop("turn_id").collect()), key=repr) == nodes(said(rows))


def test_texts_of_nodes(spark, talks):
    talk = frame(spark, talks)
    found = trie.prefix_trie(trie.numbered_turns(talk)).filter("depth = 1")
    spelt = found.join(trie.turn_texts(talk), "turn_id").select("conv_id", "role", "text")
    first = {turns[0]: conv for conv, turns in reversed(sorted(said(talks).items()))}
    assert {tuple(r) for r in spelt.collect()} == {(c, *turn) for turn, c in first.items()}


def test_no_conversations(spark):
    assert trie.shared_openings(frame(spark, [])).count() == 0
    assert trie.shared_openings(frame(spark, [(None, 1, "user", "x")])).count() == 0
