from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, block long, words string"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns named as the operators' own ones."""

    def build(rows: list[tuple]):
        full = [(i, t, "en" if (i or 0) % 3 else None, "s", 7, "clash") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


def prose(words: int, seed: int) -> str:
    draw = random.Random(seed)
    parts = ["er", "th", "on", "in", "re", "ti", "wh", "ea", "lo", "qu", "ß", "ñ"]
    text = ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(words)]
    return " ".join(w + ("\n" if draw.random() < 0.05 else "") for w in text)


@pytest.fixture(scope="session")
def corpus() -> list[tuple]:
    """Nulls, empty and blank texts, short and long ones, copies, near copies, shared passages,
    text that repeats itself, ties and repeated rows."""
    base = [prose(120, k) for k in range(12)]
    passage = prose(70, 99)
    near = base[3].split(" ")
    near[10] = "changed"
    rows = [
        (0, None),
        (1, ""),
        (2, " \t\n "),
        (3, "one"),
        (4, "one two"),
        (5, "One TWO"),
        *((10 + k, text) for k, text in enumerate(base)),
        (40, base[0]),
        (41, base[0]),
        (42, " ".join(near)),
        (43, base[5] + " " + passage),
        (44, passage + " " + base[6]),
        (45, prose(20, 7) + " " + passage + prose(20, 8)),
        (46, "a" * 400),
        (47, "a" * 300 + "b"),
        (48, "the of " * 60),
        (49, "of the " * 40),
        (50, prose(6000, 5)),
        (51, prose(10, 6) + " " + prose(6000, 5)),
        (60, base[7]),
        (60, base[7]),
        (61, base[8] + " tail"),
        (61, base[9]),
        (62, "<|endoftext|> it's the end… 'S É İ ﬁ 12 don't.\x0bx"),
    ]
    random.Random(1).shuffle(rows)
    return rows


def collected(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
