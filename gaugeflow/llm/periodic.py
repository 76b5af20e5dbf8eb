"""Stretches of words that repeat with a period, in every text.

A run is a stretch of words that repeats with a smallest period q, is at least `least` words and two
periods long, and cannot grow on either side. Each of its words occurs at least twice in it. So a
word that occurs once in a segment of text belongs to no run there and splits it; the parts are
counted again, and split again, until no such word is left. Parts shorter than `least` go. What
survives is scanned for each lag: small lags word by word, greater ones from checkpoints, of which a
run of period q covers two in a row, q words apart.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import common

LEAST = 12
#: Lags from this one on are scanned from checkpoints, so a checkpoint's stretch has a whole gram.
_SPARSE = 8
_GRAM = 4
#: Checkpoints compared at a time.
_TOGETHER = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in common.SPACES]] = True

#: From doc_id and number of words, the numbers of the words that stand in their places; or None.
Rewrite = Callable[[int | None, int], np.ndarray | None]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in a row, and where the words of each text begin (and end)."""
    data, offsets = common.text_bytes(texts)
    inside = ~_SPACE[data]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    opening = offsets[:-1][offsets[:-1] < len(data)]
    fresh[opening] = inside[opening]
    start = np.flatnonzero(fresh)
    letters = data[inside]
    ends = np.append(np.cumsum(inside, dtype=np.int64)[start] - 1, len(letters)) if len(start) else [0]
    buffers = [None, pa.py_buffer(np.asarray(ends, np.int64)), pa.py_buffer(letters)]
    words = pa.Array.from_buffers(pa.large_binary(), len(start), buffers)
    return words, np.searchsorted(start, offsets)


def survivors(codes: np.ndarray, edges: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of the segments in which every word occurs twice or more.

    codes: a number per word, equal for equal words; edges: where each text begins.
    """
    first, length = edges[:-1], np.diff(edges)
    whole = length >= least
    first, length = first[whole], length[whole]
    done = [(first[:0], length[:0])]
    kinds = int(codes.max(initial=0)) + 1
    while len(first):
        place = _ranges(first, length)
        segment = np.repeat(np.arange(len(first)), length)
        key = segment * kinds + codes[place]
        order = np.argsort(key, kind="stable")
        held = key[order]
        alone = np.ones(len(held), bool)
        same = held[1:] == held[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        rare = np.zeros(len(held), bool)
        rare[order] = alone
        split = np.zeros(len(first), bool)
        split[segment[rare]] = True
        done.append((first[~split], length[~split]))
        # The stretches between rare words of the segments that have any.
        stays = ~rare & split[segment]
        opens = stays.copy()
        opens[1:] &= ~stays[:-1] | (segment[1:] != segment[:-1])
        at = np.flatnonzero(opens)
        upto = np.concatenate([[0], np.cumsum(stays)])
        sizes = np.diff(np.append(upto[at], upto[-1]))
        long_enough = sizes >= least
        first, length = place[at[long_enough]], sizes[long_enough]
    starts, lengths = (np.concatenate(part) for part in zip(*done, strict=True))
    return starts, lengths


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - (ends - length), length) + np.arange(total)


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading items of both are equal, looked at in growing pieces."""
    at, size, n = 0, 32, min(len(a), len(b))
    while at < n:
        end = min(n, at + size)
        differs = a[at:end] != b[at:end]
        if differs.any():
            return at + int(differs.argmax())
        at, size = end, size * 2
    return n


class _Scan:
    """Runs in a row of segments, each followed by a mark that equals nothing else."""

    def __init__(self, row: np.ndarray, least: int):
        self.row, self.least = row, least
        self.found: dict[tuple[int, int], int] = {}
        self.period, self.end = [0], [0]
        #: The longest known run at each place (0 for none) and its length.
        self.cover = np.zeros(len(row), np.int32)
        self.covered = np.zeros(len(row), np.int64)

    def add(self, start: int, length: int, period: int) -> None:
        # Periods ascend; of one stretch only the smallest counts.
        if (start, length) in self.found:
            return
        self.found[start, length] = period
        place = slice(start, start + length)
        longer = self.covered[place] < length
        self.cover[place][longer] = len(self.period)
        self.covered[place][longer] = length
        self.period.append(period)
        self.end.append(start + length)

    def dense(self, lag: int) -> None:
        row = self.row
        if len(row) <= lag:
            return
        same = np.concatenate([[False], row[:-lag] == row[lag:], [False]])
        flips = np.flatnonzero(same[1:] != same[:-1])
        start, stretch = flips[::2], flips[1::2] - flips[::2]
        runs = stretch >= max(self.least - lag, lag)
        for s, n in zip(start[runs].tolist(), stretch[runs].tolist(), strict=True):
            self.add(s, n + lag, lag)

    def sparse(self, lags: np.ndarray, reach: np.ndarray, grams: np.ndarray) -> None:
        """Lags in ascending order, none twice another; reach: how much of the row each may use."""
        counts = np.maximum(reach - 1, 0) // lags
        lag = np.repeat(lags, counts)
        k = np.arange(len(lag)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = k * lag
        last = len(grams) - 1
        ahead = (at + lag <= last) & (grams[np.minimum(at, last)] == grams[np.minimum(at + lag, last)])
        back = at - _GRAM + 1
        behind = (back >= 0) & (back + lag <= last)
        behind &= grams[np.clip(back, 0, last)] == grams[np.clip(back + lag, 0, last)]
        hit = np.flatnonzero(ahead | behind)
        if not len(hit):
            return
        lag, at = lag[hit], at[hit]
        # Within a known run, its multiples are no smallest period, and no other run of such a
        # lag overlaps it by more than that lag.
        known = self.cover[at]
        period, end = np.array(self.period), np.array(self.end)
        inside = (known > 0) & (at + lag < end[known])
        inside &= lag % np.maximum(period[known], 1) == 0
        before, until = 0, 0
        for q, j in zip(lag[~inside].tolist(), at[~inside].tolist(), strict=True):
            if q != before:
                before, until = q, 0
            if j < until:
                continue
            row = self.row
            right = _agreeing(row[j:], row[j + q :])
            left = _agreeing(row[:j][::-1], row[q : j + q][::-1])
            until = j + right
            if right + left >= max(q, self.least - q):
                self.add(j - left, right + left + q, q)


def find_runs(
    codes: np.ndarray, edges: np.ndarray, least: int = LEAST
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start (word number), length and period of every run, by text, start and period."""
    first, length = survivors(codes, edges, least)
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    # Longest segments first: those with room for a lag are a front part of the row.
    ends = np.cumsum(length + 1)
    row = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    marks = ends - 1
    row[marks] = -1 - np.arange(len(marks))
    begin = ends - length - 1
    row[_ranges(begin, length)] = codes[_ranges(first, length)]
    scan = _Scan(row, least)
    for lag in range(1, _SPARSE):
        scan.dense(lag)
    if len(length):
        grams = _grams(row)
        low, most = _SPARSE, int(length[0]) // 2
        while low <= most and len(grams):
            lags = np.arange(low, min(2 * low, most + 1))
            reach = np.append(0, ends)[np.searchsorted(-length, -2 * lags, "right")]
            work = np.cumsum(reach // lags)
            parts = np.searchsorted(work, np.arange(_TOGETHER, work[-1], _TOGETHER))
            for some in np.split(np.arange(len(lags)), np.unique(parts)):
                if len(some):
                    scan.sparse(lags[some], reach[some], grams)
            low *= 2
    runs = np.array([(s, n, q) for (s, n), q in scan.found.items()], np.int64).reshape(-1, 3)
    segment = np.searchsorted(ends, runs[:, 0], "right")
    start = first[segment] + runs[:, 0] - begin[segment]
    text = np.searchsorted(edges, start, "right") - 1
    order = np.lexsort((runs[:, 2], start, text))
    text, start = text[order], start[order]
    return text, start - edges[text], runs[order, 1], runs[order, 2]


def _grams(row: np.ndarray) -> np.ndarray:
    n = len(row) - _GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    mixed = common.mix64(row.astype(np.uint64))
    found = mixed[:n].copy()
    for k in range(1, _GRAM):
        found = common.mix64(found + mixed[k : k + n])
    return found


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed string"
)


def detect(docs: DataFrame, least: int = LEAST, rewrite: Rewrite | None = None) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed of every (doc_id, text).

    collapsed: the words joined by one space, without those that a run contains after its first
    period. rewrite: puts other words of the same text in some places first.

    Null, empty and blank texts have no words, no runs (an empty list) and an empty collapsed text.
    Texts are never cut: one longer than a batch is a batch of its own. Rows with one doc_id, or
    none, are judged each for itself; other columns are ignored. An empty table gives no rows. No
    row leaves its task, so nothing is shuffled.
    """
    if least < 2:
        raise ValueError("a run has two words at least")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.cut_batches(batches):
            yield _detect(batch, least, rewrite)

    return common.arrow_map(common.ids_and_texts(docs), work, SCHEMA)


def _detect(batch: pa.RecordBatch, least: int, rewrite: Rewrite | None) -> pa.RecordBatch:
    words, edges = split_words(batch["text"])
    place = np.arange(len(words))
    if rewrite:
        for doc_id, a, b in zip(batch["doc_id"].to_pylist(), edges, edges[1:], strict=False):
            other = rewrite(doc_id, int(b - a))
            if other is not None:
                place[a:b] = a + other
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[place]
    text, start, length, period = find_runs(codes, edges, least)
    size = len(place) + 1
    begin = edges[text] + start
    gone = np.bincount(begin + period, minlength=size) - np.bincount(begin + length, minlength=size)
    kept = np.cumsum(gone)[:-1] <= 0
    upto = np.concatenate([[0], np.cumsum(kept)])
    collapsed = _joined(words.take(pa.array(place[kept])), upto[edges])
    per_text = np.searchsorted(text, np.arange(batch.num_rows + 1))
    fields = [pa.array(values, pa.int64()) for values in (start, length, period)]
    runs = pa.ListArray.from_arrays(
        pa.array(per_text, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_RUNS.value_type))
    )
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"], pa.array(np.diff(edges), pa.int64()), runs, collapsed],
        ["doc_id", "n_words", "runs", "collapsed"],
    )


def _joined(words: pa.Array, edges: np.ndarray) -> pa.Array:
    """The words of each text with one space between them."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(words) + 1, words.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    # A space before each word but the first of a text.
    gap = np.ones(len(words), np.int64)
    gap[edges[:-1][edges[:-1] < edges[1:]]] = 0
    length = np.diff(offsets)
    ends = np.cumsum(length + gap)
    total = int(ends[-1]) if len(ends) else 0
    out = np.full(total, 32, np.uint8)
    inside = np.ones(total, bool)
    inside[(ends - length - gap)[gap > 0]] = False
    out[inside] = data[offsets[0] : offsets[-1]]
    bounds = np.concatenate([[0], ends])[edges].astype(np.int64)
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(out)]
    return pa.Array.from_buffers(pa.large_string(), len(edges) - 1, buffers).cast(pa.string())


def echo_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """In a tenth of the documents, by the CRC-32 of the decimal doc_id, the end repeats itself.

    From word a on, the words are those of the period that begins there, so that the operator has
    long periods to find; a missing doc_id leaves the text as it is.
    """
    if doc_id is None or not n:
        return None
    h = zlib.crc32(b"%d" % doc_id)
    if h % 10:
        return None
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    place = np.arange(n)
    place[first:] = first + np.arange(n - first) % period
    return place


def digest_runs(docs: DataFrame) -> DataFrame:
    """Per document of `detect` with `echo_tail`: the number of runs, the longest one, digests.

    Of equally long runs the one with the smallest start counts, then the smallest period; without
    a run its columns are null.
    """
    found = detect(docs, LEAST, echo_tail)
    keys = F.transform("runs", lambda r: F.struct(-r.length, r.start, r.period))
    longest = F.array_min(keys)
    line = F.transform(
        "runs",
        lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))),
    )
    lines = F.concat_ws("", F.transform(line, lambda text: F.concat(text, F.lit("\n"))))
    found = found.withColumn("best", longest)
    length, period = -F.col("best.col1"), F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
