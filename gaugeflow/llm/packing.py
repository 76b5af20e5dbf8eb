"""Packing documents into sequences: length patterns fitted by non-negative least squares.

Every number that meets on the driver is a count per length: at most `capacity` of them, whatever
the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common, tokens

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SALTS = 256


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int | None) -> DataFrame:
    """One row per piece: only documents longer than a sequence are cut."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        names = [part.split()[0] for part in PIECE_SCHEMA.split(", ")]
        for batch in common.cut_batches(batches):
            doc_ids, found = batch["doc_id"].to_pylist(), []
            for row, ids in encode.encode_rows(batch):
                ids = np.concatenate([ids, end])
                for piece, start in enumerate(range(0, max(len(ids), 1), capacity)):
                    part = ids[start : start + capacity]
                    found.append((doc_ids[row], piece, start, len(part), tokens.ids_crc32(part)))
            columns = zip(*found, strict=True)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return common.arrow_map(docs, cut, PIECE_SCHEMA)


# ---- the plan, from the histogram of lengths alone


def length_patterns(counts: np.ndarray, most: int = 3, width: int = 64) -> list[tuple[int, ...]]:
    """Patterns of one to `most` lengths that fill a sequence exactly, longest length first.

    counts: by length. Among the second lengths of a longer pattern only the `width` most frequent
    ones are tried for each first length, so that their number stays near capacity * width.
    """
    capacity = len(counts) - 1
    there = np.flatnonzero(counts[1:]) + 1
    patterns = [(capacity,)] if counts[capacity] else []
    for a in there[::-1]:
        b = capacity - a
        if 0 < b <= a and counts[b]:
            patterns.append((int(a), int(b)))
        if most < 3:
            continue
        seconds = there[(there <= min(a, capacity - a - 1)) & (there >= (capacity - a + 1) // 2)]
        seconds = seconds[np.argsort(-counts[seconds], kind="stable")[:width]]
        thirds = capacity - a - seconds
        for b, c in zip(seconds.tolist(), thirds.tolist(), strict=True):
            if counts[c]:
                patterns.append((int(a), b, c))
    return patterns


def fit_repeats(
    patterns: list[tuple[int, ...]], counts: np.ndarray, rounds: int = 300
) -> np.ndarray:
    """Repeats x >= 0 that make the lengths used come nearest to counts in least squares.

    Multiplicative updates keep x non-negative: x * (A'h) / (A'A x), with A given by the patterns'
    own lengths.
    """
    if not patterns:
        return np.zeros(0)
    size = max(map(len, patterns))
    member = np.array([p + (0,) * (size - len(p)) for p in patterns])
    filled = member > 0
    target = counts.astype(np.float64)
    target[0] = 0
    wanted = np.where(filled, target[member], 0).sum(1)
    x = np.where(filled, target[member], np.inf).min(1) / len(patterns)
    for _ in range(rounds):
        used = np.bincount(
            member.ravel(), np.repeat(x, size) * filled.ravel(), minlength=len(counts)
        )
        x *= wanted / np.maximum(np.where(filled, used[member], 0).sum(1), 1e-12)
    return x


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing on counts: (pattern, repeats), handling equal sequences together."""
    capacity = len(counts) - 1
    by_room: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    open_rooms = np.zeros(capacity + 1, bool)

    def put(pattern: tuple[int, ...], repeats: int) -> None:
        room = capacity - sum(pattern)
        by_room[room].append((pattern, repeats))
        open_rooms[room] = True

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            room = length + int(np.argmax(open_rooms[length:])) if open_rooms[length:].any() else 0
            if room:
                pattern, repeats = by_room[room].pop()
                open_rooms[room] = bool(by_room[room])
                fit = min(room // length, left)
                taken = min(repeats, left // fit)
                if taken < repeats:
                    put(pattern, repeats - taken)
                put(pattern + (length,) * fit, taken)
                left -= taken * fit
            else:
                fit = min(capacity // length, left)
                put((length,) * fit, left // fit)
                left %= fit
    return [group for groups in by_room for group in groups]


def plan_sequences(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that use every length exactly as often as it is there.

    Fitted patterns first, each as often as its rounded fit and what is left allow; the rest is
    packed by best fit.
    """
    left = counts.astype(np.int64).copy()
    left[0] = 0
    patterns = length_patterns(left)
    repeats = np.floor(fit_repeats(patterns, left) + 0.5).astype(np.int64)
    plan = []
    for k in np.argsort(-repeats, kind="stable"):
        lengths, need = np.unique(patterns[k], return_counts=True)
        times = min(int(repeats[k]), int((left[lengths] // need).min()))
        if times > 0:
            left[lengths] -= times * need
            plan.append((patterns[k], times))
    return plan + best_fit(left)


def _slots(plan: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[str, np.ndarray]:
    """Per length, consecutive ranks and where they go: sequences in a row, one offset."""
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for length in pattern:
            rows.append((length, times, sequence, offset))
            offset += length
        sequence += times
    every = np.array(rows, np.int64).reshape(-1, 4)
    every = every[np.argsort(every[:, 0], kind="stable")]
    ends = np.cumsum(every[:, 1])
    total = np.bincount(every[:, 0], every[:, 1], capacity + 2).astype(np.int64)
    return {
        "first": ends - every[:, 1],
        "sequence": every[:, 2],
        "offset": every[:, 3],
        "base": np.cumsum(total) - total,
    }


# ---- on all pieces


def rank_in_length(pieces: DataFrame) -> DataFrame:
    """Adds rank: 0.. within a length. A frequent length is numbered in 256 parts."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(_SALTS)))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parts = parts.select(
        "length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier")
    )
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    numbered = salted.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered.join(parts, ["length", "salt"]).withColumn(
        "rank", F.col("earlier") + F.col("inside")
    )


OUT_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


def place(ranked: DataFrame, plan: list[tuple[tuple[int, ...], int]], capacity: int) -> DataFrame:
    slots = _slots(plan, capacity)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in PIECE_SCHEMA.split(", ")]
        for batch in batches:
            rank = batch["rank"].to_numpy() + slots["base"][batch["length"].to_numpy()]
            k = np.searchsorted(slots["first"], rank, "right") - 1
            sequence = slots["sequence"][k] + rank - slots["first"][k]
            yield pa.RecordBatch.from_arrays(
                [batch[n] for n in names] + [pa.array(sequence), pa.array(slots["offset"][k])],
                [*names, "sequence_id", "offset"],
            )

    return common.arrow_map(ranked.select(*PIECE_COLUMNS, "rank"), locate, OUT_SCHEMA)


PIECE_COLUMNS = [part.split()[0] for part in PIECE_SCHEMA.split(", ")]


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int | None = 0
) -> DataFrame:
    """Places every piece of (doc_id, text) in a sequence of at most capacity ids.

    A null text is empty: its only id is the end id. Without an end id, an empty document has one
    piece of length 0, which no sequence holds: its sequence_id is null. Rows that share a doc_id
    are packed each for itself. Texts of any length are encoded whole, in parts. Other columns are
    ignored. An empty table gives no rows.
    """
    pieces = common.stored(cut_pieces(docs, vocabulary, capacity, end_id), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    # At most capacity + 1 rows.
    for length, n in pieces.groupBy("length").agg(F.count("*")).collect():
        counts[length] = n
    ranked = rank_in_length(pieces.filter("length > 0"))
    packed = place(ranked, plan_sequences(counts), capacity)
    if not counts[0]:
        return packed
    empty = F.lit(None).cast("long")
    rest = pieces.filter("length = 0").withColumns({"sequence_id": empty, "offset": empty})
    return packed.unionByName(rest)


def sequence_ids(docs: DataFrame, packed: DataFrame, vocabulary: str, end_id: int | None) -> DataFrame:
    """The sequences themselves: sequence_id, ids array<int>, at most capacity ids each."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in common.cut_batches(batches):
            ids = [np.concatenate([ids, end]).astype(np.int32) for _, ids in encoder.encode_rows(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    encoded = common.arrow_map(docs, encode, "doc_id long, ids array<int>")
    part = F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    pieces = packed.join(encoded, "doc_id").select("sequence_id", "offset", part.alias("part"))
    in_order = F.array_sort(F.collect_list(F.struct("offset", "part")))
    return pieces.groupBy("sequence_id").agg(F.flatten(in_order["part"]).alias("ids"))
