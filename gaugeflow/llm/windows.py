"""Packing documents online: a fixed number of open windows per task, best fit, leftovers merged.

Each task reads its documents once, in the order in which they come, and holds a bounded number of
open windows. A document longer than a window fills whole ones; what remains goes to the fullest
window with room for it. When none has room and no more may be opened, the fullest is filled up with
the start of the document and emitted, and the rest of the document looks for a place again. The
windows that are still open at the end of each task are laid end to end over all tasks and cut anew,
so that only the last stretch is shorter than a window: it becomes sequences of powers of two, which
need no padding.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common, tokens

OPEN_WINDOWS = 32
_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)
_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, ids array<int>"
)
_OPEN = _PIECE.append(pa.field("task", pa.int64())).append(pa.field("place", pa.int64()))


class OpenWindows:
    """Up to `most` partly filled windows; pieces are (doc_id, start, ids, doc_tokens)."""

    def __init__(self, capacity: int, most: int, first_sequence: int = 0):
        if capacity < 1 or most < 1:
            raise ValueError("a window holds at least one id, and one must be open")
        self.capacity, self.most = capacity, most
        self.sequence = first_sequence
        #: (room, window), ascending, so that the first with enough room fits best.
        self.rooms: list[tuple[int, int]] = []
        self.held: dict[int, list[tuple]] = {}
        self.opened = 0

    def _emit(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for piece in pieces:
            yield (*piece, self.sequence, offset)
            offset += len(piece[2])
        self.sequence += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        """Places a document; gives the pieces of the windows that it completes."""
        total = len(ids)
        start = total - total % self.capacity
        for at in range(0, start, self.capacity):
            yield from self._emit([(doc_id, at, ids[at : at + self.capacity], total)])
        while start < total:
            at = bisect_left(self.rooms, (total - start, -1))
            if at < len(self.rooms):
                room, window = self.rooms.pop(at)
            elif len(self.rooms) < self.most:
                room, window = self.capacity, self.opened
                self.held[window] = []
                self.opened += 1
            else:
                room, window = self.rooms.pop(0)
            end = min(total, start + room)
            # A copy, as a slice would hold the ids of the whole batch.
            self.held[window].append((doc_id, start, ids[start:end].copy(), total))
            if end - start == room:
                yield from self._emit(self.held.pop(window))
            else:
                insort(self.rooms, (room - (end - start), window))
            start = end

    def rest(self) -> Iterator[tuple]:
        """The pieces of the windows still open, the fullest first, and their place in a row."""
        place = 0
        for _, window in self.rooms:
            for piece in self.held[window]:
                yield (*piece, place)
                place += len(piece[2])
        self.rooms, self.held = [], {}


def _pack_task(vocabulary: str, capacity: int, end_id: int | None, most: int, keep_ids: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        task = TaskContext.get().partitionId()
        windows = OpenWindows(capacity, most, task << 32)

        def row(piece: tuple, sequence: int | None, offset: int | None, place: int | None) -> tuple:
            doc_id, start, ids, total = piece
            shown = ids.astype(np.int32) if keep_ids or place is not None else None
            crc = tokens.ids_crc32(ids)
            return doc_id, start, len(ids), crc, total, sequence, offset, shown, task, place

        for batch in common.cut_batches(batches):
            doc_ids, found = batch["doc_id"].to_pylist(), []
            for k, ids in encode.encode_rows(batch):
                ids = np.concatenate([ids, end])
                if not len(ids):
                    found.append(row((doc_ids[k], 0, ids, 0), None, None, None))
                for *piece, sequence, offset in windows.add(doc_ids[k], ids):
                    found.append(row(tuple(piece), sequence, offset, None))
            yield _batch(found, _OPEN)
        found = [row(tuple(piece), None, None, place) for *piece, place in windows.rest()]
        yield _batch(found, _OPEN)

    return pack


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def tail_lengths(total: int) -> list[int]:
    """Powers of two, the largest first, that add up to total."""
    return [1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1]


def cut_at(start: int, end: int, total: int, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """Cuts start..end of a row of `total` ids into (from, to, sequence, offset).

    Whole windows come first; what is left of the row is cut into powers of two.
    """
    whole = total // capacity
    edge, sequence = whole * capacity, whole
    tails = []
    for length in tail_lengths(total - edge):
        tails.append((edge, edge + length, sequence))
        edge, sequence = edge + length, sequence + 1
    at = start
    while at < min(end, whole * capacity):
        to = min(end, at - at % capacity + capacity)
        yield at, to, at // capacity, at % capacity
        at = to
    for first, last, number in tails:
        if first < end and at < last:
            yield max(first, at), min(last, end), number, max(first, at) - first


def _merge(rest: DataFrame, capacity: int, keep_ids: bool) -> DataFrame:
    """Places what the open windows of all tasks hold, laid end to end in the order of tasks."""
    held = rest.groupBy("task").agg(F.sum("length").alias("held"))
    # One row per task meets in one place.
    whole = Window.orderBy("task")
    before = F.coalesce(F.sum("held").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    based = held.select("task", before.alias("base"), F.sum("held").over(ends).alias("total"))
    place = (F.col("base") + F.col("place")).alias("place")
    placed = rest.join(based, "task").select("doc_id", "start", "doc_tokens", "ids", place, "total")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                ids = np.array(row["ids"], np.int32)
                first = row["place"]
                for a, b, sequence, offset in cut_at(first, first + len(ids), row["total"], capacity):
                    part = ids[a - first : b - first]
                    crc = tokens.ids_crc32(part)
                    start = row["start"] + a - first
                    key = row["doc_id"], start, len(part), crc, row["doc_tokens"]
                    found.append((*key, -1 - sequence, offset, part if keep_ids else None))
            yield _batch(found, _PIECE)

    return common.arrow_map(placed, cut, _DDL)


def pack_online(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int | None = 1,
    open_windows: int = OPEN_WINDOWS,
    keep_ids: bool = False,
) -> DataFrame:
    """Places the ids of every (doc_id, text) in sequences of at most capacity ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    keep_ids the ids themselves. Every sequence is full, but for at most one of each power of two
    below capacity. Sequences that one task filled have numbers from 0, merged ones negative numbers.

    A null text is empty: its only id is the end id. Without an end id, an empty document has one
    piece of length 0 in no sequence (sequence_id null). Texts of any length are encoded whole, in
    parts. Rows that share a doc_id, or have none, are packed each for itself; other columns are
    ignored. An empty table gives no rows. Memory: a batch of texts or one longer text, and
    open_windows windows.
    """
    narrow = common.ids_and_texts(docs)
    work = _pack_task(vocabulary, capacity, end_id, open_windows, keep_ids)
    placed = common.stored(
        common.arrow_map(narrow, work, f"{_DDL}, task long, place long"), "open-windows"
    )
    done = placed.filter("place IS NULL").drop("task", "place")
    merged = _merge(placed.filter("place IS NOT NULL"), capacity, keep_ids)
    pieces = done.unionByName(merged)
    return pieces if keep_ids else pieces.drop("ids")


def sequences(pieces: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_ids, ids: the sequences of pieces packed with keep_ids.

    Padded to capacity, except where the length is a power of two.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "start", "ids")))
    whole = pieces.filter("sequence_id IS NOT NULL").groupBy("sequence_id")
    made = whole.agg(F.flatten(parts["ids"]).alias("ids"), F.sum("length").cast("int").alias("n_ids"))
    as_is = F.col("n_ids").bitwiseAND(F.col("n_ids") - 1) == 0
    padding = F.when(as_is, 0).otherwise(F.lit(capacity) - F.col("n_ids"))
    padded = F.concat("ids", F.array_repeat(F.lit(pad_id), padding.cast("int")))
    return made.select("sequence_id", "n_ids", padded.alias("ids"))
