"""Finding windows of text that also start in an earlier document, by routing content.

Texts are packed into blocks, rows of a few megabytes. Every window of a fixed number of symbols
(bytes or words) has a minimiser: the smallest hash among its shorter grams. Equal windows have
equal minimisers, so neighbouring windows with the same minimiser travel together as one slice, and
all slices that could share a window meet in one bucket. Nothing compares all pairs.

1. `pack`: blocks, stored once; `copies`: which texts repeat an earlier document as a whole. These
   take no further part, as their windows all start in that document.
2. `anchors`: each block sends its distinct minimisers to their buckets, four bytes each.
3. `repeated`: a bucket sends back, per block, those that more than one document has, and which of
   them are hot: so many windows have them that one bucket should not take them all.
4. `route`: a block sends the distinct slices of these to their buckets, with their earliest
   document in the block. A passage that a third of all documents share is one slice per block.
   Distinct windows of a hot minimiser go one by one, dealt over several buckets by their content.
5. a bucket compares the windows of its slices (the part in which the operators differ) and sends
   back an earlier document of each window that has one.
6. `resolve`: a block marks these windows in its texts.

Buckets grow in number with the corpus. Within a task, memory follows one block or one bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import common

BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
#: Windows of one minimiser from which on it is hot, and that a bucket then takes of it, about.
HOT_WINDOWS = 400_000
#: Stands for a missing doc_id: later than every other.
NO_ID = np.iinfo(np.int64).max
_CHUNK = 1 << 16
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in common.SPACES]] = True
_BYTE_VALUE = common.mix64(np.arange(1, 257, dtype=np.uint64))


@dataclass(frozen=True)
class Shape:
    """Windows of `window` symbols, each with a minimiser among its grams of `gram` symbols."""

    window: int
    gram: int
    words: bool

    @property
    def choices(self) -> int:
        return self.window - self.gram + 1


@dataclass
class Block:
    """The texts of one row: their ids, bytes and edges, and their symbols.

    Between texts stands one line feed, which belongs to none, so that the last word of a text is
    followed by white space as the others are.
    """

    ids: np.ndarray
    data: np.ndarray
    edges: np.ndarray

    def text(self, k: int) -> np.ndarray:
        return self.data[self.edges[k] : self.edges[k + 1] - 1]


@dataclass
class Symbols:
    """Codes of all symbols of a block in a row, and where the symbols of each text begin."""

    codes: np.ndarray
    edges: np.ndarray
    #: For words: first byte in the block, and bytes.
    start: np.ndarray | None = None
    length: np.ndarray | None = None


@dataclass
class Slices:
    """Runs of windows with one minimiser: first symbol, windows, text, route and content."""

    start: np.ndarray
    windows: np.ndarray
    owner: np.ndarray
    route: np.ndarray
    content: np.ndarray


# ---- blocks


def pack(
    docs: DataFrame, carry: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, text) as stored rows of about block_bytes of text each.

    Columns to carry along become lists carry_0, carry_1, ..., for the output alone.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, n = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 32
        for batch in common.cut_batches(batches, limit=block_bytes):
            ids = batch["doc_id"].fill_null(NO_ID).to_numpy(zero_copy_only=False)
            texts = [t.as_buffer() for t in batch["text"].cast(pa.large_binary())]
            sizes = np.array([t.size for t in texts], np.int64)
            row = [
                [n],
                [ids.astype("<i8").tobytes()],
                [sizes.astype("<i8").tobytes()],
                [b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts)],
                [int(sizes.sum())],
                [packer.compress(b"\n".join([*texts, b""]))],
            ]
            kinds = [pa.int64(), *[pa.binary()] * 3, pa.int64(), pa.binary()]
            carried = [pa.ListArray.from_arrays([0, batch.num_rows], batch[c]) for c in carry]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, kinds, strict=True)] + carried,
                ["block", "ids", "sizes", "digests", "bytes", "packed", *_carried(carry)],
            )
            n += 1

    types = dict(docs.dtypes)
    schema = ", ".join(
        ["block long, ids binary, sizes binary, digests binary, bytes long, packed binary"]
        + [f"{k} array<{types[c]}>" for k, c in zip(_carried(carry), carry, strict=True)]
    )
    return common.stored(common.arrow_map(docs, work, schema), "text-blocks")


def _carried(carry: tuple[str, ...]) -> list[str]:
    return [f"carry_{k}" for k in range(len(carry))]


def copies(blocks: DataFrame) -> DataFrame:
    """block, copies array<int>: places in the block of texts that an earlier document equals."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                digests = np.frombuffer(row["digests"], "<i8").reshape(-1, 2)
                yield _batch(
                    {
                        "a": (digests[:, 0], pa.int64()),
                        "b": (digests[:, 1], pa.int64()),
                        "doc": (ids, pa.int64()),
                        "block": (np.full(len(ids), row["block"]), pa.int64()),
                        "place": (np.arange(len(ids)), pa.int32()),
                    }
                )

    read = blocks.select("block", "ids", "digests")
    places = common.arrow_map(read, work, "a long, b long, doc long, block long, place int")
    first = places.groupBy("a", "b").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    first = first.filter("first < last").drop("last")
    later = places.join(first, ["a", "b"]).filter("doc > first")
    return later.groupBy("block").agg(F.collect_list("place").alias("copies"))


def unpack(row: dict) -> Block:
    data = zstandard.ZstdDecompressor().decompress(row["packed"])
    sizes = np.frombuffer(row["sizes"], "<i8")
    edges = np.concatenate([[0], np.cumsum(sizes + 1)])
    return Block(np.frombuffer(row["ids"], "<i8"), np.frombuffer(data, np.uint8), edges)


def bucket_count(blocks: DataFrame) -> int:
    """So many that a bucket stands for some eight megabytes of text, at least one per task."""
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    session = blocks.sparkSession
    return max(total // BUCKET_BYTES, int(session.conf.get("spark.sql.shuffle.partitions")))


# ---- symbols and slices


def block_of(ids: np.ndarray, texts: pa.Array) -> Block:
    parts = [t.as_buffer() for t in texts.cast(pa.large_binary())]
    edges = np.cumsum([0, *(p.size + 1 for p in parts)])
    return Block(ids, np.frombuffer(b"\n".join([*parts, b""]), np.uint8), edges)


def symbols(block: Block, words: bool) -> Symbols:
    if words:
        return word_symbols(block)
    # The line feed after each text counts as a symbol of that text; windows never reach it.
    return Symbols(_BYTE_VALUE[block.data], block.edges)


def word_symbols(block: Block) -> Symbols:
    space = _SPACE[block.data]
    before = np.concatenate([[True], space[:-1]])
    start = np.flatnonzero(before & ~space)
    end = np.flatnonzero(~before & space)
    codes = np.empty(len(start), np.uint64)
    base = np.uint64(_BASE)
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    # Sums of value * base^place give the hash of any stretch of a chunk of bytes at once.
    first = 0
    while first < len(start):
        origin = start[first]
        last = max(np.searchsorted(end, origin + _CHUNK, "right"), first + 1)
        a, b = start[first:last] - origin, end[first:last] - origin
        size = int(b[-1])
        power = np.full(size + 1, base)
        power[0] = 1
        power = np.multiply.accumulate(power)
        terms = _BYTE_VALUE[block.data[origin : origin + size]] * power[:-1]
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        undo = np.full(size + 1, inverse)
        undo[0] = 1
        undo = np.multiply.accumulate(undo)
        codes[first:last] = (upto[b] - upto[a]) * undo[a] + (b - a).astype(np.uint64)
        first = last
    edges = np.searchsorted(start, block.edges)
    return Symbols(common.mix64(codes), edges, start, end - start)


def rolling(codes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of `length` codes, from the hashes of runs of powers of two."""
    found, have, part, size = None, 0, codes, 1
    while True:
        step = np.uint64(pow(_BASE, size, 1 << 64))
        if length & size:
            if found is None:
                found, have = part, size
            else:
                n = len(codes) - have - size + 1
                found, have = found[:n] * step + part[have : have + n], have + size
        if have == length:
            return found
        part = part[:-size] * step + part[size:]
        size *= 2


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def slices(found: Symbols, shape: Shape, without: list[int] | None = None) -> Slices:
    """All slices of a block; each window of each text is in exactly one.

    without: places of texts that are left out.
    """
    total = len(found.codes)
    owner = np.repeat(np.arange(len(found.edges) - 1, dtype=np.int32), np.diff(found.edges))
    bytes_apart = 0 if shape.words else 1  # the line feed after each text
    parts = []
    for first in range(0, total - shape.window + 1, _CHUNK):
        n = min(_CHUNK, total - shape.window + 1 - first)
        codes = found.codes[first : first + n + shape.window - 1]
        whole = common.mix64(rolling(codes, shape.window))
        least = _sliding_min(common.mix64(rolling(codes, shape.gram)), shape.choices)
        texts = owner[first : first + n]
        reach = first + np.arange(n) + shape.window - 1 + bytes_apart
        valid = owner[np.minimum(reach, total - 1)] == texts
        valid &= reach < total
        fresh = np.concatenate([[True], (least[1:] != least[:-1]) | ~valid[:-1]]) & valid
        start = np.flatnonzero(fresh)
        if not len(start):
            continue
        # A run ends at the next start or at the first window that is not valid.
        bad = np.append(np.flatnonzero(~valid), n)
        end = np.minimum(np.append(start[1:], n), bad[np.searchsorted(bad, start)])
        pieces = -(-(end - start) // shape.choices)
        if pieces.max() > 1:  # text that repeats itself: cut into slices of the usual length
            k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            stop = np.repeat(end, pieces)
            start = np.repeat(start, pieces) + k * shape.choices
            end = np.minimum(start + shape.choices, stop)
        parts.append(
            (
                start + first,
                end - start,
                texts[start],
                common.mix64(least[start]),
                # First and last window overlap or touch, so they and their number tell all.
                common.mix64(
                    whole[start] + common.mix64(whole[end - 1] + (end - start).astype(np.uint64))
                ),
            )
        )
    if not parts:
        none = np.zeros(0, np.int64)
        return Slices(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    every = Slices(*(np.concatenate(column) for column in zip(*parts, strict=True)))
    if not without:
        return every
    stays = np.ones(len(found.edges) - 1, bool)
    stays[without] = False
    kept = stays[every.owner]
    return Slices(*(column[kept] for column in vars(every).values()))


def window_hashes(found: Symbols, shape: Shape, at: np.ndarray) -> np.ndarray:
    """Hashes of the windows that start at the symbols `at`, which ascend."""
    hashes = np.empty(len(at), np.uint64)
    edges = np.searchsorted(at, np.arange(0, len(found.codes) + _CHUNK, _CHUNK))
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if a < b:
            first = k * _CHUNK
            codes = found.codes[first : first + _CHUNK + shape.window - 1]
            hashes[a:b] = common.mix64(rolling(codes, shape.window))[at[a:b] - first]
    return hashes


def _keys(route: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 32 | rest, with as many buckets as asked for."""
    low, rest = route & np.uint64(0xFFFFFFFF), route >> np.uint64(32)
    bucket = low * np.uint64(buckets) >> np.uint64(32)
    return bucket << np.uint64(32) | rest


def _split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets among sorted keys and where each begins, with the end."""
    bucket = (keys >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    return bucket[first], np.append(first, len(keys))


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in columns.values()], list(columns)
    )


#: What the steps below read of a block; columns to carry are left alone.
_TEXTS = ["block", "ids", "sizes", "packed", "copies"]

# ---- which minimisers more than one document has


def anchors(blocks: DataFrame, shape: Shape, buckets: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, row in common.one_by_one(batches, _TEXTS):
            sent = distinct_minimisers(row)
            if sent is not None:
                yield sent

    def distinct_minimisers(row: dict) -> pa.RecordBatch | None:
        block = unpack(row)
        got = slices(symbols(block, shape.words), shape, row["copies"])
        keys, docs = _keys(got.route, buckets), block.ids[got.owner]
        order = np.argsort(keys, kind="stable")
        alike, first, _ = _distinct(got)
        windows = np.zeros(len(keys), np.int64)
        windows[alike[first]] = got.windows[alike[first]]
        keys, docs = keys[order], docs[order]
        fresh = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        if not len(fresh):
            return None
        many = np.minimum.reduceat(docs, fresh) != np.maximum.reduceat(docs, fresh)
        windows = np.add.reduceat(windows[order], fresh)
        heavy = windows > 2 * shape.choices
        keys = keys[fresh]
        bucket, edge = _split(keys)
        rest = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
        spans = list(zip(edge, edge[1:], strict=False))
        return _batch(
            {
                "bucket": (bucket, pa.int32()),
                "block": ([row["block"]] * len(bucket), pa.int64()),
                "rest": ([rest[a:b].tobytes() for a, b in spans], pa.binary()),
                "many": ([np.packbits(many[a:b]).tobytes() for a, b in spans], pa.binary()),
                "heavy": ([_heavy(windows[a:b], heavy[a:b]) for a, b in spans], pa.binary()),
            }
        )

    schema = "bucket int, block long, rest binary, many binary, heavy binary"
    return common.arrow_map(blocks, work, schema)


def _heavy(windows: np.ndarray, heavy: np.ndarray) -> bytes:
    """Places and distinct windows of the minimisers with many in their block; usually none."""
    at = np.flatnonzero(heavy)
    return np.stack([at, windows[at]]).astype("<u4").tobytes()


def repeated(sent: DataFrame, shape: Shape, hot_windows: int) -> DataFrame:
    """bucket, block, rest: minimisers of the block that more than one document has.

    hot: those with over hot_windows windows, and over how many buckets each is to be dealt. A
    block without a count of its own counts as one whole slice.
    """

    def work(table: pa.Table) -> pa.Table:
        rest = [np.frombuffer(v.as_buffer(), "<u4") for v in table["rest"]]
        many = [
            np.unpackbits(np.frombuffer(v.as_buffer(), np.uint8), count=len(r)).astype(bool)
            for v, r in zip(table["many"], rest, strict=True)
        ]
        every = np.concatenate(rest)
        order = np.argsort(every, kind="stable")
        held = every[order]
        again = np.concatenate([held[1:] == held[:-1], [False]])
        again[1:] |= held[1:] == held[:-1]
        keep = np.empty(len(every), bool)
        keep[order] = again
        # What one block alone has counts if two of its documents have it.
        keep |= np.concatenate(many)
        edges = np.cumsum([0, *map(len, rest)])
        windows = np.full(len(every), shape.choices, np.int64)
        for edge, v in zip(edges, table["heavy"], strict=False):
            at, n = np.frombuffer(v.as_buffer(), "<u4").reshape(2, -1).astype(np.int64)
            windows[edge + at] = n
        fresh = np.flatnonzero(np.append(True, held[1:] != held[:-1])[: len(held)])
        total = np.add.reduceat(windows[order], fresh) if len(fresh) else windows
        parts = np.empty(len(every), np.int64)
        parts[order] = np.repeat(-(-total // hot_windows), np.diff(np.append(fresh, len(held))))
        hot = []
        for a, b in zip(edges, edges[1:], strict=False):
            at = a + np.flatnonzero(keep[a:b] & (parts[a:b] > 1))
            hot.append(np.stack([every[at], parts[at]]).astype("<u4").tobytes())
        kept = [every[a:b][keep[a:b]].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
        return pa.table(
            {
                "bucket": table["bucket"].cast(pa.int32()),
                "block": table["block"],
                "rest": pa.array(kept, pa.binary()),
                "hot": pa.array(hot, pa.binary()),
            }
        ).filter(pa.array([bool(k) for k in kept], pa.bool_()))

    schema = "bucket int, block long, rest binary, hot binary"
    return sent.groupBy("bucket").applyInArrow(work, schema)


# ---- slices to buckets and answers back


def _distinct(got: Slices) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slices in the order of their content, where each content begins, with the end."""
    order = np.argsort(got.content, kind="stable")
    held = got.content[order]
    first = np.flatnonzero(np.append(True, held[1:] != held[:-1])[: len(held)])
    return order, first, np.append(first, len(order))


def _slice_bytes(
    block: Block, found: Symbols, shape: Shape, start: np.ndarray, windows: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the slices in a row and the length of each; words with one space after each."""
    n_symbols = windows + shape.window - 1
    if not shape.words:
        at = ranges(start, n_symbols)
        return block.data[at], n_symbols
    word = ranges(start, n_symbols)
    size = found.length[word] + 1
    data = block.data[ranges(found.start[word], size)]
    ends = np.cumsum(size)
    data[ends - 1] = 32
    upto = np.concatenate([[0], ends])
    last = np.cumsum(n_symbols)
    return data, upto[last] - upto[last - n_symbols]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (length[0] of them), start[1], ..."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - (ends - length), length) + np.arange(total)


_ROUTED = (
    "bucket int, block long, ordinals binary, windows binary, docs binary, many binary, "
    "sizes binary, data binary"
)


def route(blocks: DataFrame, back: DataFrame, shape: Shape, buckets: int) -> DataFrame:
    """Distinct slices of repeated minimisers of each block, to the buckets of the minimisers.

    The windows of hot minimisers are slices of their own; -1 - first symbol is their ordinal.
    """

    def hot_windows(
        block: Block, found: Symbols, got: Slices, keys: np.ndarray, parts: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """Bucket, first symbol, earliest and latest document of each distinct window."""
        every = _keys(got.route, buckets)
        chosen = np.flatnonzero(np.isin(every, keys))
        n = got.windows[chosen]
        start = ranges(got.start[chosen], n)
        hashes = window_hashes(found, shape, start)
        order = np.argsort(hashes, kind="stable")
        held = hashes[order]
        first = np.flatnonzero(np.append(True, held[1:] != held[:-1])[: len(held)])
        docs = np.repeat(block.ids[got.owner[chosen]], n)[order]
        low, high = np.minimum.reduceat(docs, first), np.maximum.reduceat(docs, first)
        key = np.repeat(every[chosen], n)[order[first]]
        dealt = held[first] % parts[np.searchsorted(keys, key)].astype(np.uint64)
        bucket = ((key >> np.uint64(32)) + dealt) % np.uint64(buckets)
        by_bucket = np.argsort(bucket, kind="stable")
        columns = bucket.astype(np.int64), start[order[first]], low, high
        return tuple(column[by_bucket] for column in columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)

        def sent(block_id: int, block: Block, found: Symbols, columns: tuple) -> Iterator:
            """A row per bucket; columns: bucket (ascends), ordinal, start, windows, low, high."""
            bucket = columns[0]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            for a, b in zip(edges, edges[1:], strict=False):
                _, ordinal, start, windows, low, high = (column[a:b] for column in columns)
                data, sizes = _slice_bytes(block, found, shape, start, windows)
                packed = (
                    ordinal.astype("<i4"),
                    windows.astype("u1"),
                    low.astype("<i8"),
                    low < high,
                    sizes.astype("<i4"),
                    data,
                )
                values = [int(bucket[a]), block_id, *(packer.compress(c.tobytes()) for c in packed)]
                kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
                names = [f.split()[0] for f in _ROUTED.split(", ")]
                yield _batch({n: ([v], t) for n, v, t in zip(names, values, kinds, strict=True)})

        def routed(row: dict) -> Iterator[pa.RecordBatch]:
            block = unpack(row)
            found = symbols(block, shape.words)
            got = slices(found, shape, row["copies"])
            order, first, _ = _distinct(got)
            wanted, hot, parts = [], [], []
            for part in row["back"]:
                bucket = np.uint64(part["bucket"]) << np.uint64(32)
                wanted.append(np.frombuffer(part["rest"], "<u4").astype(np.uint64) | bucket)
                rest, n = np.frombuffer(part["hot"], "<u4").reshape(2, -1)
                hot.append(rest.astype(np.uint64) | bucket)
                parts.append(n)
            hot, parts = np.concatenate(hot), np.concatenate(parts)
            one = order[first]
            keys = _keys(got.route[one], buckets)
            chosen = np.flatnonzero(
                np.isin(keys, np.setdiff1d(np.concatenate(wanted), hot, assume_unique=True))
            )
            if len(chosen):
                chosen = chosen[np.argsort(keys[chosen], kind="stable")]
                docs = block.ids[got.owner[order]]
                low, high = np.minimum.reduceat(docs, first), np.maximum.reduceat(docs, first)
                bucket = (keys[chosen] >> np.uint64(32)).astype(np.int64)
                own = got.start[one[chosen]], got.windows[one[chosen]], low[chosen], high[chosen]
                yield from sent(row["block"], block, found, (bucket, chosen, *own))
            if len(hot):
                by_key = np.argsort(hot)
                bucket, start, low, high = hot_windows(
                    block, found, got, hot[by_key], parts[by_key]
                )
                single = np.ones(len(start), np.int64)
                columns = bucket, -1 - start, start, single, low, high
                yield from sent(row["block"], block, found, columns)

        for _, row in common.one_by_one(batches, [*_TEXTS, "back"]):
            yield from routed(row)

    per_block = back.groupBy("block").agg(
        F.collect_list(F.struct("bucket", "rest", "hot")).alias("back")
    )
    joined = blocks.join(per_block, "block")
    return common.arrow_map(joined, work, _ROUTED)


@dataclass
class Bucket:
    """The slices of one bucket: bytes in a row, sizes, windows of each, earliest document."""

    data: np.ndarray
    sizes: np.ndarray
    windows: np.ndarray
    docs: np.ndarray


#: For every window of the bucket, slice by slice, an earlier document that has it, or the own one.
Earliest = Callable[[Bucket], np.ndarray]

_ANSWERS = "block long, ordinals binary, offsets binary, counts binary, docs binary"


def answer(routed: DataFrame, earliest: Earliest) -> DataFrame:
    """Per block, runs of windows with one earliest document that is not the slice's own."""

    def work(table: pa.Table) -> pa.Table:
        found = answers(table)
        common.give_back()
        return found

    def answers(table: pa.Table) -> pa.Table:
        unpacker = zstandard.ZstdDecompressor()

        def parts_of(name: str, kind: str) -> list[np.ndarray]:
            return [np.frombuffer(unpacker.decompress(v.as_buffer()), kind) for v in table[name]]

        def joined(name: str, kind: str) -> np.ndarray:
            return np.concatenate(parts_of(name, kind))

        by_row = parts_of("ordinals", "<i4")
        per_row, ordinals = list(map(len, by_row)), np.concatenate(by_row)
        windows = joined("windows", "u1").astype(np.int64)
        docs, many = joined("docs", "<i8"), joined("many", "u1").astype(bool)
        bucket = Bucket(joined("data", "u1"), joined("sizes", "<i4").astype(np.int64), windows, docs)
        found = earliest(bucket)
        owner = np.repeat(np.arange(len(windows)), windows)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        tells = (found < docs[owner]) | many[owner]
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1]) | ~tells[:-1]
        fresh &= tells
        first = np.flatnonzero(fresh)
        breaks = np.append(np.flatnonzero(~tells | fresh), len(owner))
        count = breaks[np.searchsorted(breaks, first, "right")] - first
        rows = np.repeat(np.arange(len(per_row)), per_row)[owner[first]]
        edges = np.searchsorted(rows, np.arange(len(per_row) + 1))
        spans = list(zip(edges, edges[1:], strict=False))

        def parts(values: np.ndarray, kind: str) -> pa.Array:
            held = values.astype(kind)
            return pa.array([held[a:b].tobytes() for a, b in spans], pa.binary())

        return pa.table(
            {
                "block": table["block"],
                "ordinals": parts(ordinals[owner[first]], "<i4"),
                "offsets": parts(offset[first], "u1"),
                "counts": parts(count, "u1"),
                "docs": parts(found[first], "<i8"),
            }
        ).filter(pa.array([b > a for a, b in spans], pa.bool_()))

    return routed.groupBy("bucket").applyInArrow(work, _ANSWERS)


#: What to make of one block: columns from its texts, symbols and the mask of removed symbols.
Output = Callable[[Block, Symbols, np.ndarray], dict[str, pa.Array]]


def resolve(
    blocks: DataFrame,
    answers: DataFrame,
    shape: Shape,
    output: Output,
    schema: str,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Applies output to every block, with the symbols that an earlier document's window covers."""

    def hot_starts(
        block: Block, found: Symbols, got: Slices, lone: np.ndarray, docs: np.ndarray
    ) -> np.ndarray:
        """Where the windows equal to those at lone start, in documents after docs."""
        order = np.argsort(lone)
        lone, docs = lone[order], docs[order]
        routes = got.route[np.searchsorted(got.start, lone, "right") - 1]
        chosen = np.flatnonzero(np.isin(got.route, routes))
        start = ranges(got.start[chosen], got.windows[chosen])
        owner = np.repeat(got.owner[chosen], got.windows[chosen])
        known = window_hashes(found, shape, lone)
        order = np.argsort(known)
        known, docs = known[order], docs[order]
        hashes = window_hashes(found, shape, start)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return start[(known[at] == hashes) & (docs[at] < block.ids[owner])]

    def removed(
        block: Block, found: Symbols, without: list[int] | None, parts: list[dict]
    ) -> np.ndarray:
        got = slices(found, shape, without)
        order, _, edge = _distinct(got)

        def joined(name: str, kind: str) -> np.ndarray:
            return np.concatenate([np.frombuffer(p[name], kind) for p in parts]).astype(np.int64)

        ordinal, offset = joined("ordinals", "<i4"), joined("offsets", "u1")
        count, docs = joined("counts", "u1"), joined("docs", "<i8")
        single = ordinal < 0
        lone, lone_docs = -1 - ordinal[single], docs[single]
        ordinal, offset, count, docs = (v[~single] for v in (ordinal, offset, count, docs))
        times = edge[ordinal + 1] - edge[ordinal]
        slot = order[ranges(edge[ordinal], times)]
        offset, count, docs = (np.repeat(v, times) for v in (offset, count, docs))
        later = docs < block.ids[got.owner[slot]]
        start = got.start[slot[later]] + offset[later]
        end = start + count[later] + shape.window - 1
        if len(lone):
            own = hot_starts(block, found, got, lone, lone_docs)
            start, end = np.append(start, own), np.append(end, own + shape.window)
        size = len(found.codes) + 1
        return np.cumsum(np.bincount(start, minlength=size) - np.bincount(end, minlength=size))[
            :-1
        ] > 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, row in common.one_by_one(batches, [*_TEXTS, "parts"]):
            columns = marked(row) | {c: one[c].flatten() for c in _carried(carry)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def marked(row: dict) -> dict[str, pa.Array]:
        block = unpack(row)
        found = symbols(block, shape.words)
        gone = np.zeros(len(found.codes), bool)
        if row["parts"]:
            gone = removed(block, found, row["copies"], row["parts"])
        for text in row["copies"] or ():
            first, last = found.edges[text], found.edges[text + 1]
            if not shape.words:
                last -= 1  # the line feed
            gone[first:last] = last - first >= shape.window
        ids = pa.array(block.ids, mask=block.ids == NO_ID)
        return {"doc_id": ids, **output(block, found, gone)}

    fields = ("ordinals", "offsets", "counts", "docs")
    per_block = answers.groupBy("block").agg(F.collect_list(F.struct(*fields)).alias("parts"))
    joined = blocks.join(per_block, "block", "left")
    types = dict(blocks.dtypes)
    fields = [schema, *(f"{c} {types[c][len('array<') : -1]}" for c in _carried(carry))]
    return common.arrow_map(joined, work, ", ".join(fields))


def without_repeats(
    docs: DataFrame,
    shape: Shape,
    earliest: Earliest,
    output: Output,
    schema: str,
    carry: tuple[str, ...] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All steps over (doc_id, text); schema: doc_id and what output makes.

    The result has these columns and then carry_0, carry_1, ..., in the order of carry.
    """
    blocks = pack(docs, carry, block_bytes)
    buckets = bucket_count(blocks)
    # The blocks are shuffled once, by their number; all joins below use that exchange.
    texts = blocks.drop("digests", "bytes").join(copies(blocks), "block", "left")
    back = repeated(anchors(texts, shape, buckets), shape, HOT_WINDOWS)
    answers = answer(route(texts, back, shape, buckets), earliest)
    return resolve(texts, answers, shape, output, schema, carry)
