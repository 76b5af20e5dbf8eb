"""Token-id shards as compressed planes: blocks of ids, transposed, with a chunk index.

A shard file is

    b"PLANES1\\n"
    for each block of at most `block` ids: the frames of its planes, one after the other
    the chunk index: per block (uint64 offset, uint32 ids, uint32 bytes of each plane)
    b"PLANIDX\\n", then as little-endian uint64: offset of the index, number of blocks, number of
    planes (4: byte planes, 32: bit planes)

Plane k holds byte (or bit) k of every id of the block. A plane of zeros takes no bytes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common, tokens
from gaugeflow.session import fresh_dir

MAGIC, INDEX_MAGIC = b"PLANES1\n", b"PLANIDX\n"
BLOCK = 1 << 16


def planes_of(ids: np.ndarray, planes: int) -> Iterator[bytes]:
    """The planes of one block, least significant first; empty for a plane of zeros."""
    by_byte = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    for k in range(planes):
        if planes == 4:
            plane = np.ascontiguousarray(by_byte[:, k])
        else:
            plane = np.packbits(by_byte[:, k // 8] >> (k % 8) & 1, bitorder="little")
        yield plane.tobytes() if plane.any() else b""


def ids_of(planes: list[bytes], n: int) -> np.ndarray:
    by_byte = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(planes):
        if not plane:
            continue
        raw = np.frombuffer(plane, np.uint8)
        if len(planes) == 4:
            by_byte[:, k] = raw
        else:
            by_byte[:, k // 8] |= np.unpackbits(raw, count=n, bitorder="little") << (k % 8)
    return by_byte.view("<u4").reshape(-1)


class ShardWriter:
    """Takes runs of ids and writes full blocks as they come; memory holds one block."""

    def __init__(self, folder: str, planes: int, block: int, level: int):
        if planes not in (4, 32):
            raise ValueError("planes: 4 (bytes) or 32 (bits)")
        self.name, self.out = common.new_file(folder, ".planes")
        self.planes, self.block = planes, block
        self.packer = zstandard.ZstdCompressor(level=level)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.index: list[tuple] = []
        self.at = self.out.write(MAGIC)

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(np.uint32))
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block:
            every = np.concatenate(self.waiting)
            full = len(every) // self.block * self.block
            for start in range(0, full, self.block):
                self._write(every[start : start + self.block])
            self.waiting, self.n_waiting = [every[full:]], len(every) - full

    def _write(self, ids: np.ndarray) -> None:
        frames = [self.packer.compress(p) if p else b"" for p in planes_of(ids, self.planes)]
        self.index.append((self.at, len(ids), tuple(map(len, frames))))
        self.at += sum(self.out.write(frame) for frame in frames)

    def close(self) -> None:
        if self.n_waiting:
            self._write(np.concatenate(self.waiting))
        self.out.write(np.array(self.index, _entry(self.planes)).tobytes())
        tail = np.array([self.at, len(self.index), self.planes], "<u8")
        self.out.write(INDEX_MAGIC + tail.tobytes())
        self.out.close()


def _entry(planes: int) -> np.dtype:
    return np.dtype([("offset", "<u8"), ("ids", "<u4"), ("sizes", "<u4", (planes,))])


class ShardReader:
    """Ids by position in a shard; only the blocks asked for are read."""

    def __init__(self, folder: str, name: str):
        system, path = common.open_fs(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        tail = self.file.read_at(len(INDEX_MAGIC) + 24, size - len(INDEX_MAGIC) - 24)
        if tail[: len(INDEX_MAGIC)] != INDEX_MAGIC:
            raise ValueError(f"{name}: not a whole shard")
        offset, blocks, planes = np.frombuffer(tail[len(INDEX_MAGIC) :], "<u8").tolist()
        raw = self.file.read_at(blocks * _entry(planes).itemsize, offset)
        self.index = np.frombuffer(raw, _entry(planes))
        self.ends = np.cumsum(self.index["ids"].astype(np.int64))
        self.unpacker = zstandard.ZstdDecompressor()
        self.last: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint32))

    def block(self, k: int) -> np.ndarray:
        if self.last[0] != k:
            entry = self.index[k]
            sizes = entry["sizes"].astype(np.int64)
            raw = self.file.read_at(int(sizes.sum()), int(entry["offset"]))
            edges = np.concatenate([[0], np.cumsum(sizes)])
            frames = [raw[a:b] for a, b in zip(edges, edges[1:], strict=False)]
            planes = [self.unpacker.decompress(f) if f else b"" for f in frames]
            self.last = k, ids_of(planes, int(entry["ids"]))
        return self.last[1]

    def runs(self, start: int, length: int) -> Iterator[np.ndarray]:
        """The ids from start on, a part of one block at a time."""
        end, k = start + length, int(np.searchsorted(self.ends, start, "right"))
        while start < end:
            first = int(self.ends[k - 1]) if k else 0
            part = self.block(k)[start - first : end - first]
            yield part
            start, k = start + len(part), k + 1


#: Bytes of ids that a task reads back, about.
READ_BYTES = 64 << 20
INDEX_SCHEMA = "shard int, file string, doc_id long, shard_start long, n_tokens long"


def write_shards(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int | None = 2,
    planes: int = 4,
    block: int = BLOCK,
    level: int = 1,
) -> DataFrame:
    """Encodes (doc_id, text) into one shard file per range of ids; returns its stored index.

    Shards follow each other in ascending doc_id, null first. A null text is empty and has the
    end id alone. Rows that share a doc_id each keep their own place, in any order. An empty table
    gives an empty index.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode = tokens.encoder(vocabulary)
        out, found = None, []
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in common.cut_batches(batches):
            out = out or ShardWriter(folder, planes, block, level)
            doc_ids = batch["doc_id"].to_pylist()
            for row, ids in encode.encode_rows(batch):
                found.append((shard, out.name, doc_ids[row], out.n_ids, len(ids) + len(end)))
                out.add(ids)
                out.add(end)
        if out:
            out.close()
        columns = list(zip(*found, strict=True)) or [[]] * 5
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = [part.split()[0] for part in INDEX_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    ranged = docs.repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id")
    return common.stored(common.arrow_map(ranged, write, INDEX_SCHEMA), "planes-index")


def with_global_start(index: DataFrame) -> DataFrame:
    """Adds start: ids of all earlier documents. Only one row per shard meets in one place."""
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = shards.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return index.join(before, "shard").withColumn("start", F.col("before") + F.col("shard_start"))


def read_documents(index: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of indexed documents, from the shard files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name = None, None
        for batch in batches:
            files = batch["file"].to_pylist()
            starts, lengths = batch["shard_start"].to_pylist(), batch["n_tokens"].to_pylist()
            sums = []
            for file, start, length in zip(files, starts, lengths, strict=True):
                if file != name:
                    reader, name = ShardReader(folder, file), file
                sums.append(
                    functools.reduce(
                        lambda crc, ids: tokens.ids_crc32(ids, crc), reader.runs(start, length), 0
                    )
                )
            kept = [batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(kept, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # As many tasks as there are ids to read; the index alone would look small to the engine.
    total = index.agg(F.sum("n_tokens")).first()[0] or 0
    tasks = max(1, 4 * total // READ_BYTES)
    near = index.repartition(tasks, "file").sortWithinPartitions("file", "shard_start")
    return common.arrow_map(near, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Writes the ids of all documents into shards in the shared folder and reads them back.

    One row per row of (doc_id, text): doc_id, start, n_tokens, ids_crc32. A null or empty text has
    just the end id (without one: no ids, and the checksum of nothing). Texts of any length are
    encoded whole. Rows that share a doc_id are documents of their own, in any order among each
    other; missing ids come first. An empty table gives no rows.
    """
    folder = fresh_dir(docs.sparkSession, "planes")
    index = write_shards(docs, folder, vocabulary, **options)
    return read_documents(with_global_start(index), folder)
