"""Byte strings that an earlier document has, by longest previous factors in suffix order.

Within a bucket, the suffixes that begin its windows are sorted by their first bytes, as many as a
window has. A suffix's longest previous factor is the longer of the prefixes that it shares with the
nearest suffix before it and the nearest after it, in this order, that belong to an earlier document;
each is the least of the common prefixes of neighbours on the way. Prefixes count up to the length of
a window: a factor that reaches it is repeated, and no removal asks for more.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeflow.llm import common, repeats

LENGTH = 50
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
#: Windows that are sorted together.
_TOGETHER = 400_000


def _words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number, zero beyond the end."""
    part = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        part = part[:-size] << np.uint64(8 * size) | part[size:]
    return part


def suffix_order(words: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that begin at start, by their first `length` bytes, and how many of
    these each shares with the one before it."""
    offsets = [*range(0, length - 7, 8)]
    if length % 8:
        offsets.append(length - 8)
    keys = [words[start + offset] for offset in offsets]
    order = np.lexsort(keys[::-1])
    common_prefix = np.zeros(len(order), np.int32)
    open_ones = np.arange(1, len(order))
    for offset, key in zip(offsets, keys, strict=True):
        held = key[order]
        differs = held[open_ones] ^ held[open_ones - 1]
        # Leading equal bytes of big-endian numbers.
        equal = np.zeros(len(differs), np.int32)
        for size in range(1, 9):
            equal += differs >> np.uint64(64 - 8 * size) == 0
        common_prefix[open_ones] = np.minimum(offset + equal, length)
        open_ones = open_ones[differs == 0]
    return order, common_prefix


def previous_smaller(
    docs: np.ndarray, common_prefix: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the nearest earlier place with a smaller document, and their common prefix.

    docs, common_prefix: by place in suffix order. Every place points to one before it, with no
    smaller document in between, and jumps to what that one points to until its document is smaller
    too; the jumps double. A place whose common prefix has fallen below length stops and has 0.
    """
    found = np.arange(-1, len(docs) - 1)
    shared = common_prefix.copy()
    shared[:1] = 0
    going = np.flatnonzero(shared >= length)
    going = going[docs[found[going]] >= docs[going]]
    while len(going):
        at = found[going]
        least, farther = np.minimum(shared[going], shared[at]), found[at]
        shared[going], found[going] = least, farther
        going = going[least >= length]
        going = going[docs[found[going]] >= docs[going]]
    return found, np.where(shared >= length, shared, 0)


def longest_previous_factors(
    docs: np.ndarray, common_prefix: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Length, 0 if under `length`, and document of the longest factor of each suffix that also
    begins in an earlier document; the own document where there is none."""
    before, shared_before = previous_smaller(docs, common_prefix, length)
    # Seen from the other end, the common prefix belongs to the place after.
    mirrored = np.append(common_prefix[1:], 0)[::-1]
    after, shared_after = previous_smaller(docs[::-1], mirrored, length)
    after, shared_after = len(docs) - 1 - after[::-1], shared_after[::-1]
    factor = np.maximum(shared_before, shared_after)
    place = np.where(shared_before >= shared_after, before, after)
    return factor, np.where(factor >= length, docs[np.minimum(place, len(docs) - 1)], docs)


def earliest(bucket: repeats.Bucket, length: int = LENGTH) -> np.ndarray:
    """An earlier document that has each window, or its own one."""
    words = _words_at(bucket.data)
    first = np.cumsum(bucket.sizes) - bucket.sizes
    start = repeats.ranges(first, bucket.windows)
    known, ranks = np.unique(bucket.docs, return_inverse=True)
    ranks = np.repeat(ranks, bucket.windows)
    found = np.empty(len(start), np.int64)
    # Equal windows have equal numbers here, so parts can be sorted one after the other.
    parts = -(-len(start) // _TOGETHER)
    mixed = common.mix64(words[start] + common.mix64(words[start + length - 8]))
    part = (mixed % np.uint64(max(parts, 1))).astype(np.int32)
    for k in range(parts):
        own = np.flatnonzero(part == k)
        order, common_prefix = suffix_order(words, start[own], length)
        if len(order):
            _, source = longest_previous_factors(ranks[own[order]], common_prefix, length)
            found[own[order]] = source
    return known[found]


def _digest(block: repeats.Block, found: repeats.Symbols, gone: np.ndarray) -> dict[str, pa.Array]:
    edges = block.edges
    upto = np.concatenate([[0], np.cumsum(gone)])
    removed = upto[edges[1:]] - upto[edges[:-1]]
    begins = gone & ~np.concatenate([[False], gone[:-1]])
    upto = np.concatenate([[0], np.cumsum(begins)])
    spans = upto[edges[1:]] - upto[edges[:-1]]
    kept = block.data[~gone].tobytes()
    kept_edges = edges - np.concatenate([[0], np.cumsum(removed)])
    digests = [
        hashlib.sha256(kept[a : b - 1]).hexdigest()
        for a, b in zip(kept_edges.tolist(), kept_edges[1:].tolist(), strict=False)
    ]
    return {
        "n_bytes": pa.array(np.diff(edges) - 1),
        "n_removed": pa.array(removed),
        "n_spans": pa.array(spans),
        "kept_sha256": pa.array(digests),
    }


def _cut(block: repeats.Block, found: repeats.Symbols, gone: np.ndarray) -> dict[str, pa.Array]:
    flips = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
    start, end = np.flatnonzero(flips > 0), np.flatnonzero(flips < 0)
    at = np.searchsorted(start, block.edges)
    kept, spans = [], []
    for k in range(len(block.ids)):
        own = ~gone[block.edges[k] : block.edges[k + 1] - 1]
        kept.append(block.text(k)[own].tobytes())
        own_spans = np.stack([start, end], 1)[at[k] : at[k + 1]] - block.edges[k]
        spans.append([{"start": int(a), "end": int(b)} for a, b in own_spans])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return {"kept": pa.array(kept, pa.binary()), "spans": pa.array(spans, kind)}


def _shape(length: int) -> repeats.Shape:
    if length < 16:
        raise ValueError("strings under 16 bytes are too common to route")
    return repeats.Shape(window=length, gram=(length + 2) // 2, words=False)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, kept (the bytes that stay), spans (removed byte ranges) of (doc_id, text)."""
    schema = "doc_id long, kept binary, spans array<struct<start: long, end: long>>"
    return repeats.without_repeats(
        docs, _shape(length), lambda bucket: earliest(bucket, length), _cut, schema
    )


def digest_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Counts and the digest of what stays of every (doc_id, text).

    A byte goes if a string of `length` bytes that covers it also starts in a document with a
    smaller doc_id; texts are judged as they came. Null and empty texts, and texts shorter than
    that, stay whole. Rows with one doc_id are never each other's source; a null doc_id counts as
    the largest. Texts are read whole; one longer than a block is a block of its own. Other columns
    are ignored. An empty table gives no rows.
    """
    return repeats.without_repeats(
        docs, _shape(length), lambda bucket: earliest(bucket, length), _digest, SCHEMA
    )
