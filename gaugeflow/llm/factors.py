"""Word passages that an earlier document has, by relative Lempel-Ziv parsing.

The slices of a bucket are its reference block, indexed by their windows of words. Each slice is
parsed greedily against what earlier documents put into the block: where a window has such a source,
the factor goes on as long as the next words agree, and all windows inside it are repeated. Windows
across the end of a factor are looked up one by one, and may start the next factor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import repeats

WORDS = 13
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def word_codes(data: np.ndarray) -> np.ndarray:
    """One number per word of bytes in which each word ends with a space; equal for equal words."""
    ends = np.flatnonzero(data == 32) + 1
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    words = pa.Array.from_buffers(pa.large_binary(), len(ends), buffers)
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64)


def index_windows(codes: np.ndarray, start: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts in the order of their words, and whether each equals the one before it."""
    bits = max(int(codes.max(initial=0)).bit_length(), 1)
    together = 64 // bits
    keys = []
    for first in range(0, words, together):
        key = np.zeros(len(start), np.uint64)
        for k in range(first, min(first + together, words)):
            key = key << np.uint64(bits) | codes[start + k]
        keys.append(key)
    order = np.lexsort(keys[::-1])
    same = np.ones(len(order), bool)
    same[:1] = False
    for key in keys:
        held = key[order]
        same[1:] &= held[1:] == held[:-1]
    return order, same


def earliest(bucket: repeats.Bucket, words: int = WORDS) -> np.ndarray:
    """An earlier document that has each window, or its own one."""
    codes = word_codes(bucket.data)
    n_words = bucket.windows + words - 1
    first_word = np.cumsum(n_words) - n_words
    first_window = np.cumsum(bucket.windows) - bucket.windows
    start = repeats.ranges(first_word, bucket.windows)
    owner = np.repeat(np.arange(len(n_words)), bucket.windows)
    docs = bucket.docs[owner]
    order, same = index_windows(codes, start, words)
    # The index: for each window, the window of the earliest document with the same words.
    group = np.cumsum(~same) - 1
    by_doc = order[np.lexsort((docs[order], group))]
    source = np.empty(len(start), np.int64)
    source[order] = by_doc[np.flatnonzero(~same)][group]

    found = docs.copy()
    at = np.zeros(len(n_words), np.int64)
    active = np.flatnonzero(bucket.windows > 0)
    while len(active):
        window = first_window[active] + at[active]
        from_window = source[window]
        hit = docs[from_window] < docs[window]
        # The factor goes on while both places have the same next word.
        here, there = start[window[hit]] + words, start[from_window[hit]] + words
        end_here = first_word[active[hit]] + n_words[active[hit]]
        from_slice = owner[from_window[hit]]
        end_there = first_word[from_slice] + n_words[from_slice]
        more = np.zeros(len(here), np.int64)
        going = np.arange(len(here))
        while len(going):
            a, b = here[going] + more[going], there[going] + more[going]
            inside = (a < end_here[going]) & (b < end_there[going])
            going, a, b = going[inside], a[inside], b[inside]
            going = going[codes[a] == codes[b]]
            more[going] += 1
        # The factor decides for all windows inside it.
        covered = repeats.ranges(window[hit], more + 1)
        found[covered] = np.repeat(docs[from_window[hit]], more + 1)
        step = np.ones(len(active), np.int64)
        step[hit] += more
        at[active] += step
        active = active[at[active] < bucket.windows[active]]
    return found


def _digest(block: repeats.Block, found: repeats.Symbols, gone: np.ndarray) -> dict[str, pa.Array]:
    upto = np.concatenate([[0], np.cumsum(gone)])
    removed = upto[found.edges[1:]] - upto[found.edges[:-1]]
    stay = np.flatnonzero(~gone)
    size = found.length[stay] + 1
    data = block.data[repeats.ranges(found.start[stay], size)]
    ends = np.concatenate([[0], np.cumsum(size)])
    data[ends[1:] - 1] = 32
    kept = data.tobytes()
    edges = ends[found.edges - upto[found.edges]].tolist()
    digests = [
        hashlib.sha256(kept[a : max(b - 1, a)]).hexdigest()
        for a, b in zip(edges, edges[1:], strict=False)
    ]
    return {
        "n_words": pa.array(np.diff(found.edges)),
        "n_removed": pa.array(removed),
        "kept_sha256": pa.array(digests),
    }


def _cut(block: repeats.Block, found: repeats.Symbols, gone: np.ndarray) -> dict[str, pa.Array]:
    """The texts without removed words and the white space after them; all else as it was."""
    until = np.append(found.start[1:], len(block.data))[gone]
    text = np.searchsorted(found.edges, np.flatnonzero(gone), "right")
    until = np.minimum(until, block.edges[text] - 1)
    size = len(block.data) + 1
    begins = np.bincount(found.start[gone], minlength=size)
    stay = np.cumsum(begins - np.bincount(until, minlength=size))[:-1] == 0
    upto = np.concatenate([[0], np.cumsum(gone)])
    removed = upto[found.edges[1:]] - upto[found.edges[:-1]]
    kept = block.data[stay].tobytes()
    edges = np.concatenate([[0], np.cumsum(stay)])[block.edges].tolist()
    texts = [kept[a : b - 1].decode() for a, b in zip(edges, edges[1:], strict=False)]
    return {"text": pa.array(texts, pa.string()), "n_removed": pa.array(removed)}


def _shape(words: int) -> repeats.Shape:
    return repeats.Shape(window=words, gram=(words + 1) // 2, words=True)


def remove_repeats(
    docs: DataFrame,
    words: int = WORDS,
    carry: tuple[str, ...] = (),
    block_bytes: int = repeats.BLOCK_BYTES,
) -> DataFrame:
    """doc_id, text (what stays), n_removed and the carried columns of (doc_id, text, ...).

    A carried column that is called n_removed takes the place of the count.
    """
    cut = repeats.without_repeats(
        docs,
        _shape(words),
        lambda bucket: earliest(bucket, words),
        _cut,
        "doc_id long, text string, n_removed long",
        carry,
        block_bytes,
    )
    carried = [F.col(f"carry_{k}").alias(c) for k, c in enumerate(carry)]
    own = ["doc_id", "text"] if "n_removed" in carry else ["doc_id", "text", "n_removed"]
    return cut.select(*own, *carried)


def digest_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Counts and the digest of the words that stay of every (doc_id, text).

    A word goes if a window of `words` words that covers it also starts in a document with a
    smaller doc_id; texts are judged as they came. Null, empty and blank texts have no words; texts
    with fewer words than a window stay whole. Rows with one doc_id are never each other's source; a
    null doc_id counts as the largest. Texts are read whole; one longer than a block is a block of
    its own. Other columns are ignored. An empty table gives no rows.
    """
    return repeats.without_repeats(
        docs, _shape(words), lambda bucket: earliest(bucket, words), _digest, SCHEMA
    )
