"""Token ids of whole texts, by word, with a bounded cache."""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries that a Python worker keeps; words beyond them are encoded again in each batch.
CACHED_WORDS = 100_000
_PIECE_BYTES = 2 << 20

#: Letters whose lower case and composed form are one letter each, then plain punctuation. The
#: vocabulary's own pattern also ends a token between the two, so both parts stand alone.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|]*)")


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write each byte: visible Latin-1 as itself, others from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (byte for byte in range(256) if byte not in shown)
    return {byte: chr(byte) for byte in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Encodes texts as `tokenizers` does, each distinct word of a batch once.

    The vocabulary must drop white space and never join words across it (as
    `word_bpe_49k.json` does), so the ids of a text are those of its words in a row. Words are
    cut at spaces and line feeds alone; anything else stays within a word and is left to the
    library.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.cached = cached
        self.slot: dict[str, int] = {}
        self.known: dict[str, list[int]] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 12, np.int64)
        self.length = np.zeros(1 << 12, np.int64)
        self.n_ids = self.n_slots = 0

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _remembered(self, part: str, encode) -> list[int]:
        ids = self.known.get(part)
        if ids is None:
            ids = encode(part)
            if len(self.known) < self.cached:
                self.known[part] = ids
        return ids

    def _word(self, part: str) -> list[int]:
        # Letters of ASCII are written as they are.
        if part.isascii():
            shown = part
        else:
            shown = "".join(map(self.letters.__getitem__, part.encode()))
        return [token.id for token in self.model.tokenize(shown)]

    def _encode(self, word: str) -> list[int]:
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._whole(word)
        letters, marks = plain.groups()
        letters = letters.lower()
        ids = self.known.get(letters) or self._remembered(letters, self._word)
        return ids + self._remembered(marks, self._whole) if marks else ids

    def _add(self, words: list[list[int]]) -> np.ndarray:
        """Stores the ids of words at the next free places; returns how many ids each word has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = self.n_ids + np.cumsum(lengths)
        n_ids, n_slots = self.n_ids + int(lengths.sum()), self.n_slots + len(words)
        while n_ids > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n_slots > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        ids = itertools.chain.from_iterable(words)
        self.flat[self.n_ids : n_ids] = np.fromiter(ids, np.uint32, n_ids - self.n_ids)
        self.start[self.n_slots : n_slots] = ends - lengths
        self.length[self.n_slots : n_slots] = lengths
        self.n_ids, self.n_slots = n_ids, n_slots
        return lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts together and how many each text has. Nulls count as empty."""
        spaced = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        parts = pc.split_pattern(spaced, " ")
        per_text = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        coded = parts.flatten().dictionary_encode()
        vocabulary = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = map(self.slot.get, vocabulary, itertools.repeat(-1))
        slots = np.fromiter(known, np.int64, len(vocabulary))
        places = np.flatnonzero(slots < 0)
        fresh = [vocabulary[place] for place in places.tolist()]
        # What goes beyond the kept words is given back at the end of the batch.
        kept = fresh[: max(0, self.cached - len(self.slot))]
        keep_ids, keep_slots = self.n_ids, self.n_slots + len(kept)
        slots[places] = np.arange(self.n_slots, self.n_slots + len(fresh))
        self.slot.update(zip(kept, range(self.n_slots, keep_slots), strict=True))
        keep_ids += int(self._add([self._encode(word) for word in fresh])[: len(kept)].sum())
        used = slots[coded.indices.to_numpy(zero_copy_only=False)]
        length = self.length[used]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        shift = self.start[used] - (ends - length)
        ids = self.flat[np.repeat(shift, length) + np.arange(total)]
        self.n_ids, self.n_slots = keep_ids, keep_slots
        before = np.concatenate([[0], ends])
        edges = np.concatenate([[0], np.cumsum(per_text)])
        return ids, np.diff(before[edges])

    def encode_rows(
        self, batch: pa.RecordBatch, text_col: str = "text"
    ) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of each text; a very long text is encoded in parts cut at a space."""
        texts = batch[text_col]
        sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        row = 0
        while row < len(texts):
            if sizes[row] > _PIECE_BYTES:
                pieces = [self.encode(pa.array([p]))[0] for p in _pieces(texts[row].as_py())]
                yield row, np.concatenate(pieces)
                row += 1
                continue
            end, total = row, 0
            while end < len(texts) and total + sizes[end] <= _PIECE_BYTES:
                total += sizes[end]
                end += 1
            ids, counts = self.encode(texts.slice(row, end - row))
            edges = np.concatenate([[0], np.cumsum(counts)])
            for k in range(end - row):
                yield row + k, ids[edges[k] : edges[k + 1]]
            row = end


def _pieces(text: str, size: int = _PIECE_BYTES // 2) -> Iterator[str]:
    start = 0
    while start < len(text):
        end = start + size
        if end < len(text):
            cut = max(text.rfind(" ", start, end), text.rfind("\n", start, end))
            if cut <= start:  # one word longer than a piece: up to the next white space
                after = [p for p in (text.find(" ", end), text.find("\n", end)) if p >= 0]
                cut = min(after, default=len(text))
            end = cut
        yield text[start:end]
        start = end


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file; tasks of one worker share it."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def ids_crc32(ids: np.ndarray, crc: int = 0) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers, continuing from crc."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"), crc)
