"""Language of a text by a convolutional network on its bytes, trained and run in numpy.

Bytes become vectors, filters of several widths slide over them, each filter keeps its largest
answer within a window of fixed length, and a softmax layer turns these into language
probabilities. A text is cut into windows that cover all of it; its probabilities are the mean
over its windows, each weighted by its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common

WINDOW = 256
UNKNOWN = "und"
#: Windows that go through the network together: 64 KB of text, so that everything stays in cache.
_TOGETHER = 128
_LETTER = "\\p{L}"
_LETTERED = "__has_letter"
_HASHES = 1 << 40


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the training. The sample is the only thing that reaches the driver.

    At most `per_language` documents of each of the `languages` most frequent languages are taken,
    those with the smallest hash of their id, and of each a stretch of at most `sample_chars`
    characters. Rarer languages are not learned.
    """

    per_language: int = 1500
    languages: int = 200
    sample_chars: int = 500
    epochs: int = 6
    #: A small sample is gone through more often, up to so many steps.
    least_steps: int = 800
    rate: float = 0.01
    batch: int = 64
    seed: int = 7


@dataclass(frozen=True)
class Network:
    """embed: (257, d), with a zero row for padding; filters: (width * d, n) for each width."""

    languages: tuple[str, ...]
    widths: tuple[int, ...]
    embed: np.ndarray
    filters: tuple[np.ndarray, ...]
    filter_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(windows, languages), of windows of byte values with 256 as padding."""
        return _softmax(np.maximum(self._pooled(windows), 0) @ self.out + self.out_bias)

    def _pooled(self, windows: np.ndarray) -> np.ndarray:
        vectors = self.embed[windows]
        peaks = [_grams(vectors, w) @ f for w, f in zip(self.widths, self.filters, strict=True)]
        return np.concatenate([p.max(axis=1) for p in peaks], axis=1) + self.filter_bias


def _grams(vectors: np.ndarray, width: int) -> np.ndarray:
    """(windows, positions, width * d): the vectors of each run of width bytes side by side."""
    n, length, d = vectors.shape
    flat = np.lib.stride_tricks.sliding_window_view(vectors.reshape(n, length * d), width * d, 1)
    return np.ascontiguousarray(flat[:, ::d])


def _softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def window_places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, bytes held) of the windows that cover texts with these edges.

    An empty text has no window; the last one of a text may hold less than a whole window.
    """
    sizes = np.diff(offsets)
    per_text = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), per_text)
    first = np.cumsum(per_text) - per_text
    start = offsets[:-1][owner] + (np.arange(len(owner)) - first[owner]) * WINDOW
    return owner, start, np.minimum(WINDOW, offsets[1:][owner] - start)


def fill_windows(data: np.ndarray, start: np.ndarray, held: np.ndarray) -> np.ndarray:
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < held[:, None]
    return np.where(inside, data[np.minimum(at, len(data) - 1)], 256).astype(np.int16)


def train(texts: list[str], labels: list[str], settings: Training = Training()) -> Network:
    """Fits a network; the same input gives the same network on one kind of machine."""
    languages = tuple(sorted(set(labels)))
    data, offsets = common.text_bytes(pa.array(texts, pa.large_string()))
    owner, start, held = window_places(offsets)
    windows = fill_windows(data, start, held)
    target = np.array([languages.index(label) for label in labels])[owner]
    # Short remainders of longer texts say little; texts shorter than a window stay.
    whole = (held >= 32) | (np.bincount(owner, minlength=len(texts))[owner] == 1)
    windows, target = windows[whole], target[whole]
    draw = np.random.default_rng(settings.seed)
    d, each, widths = 8, 12, (2, 3, 4)
    embed = draw.normal(0, 0.5, (257, d)).astype(np.float32)
    embed[256] = 0
    filters = [draw.normal(0, 1 / np.sqrt(w * d), (w * d, each)).astype(np.float32) for w in widths]
    n_filters = each * len(widths)
    bias = np.zeros(n_filters, np.float32)
    out = draw.normal(0, 0.1, (n_filters, len(languages))).astype(np.float32)
    out_bias = np.zeros(len(languages), np.float32)
    weights = [embed, *filters, bias, out, out_bias]
    # Balances the languages without dropping any window.
    share = np.bincount(target, minlength=len(languages)).astype(np.float32)
    weight = (len(target) / (len(languages) * np.maximum(share, 1)))[target].astype(np.float32)
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step = 0
    per_epoch = -(-len(windows) // settings.batch)
    for _ in range(max(settings.epochs, -(-settings.least_steps // per_epoch))):
        order = draw.permutation(len(windows))
        for k in range(0, len(order), settings.batch):
            pick = order[k : k + settings.batch]
            # Texts of any length come up later, so some of the windows are seen cut short.
            x = windows[pick].copy()
            keep = np.where(draw.random(len(pick)) < 0.3, draw.integers(8, 64, len(pick)), WINDOW)
            x[np.arange(WINDOW) >= keep[:, None]] = 256
            grads = _gradients(x, target[pick], weight[pick], widths, each, weights)
            step += 1
            rate = settings.rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * m / (np.sqrt(v) + 1e-8)
            embed[256] = 0
    return Network(languages, widths, embed, tuple(filters), bias, out, out_bias)


def _gradients(
    x: np.ndarray,
    target: np.ndarray,
    weight: np.ndarray,
    widths: tuple[int, ...],
    each: int,
    weights: list[np.ndarray],
) -> list[np.ndarray]:
    embed, *filters, bias, out, out_bias = weights
    d, rows = embed.shape[1], np.arange(len(x))
    vectors = embed[x]
    grams = [_grams(vectors, w) for w in widths]
    answers = [g @ f for g, f in zip(grams, filters, strict=True)]
    peaks = [a.argmax(axis=1) for a in answers]
    pooled = [np.take_along_axis(a, p[:, None], 1)[:, 0] for a, p in zip(answers, peaks, strict=True)]
    hidden = np.concatenate(pooled, axis=1) + bias
    active = np.maximum(hidden, 0)
    error = _softmax(active @ out + out_bias)
    error[rows, target] -= 1
    error *= (weight / len(x))[:, None]
    back = (error @ out.T) * (hidden > 0)
    embed_grad = np.zeros_like(embed)
    filter_grads = []
    for k, (w, f) in enumerate(zip(widths, filters, strict=True)):
        part = back[:, k * each : (k + 1) * each]
        at = grams[k][rows[:, None], peaks[k]]  # (windows, filters, width * d)
        filter_grads.append(np.einsum("bfi,bf->if", at, part).astype(np.float32))
        to_vectors = (part[:, :, None] * f.T[None]).reshape(-1, w, d)
        seen = x[rows[:, None, None], peaks[k][:, :, None] + np.arange(w)].reshape(-1, w)
        np.add.at(embed_grad, seen.ravel(), to_vectors.reshape(-1, d))
    return [embed_grad, *filter_grads, back.sum(0), active.T @ error, error.sum(0)]


def in_fold(doc_id: Column, fold: int, folds: int = 4) -> Column:
    return (F.crc32(doc_id.cast("string").cast("binary")) % folds == fold).eqNullSafe(True)


def training_sample(
    docs: DataFrame, settings: Training = Training(), held_out_fold: int | None = 2
) -> tuple[list[str], list[str]]:
    """Texts and labels for the training, bounded as Training says.

    docs: doc_id, text, lang. Only labelled rows outside the held-out fold, with a letter.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(_LETTER))
    if held_out_fold is not None:
        usable = usable.filter(~in_fold(F.col("doc_id"), held_out_fold))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"))
    # One row per language, at most `languages` of them, comes to the driver.
    languages = counts.orderBy(F.desc("n"), "lang").limit(settings.languages).collect()
    if not languages:
        return [], []
    # Hashes under a language's bound are some twice as many as wanted, however many rows it has,
    # so that ranking them is little work for its one task.
    bounds = [
        (lang, min(_HASHES, 2 * (settings.per_language + 50) * _HASHES // n))
        for lang, n in languages
    ]
    bounds = docs.sparkSession.createDataFrame(bounds, "lang string, bound long")
    # A stretch from anywhere in the text, so that openings do not stand for everything.
    room = F.greatest(F.length("text") - settings.sample_chars, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("lang", "doc_id"), room).cast("int") + 1
    part = F.substring(F.col("text"), start, F.lit(settings.sample_chars))
    order = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(_HASHES))
    drawn = usable.withColumn("h", order).join(F.broadcast(bounds), "lang")
    ranked = drawn.filter("h < bound").select("lang", "h", part.alias("part")).withColumn(
        "k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "part"))
    )
    taken = ranked.filter(F.col("k") <= settings.per_language)
    rows = taken.select("lang", "part").orderBy("lang", "h", "part").collect()
    return [row.part for row in rows], [row.lang for row in rows]


def predict(docs: DataFrame, network: Network | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the keep columns, lang_pred and score of every (doc_id, text, ...).

    `und` with score 0 where the text is null or has no letter, or nothing could be learned.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.cut_batches([whole]):
                names, scores = _predict(batch, network)
                kept = [batch[c] for c in ("doc_id", *keep)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", *keep, "lang_pred", "score"],
                )

    has_letter = F.coalesce(F.col("text").rlike(_LETTER), F.lit(False))
    others = [c for c in keep if c != "text"]
    lettered = docs.select("doc_id", "text", *others, has_letter.alias(_LETTERED))
    kinds = dict(lettered.dtypes)
    fields = ", ".join(f"`{name}` {kinds[name]}" for name in ("doc_id", *keep))
    return common.arrow_map(lettered, work, f"{fields}, lang_pred string, score double")


def _predict(batch: pa.RecordBatch, network: Network | None) -> tuple[list[str], np.ndarray]:
    data, offsets = common.text_bytes(batch["text"])
    lettered = batch[_LETTERED].to_numpy(zero_copy_only=False).astype(bool)
    n = batch.num_rows
    if network is None or not len(network.languages):
        return [UNKNOWN] * n, np.zeros(n)
    total = np.zeros((n, len(network.languages)))
    owner, start, held = window_places(offsets)
    # A text of any length goes through in stretches of whole windows.
    for k in range(0, len(owner), _TOGETHER):
        part = slice(k, k + _TOGETHER)
        found = network.probabilities(fill_windows(data, start[part], held[part]))
        np.add.at(total, owner[part], found * held[part, None])
    sizes = np.diff(offsets)
    best = total.argmax(axis=1)
    score = np.where(lettered, total[np.arange(n), best] / np.maximum(sizes, 1), 0)
    return [
        network.languages[k] if known else UNKNOWN for k, known in zip(best, lettered, strict=True)
    ], np.clip(score, 0, 1)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    held_out_fold: int | None = 2,
    settings: Training = Training(),
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, by a network learned from the labelled ones.

    Labels are used outside the held-out fold alone, and a prediction sees the text and nothing
    else. Repeated rows are predicted each for itself; a null doc_id is in no fold. A text of any
    length counts with all its windows. Without any labelled text everything is `und`. Other columns
    are ignored. An empty table gives no rows.
    """
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"),
    )
    texts, labels = training_sample(narrow, settings, held_out_fold)
    network = train(texts, labels, settings) if texts else None
    found = predict(narrow, network)
    fold = F.lit(False) if held_out_fold is None else in_fold(F.col("doc_id"), held_out_fold)
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score")
