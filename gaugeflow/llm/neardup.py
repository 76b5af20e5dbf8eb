"""Near duplicates by fast similarity sketching, banding and exact verification.

1. Every text gets the set of its word shingles and a sketch of it. Round after round, each shingle
   is thrown into one bin of the sketch with a value that grows with the round, and a bin keeps its
   smallest value; later rounds throw all shingles into one bin each, so every bin is filled. Two
   sketches agree in a bin with the probability of the Jaccard similarity, and the sum over bins is
   concentrated as if they were independent.
2. Texts with the same set are one class from here on; its smallest doc_id stands for it.
3. Classes that agree in all bins of a band are candidates. Only their connection matters: each
   band bucket links its members with its smallest one, and connected candidates form a cluster.
4. A cluster's full sets are compared exactly in tasks of bounded size: shingles are ordered by
   frequency, and sets as similar as asked for share one among their first, rarest ones. Pairs
   already connected are not compared again. A cluster too large for one task is dealt into parts and
   every two parts meet in a task.
5. Links found are joined to components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import common, repeats
from gaugeflow.llm.components import components


@dataclass(frozen=True)
class Rules:
    """Shingles of `shingle` words; similar from `percent` of the union on.

    A pair exactly at 80 % is missed by all bands with probability (1 - 0.8 ** rows) ** bands: about
    one in 10 ** 8 with these.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 60
    rows: int = 6
    #: Shingles whose sets meet in one task, at most twice as many for parts of a large cluster.
    together: int = 1_000_000

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def shingle_sets(block: repeats.Block, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z count as a-z."""
    upper = (block.data >= 65) & (block.data <= 90)
    folded = repeats.Block(block.ids, block.data + upper * np.uint8(32), block.edges)
    words = repeats.word_symbols(folded)
    whole = (
        common.mix64(repeats.rolling(words.codes, shingle))
        if len(words.codes) >= shingle
        else np.zeros(0, np.uint64)
    )
    sets = []
    for a, b in zip(words.edges[:-1].tolist(), words.edges[1:].tolist(), strict=True):
        if b - a >= shingle:
            sets.append(np.unique(whole[a : b - shingle + 1]))
        elif b > a:  # fewer words: the whole sequence, apart from all full shingles
            short = repeats.rolling(words.codes[a:b], b - a) + np.uint64(shingle * 1000 + b - a)
            sets.append(common.mix64(short))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def sketch(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """(sets, bins) of sketch values; a set without elements keeps the largest value everywhere."""
    found = np.full(len(sets) * bins, np.iinfo(np.uint64).max)
    sizes = np.array([len(s) for s in sets])
    active = np.flatnonzero(sizes)
    if not len(active):
        return found.reshape(len(sets), bins)
    elements = np.concatenate([sets[k] for k in active])
    owner = np.repeat(active, sizes[active])
    for turn in range(2 * bins):
        thrown = common.mix64(elements + common.mix64(np.array([turn], np.uint64)))
        place = thrown % np.uint64(bins) if turn < bins else np.uint64(turn - bins)
        value = np.uint64(turn << 40) | (common.mix64(thrown) >> np.uint64(24))
        np.minimum.at(found, owner * bins + place.astype(np.int64), value)
        open_bins = (found.reshape(len(sets), bins)[active] == np.iinfo(np.uint64).max).any(axis=1)
        if not open_bins.all():
            still = np.zeros(len(sets), bool)
            active = active[open_bins]
            still[active] = True
            keep = still[owner]
            elements, owner = elements[keep], owner[keep]
        if not len(active):
            break
    return found.reshape(len(sets), bins)


def band_keys(sketches: np.ndarray, rules: Rules) -> np.ndarray:
    banded = sketches.reshape(len(sketches), rules.bands, rules.rows)
    key = np.arange(rules.bands, dtype=np.uint64)[None].repeat(len(sketches), 0)
    for k in range(rules.rows):
        key = common.mix64(key + banded[:, :, k])
    return key


SKETCHED = "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>"


def sketched(docs: DataFrame, rules: Rules) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.cut_batches(batches):
            block = repeats.block_of(np.zeros(batch.num_rows, np.int64), batch["text"])
            sets = shingle_sets(block, rules.shingle)
            keys = band_keys(sketch(sets, rules.bins), rules).view(np.int64)
            sizes = np.array([len(s) for s in sets])
            # Two independent sums of 64 bits stand for the set.
            one = np.array([np.sum(s, dtype=np.uint64) for s in sets], np.uint64)
            two = np.array([np.sum(common.mix64(s), dtype=np.uint64) for s in sets], np.uint64)
            edges = np.arange(len(sets) + 1, dtype=np.int32) * rules.bands
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(sizes),
                    pa.array(one.view(np.int64)),
                    pa.array(two.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(keys.ravel())),
                ],
                [part.split()[0] for part in SKETCHED.split(", ")],
            )

    return common.stored(common.arrow_map(docs, work, SKETCHED), "sketches")


def candidates(reps: DataFrame) -> DataFrame:
    """(a, b): members of each shared bucket with its smallest member. reps: rep, keys."""
    buckets = reps.select("rep", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("rep").alias("b"), F.max("rep").alias("most"))
    shared = shared.filter("b < most").select("key", "b")
    return buckets.join(shared, "key").filter("rep > b").select(F.col("rep").alias("a"), "b")


# ---- exact links within one task


def link(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set, the position of the first one in its component of linked sets.

    Linked: 100 * intersection >= percent * union. Exact: every linked pair either shares one of
    its rarest elements and is compared, or is connected already.
    """
    n = len(sets)
    label = np.arange(n)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return label
    _, codes, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(n), sizes)
    # By rarity, the same order for all sets.
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    ranks = rank[codes]
    order = np.lexsort((ranks, owner))
    ranks = ranks[order]
    place = np.arange(len(ranks)) - edges[owner]
    prefix = sizes - (percent * sizes + 99) // 100 + 1
    listed = (place < prefix[owner]) & (np.sort(count)[ranks] > 1)
    tokens, docs = ranks[listed], owner[listed]
    by_token = np.lexsort((docs, tokens))
    tokens, docs = tokens[by_token], docs[by_token]
    first = np.searchsorted(tokens, tokens)
    # For each listed element, the earlier sets that list it too.
    earlier = np.arange(len(tokens)) - first
    mark = np.zeros(len(count), bool)
    by_doc = np.argsort(docs, kind="stable")
    doc_edges = np.searchsorted(docs[by_doc], np.arange(n + 1))
    for x in range(n):
        own = by_doc[doc_edges[x] : doc_edges[x + 1]]
        own = own[earlier[own] > 0]
        if not len(own):
            continue
        others = docs[repeats.ranges(first[own], earlier[own])]
        others = others[label[others] != label[x]]
        if not len(others):
            continue
        others = np.unique(others)
        small, large = np.minimum(sizes[others], sizes[x]), np.maximum(sizes[others], sizes[x])
        others = others[100 * small >= percent * large]
        if not len(others):
            continue
        mark[ranks[edges[x] : edges[x + 1]]] = True
        hits = mark[ranks[repeats.ranges(edges[others], sizes[others])]]
        common_size = np.add.reduceat(hits.astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
        mark[ranks[edges[x] : edges[x + 1]]] = False
        union = sizes[others] + sizes[x] - common_size
        joined = np.unique(label[others[100 * common_size >= percent * union]])
        if len(joined):
            joined = np.append(joined, label[x])
            label[np.isin(label, joined)] = joined.min()
    return label


def verified(docs: DataFrame, clusters: DataFrame, rules: Rules) -> DataFrame:
    """(a, b): every text of a cluster that is linked, with the smallest of its component.

    clusters: node, root, n_shingles.
    """
    sizes = clusters.groupBy("root").agg(F.sum("n_shingles").alias("total"))
    totals = sizes.agg(F.sum("total")).first()[0] or 0
    bins = max(totals // rules.together, 1)
    parts = F.ceil(F.col("total") / rules.together).cast("int")
    dealt = clusters.join(sizes.withColumn("parts", parts), "root")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = dealt.withColumn("own", own).withColumn("other", other)
    # Small clusters share a task; each large one is a group of its own.
    group = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("root"), F.lit(bins))).otherwise(
        F.xxhash64("root", F.lit("alone"))
    )
    places = dealt.select(
        F.col("node").alias("doc_id"),
        group.alias("g"),
        (F.col("parts") > 1).alias("alone"),
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
    )

    def work(table: pa.Table) -> pa.Table:
        ids = table["doc_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        block = repeats.block_of(ids, table["text"].combine_chunks())
        sets = shingle_sets(block, rules.shingle)
        label = link([sets[k] for k in order], rules.percent)
        ids = ids[order]
        linked = label != np.arange(len(label))
        return pa.table({"a": ids[linked], "b": ids[label[linked]]})

    # The same plan at every size: a broadcast that only small inputs get would hide this shuffle.
    texts = docs.hint("merge").join(places, "doc_id")
    return texts.groupBy("alone", "g", "i", "j").applyInArrow(work, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    rules: Rules = Rules(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    component_id is the smallest doc_id that links reach, the own one included; kept where both are
    the same. Null, empty and blank texts have no shingles and are linked with nothing. Rows with the
    same doc_id are one node: it is linked with what any of them is linked with. A row without
    doc_id is linked with nothing and kept, its component is null. An empty table gives no rows.
    """
    texts = common.ids_and_texts(docs, id_col, text_col)
    common.ship_package(docs.sparkSession)
    made = sketched(texts, rules)
    real = made.filter("n_shingles > 0 and doc_id is not null")
    same = ["set_a", "set_b", "n_shingles"]
    classes = common.stored(real.groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")
    reps = real.select(F.col("doc_id").alias("rep"), "n_shingles", "keys", "set_a", "set_b")
    reps = reps.join(classes, ["rep", *same], "left_semi")
    clusters = components(candidates(reps))
    sizes = reps.groupBy(F.col("rep").alias("node")).agg(F.sum("n_shingles").alias("n_shingles"))
    clusters = common.stored(clusters.join(sizes, "node"), "clusters")
    # A doc_id with several rows may be in several classes, which it joins.
    several = real.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    ties = real.join(several, "doc_id").join(classes, same)
    ties = ties.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    links = components(verified(texts, clusters, rules).unionByName(ties))
    roots = links.select(F.col("node").alias("rep"), "root")
    known = (
        classes.join(roots, "rep", "left")
        .select(*same, F.coalesce("root", "rep").alias("root"))
    )
    placed = made.drop("keys").join(known, same, "left")
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce(F.col("root"), F.col("doc_id"))
    )
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
