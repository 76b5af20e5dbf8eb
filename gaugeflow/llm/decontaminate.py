"""Benchmark items inside documents, by containment of MinHash samples and exact verification.

An item is far shorter than the document that holds it, so the two sets are not compared by their
similarity. A MinHash sample of the item alone is looked up in the document: the share found
estimates how much of the item the document contains, whatever the document's length. Items are
partitioned by size, and the partition says how many of the smallest hashes are sampled and how
many must be found, so that an item contained as asked for is missed with a probability of about
one in 10 ** 8. Short items are sampled whole. What passes is compared with all shingles, as words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import common


@dataclass(frozen=True)
class Rules:
    """Shingles of `shingle` lower-case words, contained from `percent` of an item's set on.

    samples: (largest set of the partition, hashes sampled, percent of them to be found), by size;
    the last one takes all larger items.
    """

    shingle: int = 5
    percent: int = 80
    samples: tuple[tuple[int, int, int], ...] = ((64, 64, 80), (256, 96, 56), (0, 128, 60))
    #: Samples are broadcast up to so many rows; beyond, both sides are shuffled by shingle.
    broadcast_rows: int = 1_000_000


def _grams(words: str, n: int) -> Column:
    starts = F.sequence(F.lit(0), F.size(words) - n)
    return F.when(F.size(words) >= n, starts).otherwise(F.array().cast("array<int>"))


def _hashes(words: str, n: int) -> Column:
    def gram(i: Column) -> Column:
        return F.xxhash64(*(F.get(words, i + k) for k in range(n)))

    return F.array_distinct(F.transform(_grams(words, n), gram))


def _texts(words: str, n: int) -> Column:
    return F.array_distinct(
        F.transform(_grams(words, n), lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    )


def _with_words(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    return df.select(F.col(id_col).alias(name), common.words(text).alias("words"))


def item_samples(items: DataFrame, rules: Rules) -> DataFrame:
    """item_id, gram (a sampled hash), needed (of the item's samples). items: item_id, words."""
    hashed = items.select("item_id", F.sort_array(_hashes("words", rules.shingle)).alias("h"))
    n = F.size("h")
    sampled, percent = F.lit(None).cast("int"), F.lit(None).cast("int")
    for largest, k, share in reversed(rules.samples):
        here = n <= largest if largest else F.lit(True)
        sampled = F.when(here, F.lit(k)).otherwise(sampled)
        percent = F.when(here, F.lit(share)).otherwise(percent)
    taken = hashed.select("item_id", F.slice("h", F.lit(1), sampled).alias("h"), percent.alias("p"))
    needed = F.ceil(F.size("h") * F.col("p") / 100).cast("long")
    return taken.select("item_id", F.explode("h").alias("gram"), needed.alias("needed"))


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    rules: Rules = Rules(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment) of every item that a text contains.

    Contained: at least 80 % of the item's distinct shingles are in the text. An item of fewer than
    five words is no evidence and is found nowhere; a null or empty text contains nothing, and rows
    without an id are not searched, as no pair could name them. Rows that share a doc_id, or an
    item_id, give one row with the most shared shingles. Empty tables give no rows.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.filter(F.col("doc_id").isNotNull())
    items = _with_words(benchmark, item_col, item_text_col, "item_id")
    items = items.filter(F.col("item_id").isNotNull() & (F.size("words") >= rules.shingle))
    items = items.withColumn("k", F.xxhash64("words"))
    samples = common.stored(
        item_samples(items.select(F.struct("item_id", "k").alias("item_id"), "words"), rules),
        "item-samples",
    )
    small = samples.count() <= rules.broadcast_rows
    worded = _with_words(texts, "doc_id", "text", "doc_id")
    grams = worded.select("doc_id", F.explode(_hashes("words", rules.shingle)).alias("gram"))
    found = grams.join(F.broadcast(samples) if small else samples, "gram")
    pairs = (
        found.groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("hits"), F.first("needed").alias("needed"))
        .filter("hits >= needed")
        .select("doc_id", "item_id.item_id", "item_id.k")
    )
    pairs = common.stored(pairs, "contained-candidates")
    # Only texts with a candidate go on; they are compared by their words.
    chosen = texts.hint("merge").join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    held = _with_words(chosen, "doc_id", "text", "doc_id")
    held = held.select("doc_id", _texts("words", rules.shingle).alias("held"))
    wanted = items.select("item_id", "k", _texts("words", rules.shingle).alias("wanted"))
    both = pairs.join(held, "doc_id").join(wanted, ["item_id", "k"])
    shared = F.size(F.array_intersect("wanted", "held")).cast("long")
    counted = both.select(
        "doc_id", "item_id", F.size("wanted").cast("long").alias("n_item_shingles"),
        shared.alias("n_shared"),
    ).filter(F.col("n_shared") * 100 >= F.col("n_item_shingles") * rules.percent)
    best = F.max(F.struct("n_shared", "n_item_shingles")).alias("best")
    return (
        counted.groupBy("doc_id", "item_id")
        .agg(best)
        .select(
            "doc_id",
            "item_id",
            "best.n_item_shingles",
            "best.n_shared",
            (F.col("best.n_shared") / F.col("best.n_item_shingles")).alias("containment"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of docs, all columns as they are, whose text contains no item.

    Each row is judged by itself, also where its doc_id is missing or another row has it too.
    """
    keyed = common.row_keys(docs)
    hits = contaminations(keyed, benchmark, rules, id_col=common.ROW_KEY)
    hits = hits.select(F.col("doc_id").alias(common.ROW_KEY)).distinct()
    return keyed.hint("merge").join(hits, common.ROW_KEY, "left_anti").select(*docs.columns)


ORACLE_SQL = """
WITH d AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS ws
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS ws
    FROM benchmark),
dg AS (SELECT DISTINCT doc_id, ws[i:i + 4] AS g FROM d, unnest(range(1, len(ws) - 3)) AS t(i)),
bg AS (SELECT DISTINCT item_id, ws[i:i + 4] AS g FROM b, unnest(range(1, len(ws) - 3)) AS t(i)),
n AS (SELECT item_id, count(*) AS n_item_shingles FROM bg GROUP BY item_id),
shared AS (
    SELECT doc_id, item_id, count(*) AS n_shared FROM dg JOIN bg USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n_item_shingles, n_shared,
    n_shared::DOUBLE / n_item_shingles::DOUBLE AS containment
FROM shared JOIN n USING (item_id) WHERE n_shared * 100 >= n_item_shingles * 80
"""
