"""From documents to packed training sequences, in five stages over whole tables.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is stored and read again as the
docs of the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import common, decontaminate, factors, langid, neardup, packing
from gaugeflow.llm.queries import vocabulary

#: A text stays if the network gives one language at least this probability.
LEAST_SCORE = 0.5
#: Text that a task of the passage stage looks at together; tasks share their executor's memory with
#: what earlier stages left there.
_BLOCK_BYTES = 2 << 20
#: Holds doc_id where a key of the rows takes its place.
_ID = "_own_doc_id"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null, have no letter, or in which no language has half the score.

    Rows that share a doc_id, or have none, are judged each for itself. Without any labelled text
    nothing can be told, and every row is rejected.
    """
    texts, labels = langid.training_sample(docs.select("doc_id", "text", "lang"))
    network = langid.train(texts, labels) if texts else None
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    held = {f"column_{k}": c for k, c in enumerate(others)}
    renamed = docs.select("doc_id", "text", *(F.col(c).alias(k) for k, c in held.items()))
    judged = langid.predict(renamed, network, keep=("text", *held))
    kept = judged.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    kept = kept.drop("lang_pred", "score")
    return kept.withColumnsRenamed(held).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: the smallest doc_id, missing ones last."""
    keyed = common.row_keys(docs)
    ids = keyed.select(F.col(common.ROW_KEY).alias("doc_id"), "text")
    copies = neardup.near_duplicates(ids).filter("not kept")
    copies = copies.select(F.col("doc_id").alias(common.ROW_KEY)).distinct()
    return keyed.hint("merge").join(copies, common.ROW_KEY, "left_anti").select(*docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 13 words or more that an earlier row has; every row stays."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    filled = common.row_keys(docs).withColumn("text", F.coalesce("text", F.lit("")))
    filled = filled.withColumnsRenamed({"doc_id": _ID, common.ROW_KEY: "doc_id"})
    cut = factors.remove_repeats(filled, carry=(_ID, *others), block_bytes=_BLOCK_BYTES)
    cut = cut.drop("doc_id").withColumnRenamed(_ID, "doc_id")
    if "n_chars" in others:  # counted anew
        cut = cut.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return cut.select(*docs.columns)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that contain a benchmark item, row by row, with or without a doc_id.

    A null or empty text contains none and stays; items of fewer than five words match nothing.
    """
    benchmark = common.table(spark, sf_dir, "benchmark")
    return decontaminate.decontaminate(docs, benchmark).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 ids.

    A null or empty text is its end id alone; rows that share a doc_id are packed each for itself.
    """
    return packing.pack(common.ids_and_texts(docs), vocabulary(), capacity=2048, end_id=0)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("repeated_passages", remove_repeated_passages),
    ("benchmark_leaks", remove_benchmark_leaks),
    ("packing", pack_sequences),
]

#: SQL expresses neither the network nor the packing; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
