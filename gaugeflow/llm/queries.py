"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm import (
    bitplanes,
    decontaminate,
    factors,
    langid,
    licenses,
    neardup,
    packing,
    periodic,
    quality,
    suffixes,
    trie,
    warc,
    windows,
)
from gaugeflow.llm.common import ids_and_texts, table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op3_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminations(documents, benchmark)


def op4_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ids_and_texts(table(spark, sf_dir, "documents"))
    return bitplanes.token_ids(docs, vocabulary(), end_id=2)


def op5_language_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest_repeats(ids_and_texts(table(spark, sf_dir, "documents")))


def op7_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ids_and_texts(table(spark, sf_dir, "documents"))
    return packing.pack(docs, vocabulary(), capacity=2048, end_id=0)


def op8_factor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors.digest_repeats(ids_and_texts(table(spark, sf_dir, "documents")))


def op9_fast_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return neardup.near_duplicates(docs, neardup.Rules(shingle=2))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest_runs(table(spark, sf_dir, "documents"))


def op12_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return windows.pack_online(docs, vocabulary(), capacity=2048, end_id=1)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.shared_openings(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_containment_search": op3_containment_search,
    "op4_token_planes": op4_token_planes,
    "op5_language_network": op5_language_network,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_pattern_packing": op7_pattern_packing,
    "op8_factor_dedup": op8_factor_dedup,
    "op9_fast_sketches": op9_fast_sketches,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_online_packing": op12_online_packing,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": quality.oracle_sql(),
    "op3_containment_search": decontaminate.ORACLE_SQL,
    "op10_warc": warc.ORACLE_SQL,
    "op13_prefix_trie": trie.ORACLE_SQL,
}
