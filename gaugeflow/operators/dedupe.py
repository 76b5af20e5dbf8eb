"""One row per key, in batch and under a streaming watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.operators.cleaning import clean_snapshots
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.schema import FACT_KEY


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """First arrival per key.

    Catalyst turns the rank filter into a group limit before the shuffle, so a key with very many
    copies leaves each map task as one row.
    """
    arrivals = Window.partitionBy(*keys).orderBy(order_by)
    return (
        df.withColumn("_arrival", F.row_number().over(arrivals))
        .filter(F.col("_arrival") == 1)
        .drop("_arrival")
    )


def dedupe_in_stream(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Watermark plus stateful dedupe; on a batch frame the watermark has no effect."""
    return df.withWatermark("snapshot_timestamp", params.watermark).dropDuplicates(
        list(FACT_KEY)
    )


def transform_snapshots(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Clean then dedupe; the same function serves a stream and a batch."""
    return dedupe_in_stream(clean_snapshots(df, params), params)


def facts_by_arrival(raw: DataFrame, arrival: str, params: Params = DEFAULTS) -> DataFrame:
    """Batch form with a defined winner among copies: the earliest arrival."""
    return first_per_key(clean_snapshots(raw, params, keep=[arrival]), FACT_KEY, arrival)
