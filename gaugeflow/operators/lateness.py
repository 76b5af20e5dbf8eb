"""Rows a streaming watermark would drop, found in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Ingest batches up to which their watermarks, one number each, go along with every task.
_FEW_BATCHES = 100_000


def late_rows(
    df: DataFrame,
    batch: str,
    ts: str = "snapshot_timestamp",
    delay_seconds: int = 600,
) -> DataFrame:
    """Rows at or behind the watermark of their ingest batch, with that watermark.

    The watermark of a batch is the newest event time of all earlier batches minus the delay; the
    first batch has none. The watermarks are computed first, on one row per batch. While these are
    few, they are broadcast and the rows stay where they are; else both sides are shuffled.
    """
    earlier = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    watermarks = (
        df.groupBy(batch)
        .agg(F.max(ts).alias("_newest"))
        .select(
            batch,
            F.timestamp_micros(
                F.unix_micros(F.max("_newest").over(earlier)) - delay_seconds * 1_000_000
            ).alias("watermark"),
        )
    )
    found = watermarks.limit(_FEW_BATCHES + 1).collect()
    if len(found) <= _FEW_BATCHES:
        watermarks = F.broadcast(df.sparkSession.createDataFrame(found, watermarks.schema))
    return df.join(watermarks, batch).filter(F.col(ts) <= F.col("watermark"))


def behind(df: DataFrame, newest_micros: int | None, delay_seconds: int) -> DataFrame:
    """Rows of one batch at or behind its watermark, with it; none before the first watermark."""
    if newest_micros is None:
        return df.limit(0).withColumn("watermark", F.lit(None).cast("timestamp"))
    watermark = F.timestamp_micros(F.lit(newest_micros - delay_seconds * 1_000_000))
    marked = df.withColumn("watermark", watermark)
    return marked.filter(F.col("snapshot_timestamp") <= F.col("watermark"))
