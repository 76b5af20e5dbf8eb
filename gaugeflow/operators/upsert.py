"""Insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def day_spans(incoming: DataFrame, date: str, ts: str) -> list[Row]:
    """First and last time (``_first``, ``_last``) of each calendar date, a short row per date."""
    spans = incoming.groupBy(date).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    return spans.filter(F.col(date).isNotNull()).collect()


def within_spans(stored: DataFrame, found: list[Row], date: str, ts: str) -> DataFrame:
    """``stored`` cut to these dates and, per date, to the times between first and last.

    The dates prune partitions before the scan and the overall times skip row groups by their
    statistics; the times of each date are then tested by a broadcast of these same rows.
    """
    if not found:
        return stored.limit(0)
    pruned = stored.filter(
        F.col(date).isin([span[date] for span in found])
        & F.col(ts).between(
            min(span["_first"] for span in found), max(span["_last"] for span in found)
        )
    )
    if len(found) == 1:
        return pruned
    kinds = stored.select(date, F.col(ts).alias("_first"), F.col(ts).alias("_last")).schema
    bounds = F.broadcast(stored.sparkSession.createDataFrame(found, kinds))
    return (
        pruned.join(bounds, date)
        .filter(F.col(ts).between(F.col("_first"), F.col("_last")))
        .select(*stored.columns)
    )


def restrict_to_spans(
    stored: DataFrame, incoming: DataFrame, date: str, ts: str
) -> DataFrame:
    """``stored`` cut to the dates of ``incoming`` and, per date, to its first and last time.

    One short row per calendar date comes to the driver, whatever the number of rows.
    """
    return within_spans(stored, day_spans(incoming, date, ts), date, ts)


def absent_rows(incoming: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not stored yet; ``incoming`` is unique on the key.

    Both sides meet by a shuffle of the keys: neither has a bound that would let it go through the
    driver as a broadcast.
    """
    keys = list(keys)
    known = stored.select(*keys).hint("merge")
    return incoming.join(known, keys, "left_anti").select(*incoming.columns)


def append_if_absent(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str]
) -> DataFrame:
    return stored.unionByName(absent_rows(incoming, stored, keys))
