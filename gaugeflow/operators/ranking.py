"""Dense ranks over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.session import fresh_dir

Order = Sequence[tuple[str, str]]

# Most constrained stations first.
UTILIZATION_ORDER: Order = (
    ("utilization_rate", "desc"),
    ("bikes_available", "asc"),
    ("station_name", "asc"),
)


def _sorting(order: Order) -> list[Column]:
    return [F.desc(name) if way == "desc" else F.asc(name) for name, way in order]


def top_dense_rank(df: DataFrame, order: Order, limit: int, output: str) -> DataFrame:
    """Rows whose dense rank is at most ``limit``, with ties, and that rank.

    Only distinct sort keys are ranked: the ``limit`` best of them, found by a top-k per task.
    Keys with nulls are ranked like others, where the engine sorts them.
    """
    keys = [name for name, _ in order]
    best = df.select(*keys).distinct().orderBy(*_sorting(order)).limit(limit)
    ranked = best.withColumn(output, F.dense_rank().over(Window.orderBy(*_sorting(order))))
    return _with_ranks(df, ranked, keys, output)


def _with_ranks(df: DataFrame, ranked: DataFrame, keys: list[str], output: str) -> DataFrame:
    """Joins the ranks of sort keys to the rows; a null in a key equals a null."""
    named = ranked.select(*[F.col(name).alias(f"_key_{name}") for name in keys], output)
    same = reduce(
        Column.__and__, [F.col(name).eqNullSafe(F.col(f"_key_{name}")) for name in keys]
    )
    return df.join(named.hint("merge"), same).select(*df.columns, output)


def dense_rank_global(
    df: DataFrame,
    order: Order,
    output: str,
    partitions: int | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Dense rank of every row, computed range by range.

    Distinct sort keys are range partitioned, ranked inside their range, and shifted by the sizes
    of the ranges before it (one row per range). The placed keys are written to ``scratch`` in the
    shared folder, which pins each key's range for both uses. Runs one job when called.
    """
    spark = df.sparkSession
    scratch = scratch or fresh_dir(spark, "ranked-keys")
    keys = [name for name, _ in order]
    # Unless their number is given, small ranges that follow each other become one at run time.
    ranges = [partitions] if partitions else []
    (
        df.select(*keys)
        .distinct()
        .repartitionByRange(*ranges, *_sorting(order))
        .withColumn("_range", F.spark_partition_id())
        .write.parquet(scratch)
    )
    placed = spark.read.parquet(scratch)
    inside = Window.partitionBy("_range").orderBy(*_sorting(order))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    ranks = (
        placed.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")
        .select(*keys, (F.col("_place") + F.col("_offset")).cast("int").alias(output))
    )
    return _with_ranks(df, ranks, keys, output)


def top_utilization(latest: DataFrame, limit: int) -> DataFrame:
    return top_dense_rank(latest, UTILIZATION_ORDER, limit, "utilization_rank")


def utilization_ranking(latest: DataFrame, partitions: int | None = None) -> DataFrame:
    return dense_rank_global(latest, UTILIZATION_ORDER, "utilization_rank", partitions)
