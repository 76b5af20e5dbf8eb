"""Zone availability and geographic imbalance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.params import DEFAULTS, Params


def _fullness() -> Column:
    return F.when(
        F.col("capacity") > 0, F.col("bikes_available") / F.col("capacity")
    ).otherwise(F.lit(0.0))


def low_availability_zones(latest: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Every zone with its averages; the flag marks those short of bikes."""
    return (
        latest.groupBy("city", "zone_id")
        .agg(
            F.max("snapshot_timestamp").alias("snapshot_timestamp"),
            F.avg("bikes_available").alias("avg_bikes_available"),
            F.avg("free_slots").alias("avg_free_slots"),
            F.avg("utilization_rate").alias("avg_utilization_rate"),
            F.count(F.lit(1)).alias("station_count"),
        )
        .withColumn(
            "shortage_flag", F.col("avg_bikes_available") < params.low_availability_threshold
        )
    )


def city_baseline(latest: DataFrame) -> DataFrame:
    return latest.groupBy("city").agg(F.avg(_fullness()).alias("city_availability_ratio"))


def geographic_imbalance(latest: DataFrame) -> DataFrame:
    """Mean fullness of each zone against its city's.

    Zones are aggregated before the join, so both sides are small; the join carries no hint and
    the engine broadcasts the cities only if their measured size allows it.
    """
    zones = latest.groupBy("city", "zone_id").agg(
        F.max("snapshot_timestamp").alias("snapshot_timestamp"),
        F.avg("bikes_available").alias("avg_bikes_available"),
        F.avg("capacity").alias("avg_capacity"),
        F.avg(_fullness()).alias("zone_availability_ratio"),
    )
    return zones.join(city_baseline(latest), "city").withColumn(
        "imbalance_score",
        F.col("zone_availability_ratio") - F.col("city_availability_ratio"),
    )
