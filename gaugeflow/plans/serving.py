"""Queries an operations dashboard asks of the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.timestamps import display_timestamp, snapshot_token
from gaugeflow.operators.metrics import city_summary
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.schema import FRAMES, conform

# Freshness levels and their texts.
NO_DATA = ("info", "Aucun snapshot n'est encore disponible dans PostgreSQL.")
LIVE = ("live", "Dernier snapshot il y a %d min %02d s.")
STALE = ("warning", "Flux ancien ou limite. Dernier snapshot il y a %d min %02d s.")

ALERT_LIMIT = 100
WATCHLIST_LENGTH = 5
FOCUS_ALL, FOCUS_TENSION, FOCUS_EMPTY = "all", "tension", "empty"


def query_table(
    spark: SparkSession,
    table: str,
    sql: str,
    args: dict[str, object],
    schema: T.StructType,
) -> DataFrame:
    """A parameterised query; an empty frame of the declared columns if the table is absent.

    Any other error is raised.
    """
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], schema)
    return conform(spark.sql(sql, args=args), schema)


def _imbalance_size() -> Column:
    """Distance from balance, without the noise of summation order, so that equal ones tie."""
    return F.round(F.abs("imbalance_score"), 9)


def serve_latest(latest: DataFrame) -> DataFrame:
    return latest.orderBy("city", "station_name").select(*FRAMES["latest"].names)


def serve_top_stations(ranked: DataFrame, limit: int) -> DataFrame:
    return (
        ranked.orderBy("utilization_rank", "station_name", "station_key")
        .limit(limit)
        .select(*FRAMES["top_stations"].names)
    )


def serve_city_summary(latest: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return city_summary(latest, params).orderBy(F.desc("avg_utilization_rate"), "city")


def serve_zones(zones: DataFrame) -> DataFrame:
    return zones.orderBy(
        F.desc("shortage_flag"), "avg_bikes_available", "city", "zone_id"
    ).select(*FRAMES["zones"].names)


def shortage_zones(zones: DataFrame) -> DataFrame:
    return (
        zones.filter("shortage_flag")
        .orderBy("avg_bikes_available", "city", "zone_id")
        .select("city", "zone_id", "avg_bikes_available", "avg_utilization_rate")
    )


def serve_peaks(peaks: DataFrame) -> DataFrame:
    return peaks.orderBy(F.desc("usage_date"), "city", "usage_hour").select(
        *FRAMES["peaks"].names
    )


def peak_hours(peaks: DataFrame) -> DataFrame:
    return (
        peaks.filter("peak_rank = 1")
        .orderBy(F.desc("usage_date"), "city")
        .select("city", "usage_date", "usage_hour", "estimated_activity")
    )


def serve_critical(critical: DataFrame) -> DataFrame:
    return critical.orderBy(
        F.desc("snapshot_timestamp"), "city", "station_name", "station_key"
    ).select(*FRAMES["critical"].names)


def serve_imbalance(imbalance: DataFrame) -> DataFrame:
    return imbalance.orderBy(_imbalance_size().desc(), "city", "zone_id").select(
        *FRAMES["imbalance"].names
    )


def top_imbalance(imbalance: DataFrame, limit: int = 20) -> DataFrame:
    return (
        serve_imbalance(imbalance)
        .limit(limit)
        .select(
            "city",
            "zone_id",
            "imbalance_score",
            "zone_availability_ratio",
            "city_availability_ratio",
        )
    )


def recent_alerts(alerts: DataFrame, limit: int = ALERT_LIMIT) -> DataFrame:
    """Newest alerts first; the natural key decides among alerts created together."""
    return (
        alerts.orderBy(
            F.desc("created_at"), "station_key", F.desc("snapshot_timestamp"), "alert_type"
        )
        .limit(limit)
        .select(*FRAMES["alerts"].names)
    )


def watchlist(
    critical: DataFrame,
    zones: DataFrame,
    ranked: DataFrame,
    length: int = WATCHLIST_LENGTH,
) -> dict[str, DataFrame]:
    """The first rows of the three lists an operator looks at."""
    return {
        "critical": serve_critical(critical)
        .limit(length)
        .select("city", "station_name", "bikes_available", "rolling_15m_utilization"),
        "shortage": serve_zones(zones)
        .filter("shortage_flag")
        .limit(length)
        .select(
            "city", "zone_id", "station_count", "avg_bikes_available", "avg_utilization_rate"
        ),
        "top": serve_top_stations(ranked, length).select(
            "city", "station_name", "bikes_available", "capacity", "utilization_rate"
        ),
    }


def freshness(latest: DataFrame, as_of: Column, params: Params = DEFAULTS) -> DataFrame:
    """One row: newest snapshot, its age at ``as_of``, and whether the feed counts as live."""
    newest = latest.agg(
        F.max("snapshot_timestamp").alias("latest_snapshot"),
        F.max("ingested_at").alias("latest_ingested"),
    )
    age = F.greatest(
        F.timestamp_diff("SECOND", F.col("latest_snapshot"), as_of.cast("timestamp")), F.lit(0)
    )
    minutes, seconds = F.expr("age_seconds div 60"), F.col("age_seconds") % 60
    live = F.col("age_seconds") <= 2 * params.poll_interval_seconds
    none = F.col("latest_snapshot").isNull()
    return newest.withColumn(
        "age_seconds", F.when(F.col("latest_snapshot").isNotNull(), age)
    ).select(
        "latest_snapshot",
        "latest_ingested",
        snapshot_token(F.col("latest_snapshot")).alias("snapshot_token"),
        "age_seconds",
        F.when(none, NO_DATA[0]).when(live, LIVE[0]).otherwise(STALE[0]).alias("level"),
        F.when(none, NO_DATA[1])
        .when(live, F.format_string(LIVE[1], minutes, seconds))
        .otherwise(F.format_string(STALE[1], minutes, seconds))
        .alias("message"),
        display_timestamp(F.col("latest_snapshot"), params.display_timezone).alias(
            "latest_snapshot_local"
        ),
        display_timestamp(F.col("latest_ingested"), params.display_timezone).alias(
            "latest_ingested_local"
        ),
        F.lit(f"Cadence attendue: {params.poll_interval_seconds} s").alias("cadence"),
    )


def city_options(latest: DataFrame, configured: Sequence[str] = ()) -> DataFrame:
    """Known cities in order; the configured ones as long as there is no data."""
    known = latest.select("city").na.drop().distinct()
    if configured:
        listed = latest.sparkSession.createDataFrame(
            [(city,) for city in configured], "city string"
        )
        none_known = known.limit(1).agg(F.count(F.lit(1)) == 0)
        known = known.unionByName(listed.filter(none_known.scalar()))
    return known.orderBy("city")


def filter_cities(
    df: DataFrame, selected: Sequence[str], options: DataFrame
) -> DataFrame:
    """Rows in the chosen cities; everything when no chosen city is among the options.

    The valid part of the choice is one small array, never longer than ``selected``.
    """
    valid = (
        options.filter(F.col("city").isin(*selected))
        .agg(F.collect_set("city").alias("valid"))
        .scalar()
    )
    return df.filter((F.size(valid) == 0) | F.array_contains(valid, F.col("city")))


def focus_stations(df: DataFrame, focus: str, params: Params = DEFAULTS) -> DataFrame:
    if focus == FOCUS_TENSION:
        return df.filter(
            (F.col("utilization_rate") >= params.focus_utilization)
            | (F.col("bikes_available") <= params.focus_bikes)
        )
    if focus == FOCUS_EMPTY:
        return df.filter(F.col("bikes_available") <= 0)
    if focus == FOCUS_ALL:
        return df
    raise ValueError(f"unknown focus {focus!r}")
