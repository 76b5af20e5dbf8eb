"""Overview metrics, their history and their change between refreshes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions import display
from gaugeflow.functions.timestamps import time_bucket
from gaugeflow.operators.alerts import is_critical, is_empty
from gaugeflow.operators.timeline import rolling_utilization
from gaugeflow.params import DEFAULTS, Params

COUNT_METRICS = ("total_stations", "empty_stations", "critical_station_count")
RATE_METRIC = "avg_utilization_rate"
METRICS = ("total_stations", RATE_METRIC, "empty_stations", "critical_station_count")


def _tally(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def alert_counts(alerts: DataFrame, as_of: Column) -> DataFrame:
    """Alerts created in the last day and in the last hour before ``as_of``."""
    age_limit = {"alert_count_24h": 24, "alert_count_1h": 1}
    return alerts.agg(
        *[
            _tally(
                F.col("created_at") >= as_of - F.make_dt_interval(F.lit(0), F.lit(hours))
            ).alias(name)
            for name, hours in age_limit.items()
        ]
    )


def overview_metrics(
    latest: DataFrame, critical: DataFrame, alerts: DataFrame, as_of: Column
) -> DataFrame:
    """One row of headline numbers from three one-row aggregates.

    The three rows are stacked and folded instead of joined, which needs no cross join.
    """
    stations = latest.agg(
        F.count(F.lit(1)).alias("total_stations"),
        F.count_distinct("city").alias("tracked_cities"),
        F.coalesce(F.avg("utilization_rate"), F.lit(0.0)).alias("avg_utilization_rate"),
        _tally(F.col("bikes_available") == 0).alias("empty_stations"),
    )
    parts = [
        stations,
        critical.agg(F.count(F.lit(1)).alias("critical_station_count")),
        alert_counts(alerts, as_of),
    ]
    names = [name for part in parts for name in part.columns]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in names])


def city_summary(latest: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return latest.groupBy("city").agg(
        F.count(F.lit(1)).alias("station_count"),
        F.coalesce(F.avg("utilization_rate"), F.lit(0.0)).alias("avg_utilization_rate"),
        F.coalesce(F.avg("bikes_available"), F.lit(0.0)).alias("avg_bikes_available"),
        _tally(F.col("bikes_available") == 0).alias("empty_stations"),
        _tally(F.col("bikes_available") <= params.focus_bikes).alias("low_stock_stations"),
    )


def metrics_by_refresh(
    facts: DataFrame, refresh_seconds: int, params: Params = DEFAULTS
) -> DataFrame:
    """Headline metrics as they stood at the end of every refresh period that saw a snapshot.

    A station counts with its last snapshot so far. Instead of a station for every period, each
    period adds what changed: its last readings minus the ones they replace. Running totals over
    one row per period give the level, so the work grows with the facts only.
    """
    flagged = rolling_utilization(facts, params).select(
        "station_key",
        "snapshot_timestamp",
        time_bucket(F.col("snapshot_timestamp"), refresh_seconds).alias("_period"),
        F.col("utilization_rate").alias("_rate"),
        is_empty().cast("int").alias("_empty"),
        is_critical(params).cast("int").alias("_critical"),
    )
    readings = ("_rate", "_empty", "_critical")
    closing = (
        flagged.groupBy("station_key", "_period")
        .agg(
            F.max("snapshot_timestamp").alias("_seen"),
            *[F.max_by(name, "snapshot_timestamp").alias(name) for name in readings],
        )
    )
    # One row per station and period, so this window does not grow with the snapshots in them.
    periods = Window.partitionBy("station_key").orderBy("_period")
    tracked = ("_known", *readings)
    changes = closing.withColumn("_known", F.lit(1)).select(
        "_period",
        "_seen",
        *[
            (F.col(name) - F.lag(name, 1, 0).over(periods)).alias(name)
            for name in tracked
        ],
    )
    per_period = changes.groupBy("_period").agg(
        F.max("_seen").alias("_seen"), *[F.sum(name).alias(name) for name in tracked]
    )
    so_far = Window.orderBy("_period").rowsBetween(Window.unboundedPreceding, 0)
    level = {name: F.sum(name).over(so_far) for name in tracked}
    return per_period.select(
        F.timestamp_seconds((F.col("_period") + 1) * refresh_seconds).alias("refreshed_at"),
        F.max("_seen").over(so_far).alias("latest_snapshot"),
        level["_known"].cast("bigint").alias("total_stations"),
        (level["_rate"] / level["_known"]).alias("avg_utilization_rate"),
        level["_empty"].cast("bigint").alias("empty_stations"),
        level["_critical"].cast("bigint").alias("critical_station_count"),
    )


def metric_deltas(
    metrics: DataFrame, refresh: str = "refreshed_at", snapshot: str = "latest_snapshot"
) -> DataFrame:
    """Adds ``delta_<metric>`` and ``snapshot_changed`` to a log of refreshes.

    A refresh that shows a new snapshot is compared with the metrics held from before; one that
    shows the same or no snapshot keeps the deltas already on display. The log holds one row per
    refresh, not per fact.
    """
    order = Window.orderBy(refresh)
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    held = F.struct(*METRICS)
    log = metrics.withColumn(
        "_shown", F.last(snapshot, ignorenulls=True).over(past)
    ).withColumn(
        "snapshot_changed",
        F.col(snapshot).isNotNull() & ~F.col(snapshot).eqNullSafe(F.col("_shown")),
    )
    replaces = F.col("snapshot_changed") | F.col(snapshot).isNull()
    log = log.withColumn(
        "_held", F.last(F.when(replaces, held), ignorenulls=True).over(past)
    )
    change = F.struct(
        *[
            F.coalesce(F.col(name) - F.col(f"_held.{name}"), F.lit(0)).alias(name)
            for name in METRICS
        ]
    )
    log = log.withColumn(
        "_change",
        F.last(F.when(F.col("snapshot_changed"), change), ignorenulls=True).over(so_far),
    )
    return log.select(
        *metrics.columns,
        *[
            F.coalesce(F.col(f"_change.{name}"), F.lit(0)).alias(f"delta_{name}")
            for name in METRICS
        ],
        "snapshot_changed",
    )


def metric_delta_labels(deltas: DataFrame) -> DataFrame:
    """Formatted values, signed changes and directions of a delta log."""
    columns: dict[str, Column] = {}
    for name in COUNT_METRICS:
        change = F.col(f"delta_{name}")
        columns[f"{name}_label"] = display.grouped_count(F.col(name))
        columns[f"{name}_change"] = display.signed_count(change)
        columns[f"{name}_direction"] = display.count_direction(change)
    change = F.col(f"delta_{RATE_METRIC}")
    columns[f"{RATE_METRIC}_label"] = display.percent(F.col(RATE_METRIC))
    columns[f"{RATE_METRIC}_change"] = display.signed_rate(change, "pts")
    columns[f"{RATE_METRIC}_direction"] = display.rate_direction(change)
    return deltas.withColumns(columns)
