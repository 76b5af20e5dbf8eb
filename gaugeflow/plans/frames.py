"""Frames behind the dashboard's map, charts and localised tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.display import percent, percent_or_dash
from gaugeflow.functions.timestamps import display_timestamp, hour_start
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.plans.serving import serve_imbalance

# Station states, their map colours (RGBA) and the marker scale.
STATE_COLOURS = {
    "vide": (200, 85, 61, 205),
    "sous tension": (183, 121, 31, 205),
    "normal": (15, 118, 110, 185),
}
RADIUS_PER_SLOT = 20
SMALLEST_CAPACITY = 4
IMBALANCE_BARS = 12
UNDER_SUPPLIED, OVER_SUPPLIED = "Sous-dotee", "Sur-dotee"

# How columns are shown.
PERCENT_COLUMNS = (
    "utilization_rate",
    "rolling_15m_utilization",
    "avg_utilization_rate",
    "avg_utilization",
    "zone_availability_ratio",
    "city_availability_ratio",
)
TWO_DECIMAL_COLUMNS = (
    "latitude",
    "longitude",
    "avg_bikes_available",
    "avg_free_slots",
    "avg_capacity",
    "imbalance_score",
    "estimated_activity",
)
INSTANT_COLUMNS = ("snapshot_timestamp", "created_at", "ingested_at")
YES_NO_COLUMNS = ("shortage_flag", "is_empty")
VALUE_LABELS = {
    "alert_level": {"critical": "critique", "empty-and-critical": "vide et critique"},
    "alert_type": {"critical": "critique", "empty": "station vide"},
}
COLUMN_LABELS = {
    "city": "Ville",
    "station_name": "Station",
    "bikes_available": "Velos disponibles",
    "free_slots": "Bornes libres",
    "capacity": "Capacite",
    "utilization_rate": "Taux d'utilisation",
    "rolling_15m_utilization": "Utilisation glissante 15 min",
    "snapshot_timestamp": "Horodatage",
    "created_at": "Cree le",
    "ingested_at": "Ingere le",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "zone_id": "Zone",
    "avg_bikes_available": "Moyenne velos disponibles",
    "avg_free_slots": "Moyenne bornes libres",
    "avg_capacity": "Capacite moyenne",
    "avg_utilization_rate": "Utilisation moyenne",
    "zone_availability_ratio": "Ratio disponibilite zone",
    "city_availability_ratio": "Ratio disponibilite ville",
    "imbalance_score": "Score de desequilibre",
    "usage_date": "Date",
    "usage_hour": "Heure",
    "estimated_activity": "Activite estimee",
    "peak_rank": "Rang du pic",
    "station_count": "Stations",
    "low_stock_stations": "Stations sous tension",
    "shortage_flag": "Zone sous tension",
    "is_empty": "Station vide",
    "alert_level": "Niveau d'alerte",
    "alert_type": "Type d'alerte",
    "alert_message": "Message d'alerte",
    "utilization_rank": "Rang",
}


def map_points(latest: DataFrame) -> DataFrame:
    """Stations with a position, under the names the map layer reads."""
    return latest.withColumns(
        {"lat": F.col("latitude"), "lon": F.col("longitude")}
    ).na.drop(subset=["lat", "lon"])


def map_centroid(points: DataFrame) -> DataFrame:
    return points.agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def _by_state(values: dict[str, Column], params: Params) -> Column:
    tense = (F.col("utilization_rate") >= params.focus_utilization) | (
        F.col("bikes_available") <= params.focus_bikes
    )
    return (
        F.when(F.col("bikes_available") <= 0, values["vide"])
        .when(tense, values["sous tension"])
        .otherwise(values["normal"])
    )


def station_markers(latest: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Map points with state, colour, radius and tooltip texts."""
    colours = {
        state: F.array(*[F.lit(part) for part in rgba])
        for state, rgba in STATE_COLOURS.items()
    }
    size = F.greatest(
        F.coalesce("capacity", F.lit(SMALLEST_CAPACITY)), F.lit(SMALLEST_CAPACITY)
    )
    return map_points(latest).withColumns(
        {
            "utilization_label": percent(F.col("utilization_rate")),
            "snapshot_label": display_timestamp(
                F.col("snapshot_timestamp"), params.display_timezone
            ),
            "radius": size * RADIUS_PER_SLOT,
            "station_state": _by_state({state: F.lit(state) for state in colours}, params),
            "fill_color": _by_state(colours, params),
        }
    )


def activity_series(peaks: DataFrame) -> DataFrame:
    return peaks.withColumn("period_start", hour_start(F.col("usage_date"), F.col("usage_hour")))


def imbalance_bars(imbalance: DataFrame, bars: int = IMBALANCE_BARS) -> DataFrame:
    return (
        serve_imbalance(imbalance)
        .limit(bars)
        .withColumns(
            {
                "direction": F.when(F.col("imbalance_score") < 0, UNDER_SUPPLIED).otherwise(
                    OVER_SUPPLIED
                ),
                "zone_label": F.concat("city", F.lit(" · "), "zone_id"),
            }
        )
    )


def localize(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Values and column names as the dashboard shows them; unknown columns stay as they are."""
    shown: dict[str, Column] = {}
    for name in df.columns:
        value = F.col(name)
        if name in VALUE_LABELS:
            pairs = [F.lit(text) for pair in VALUE_LABELS[name].items() for text in pair]
            shown[name] = F.coalesce(F.create_map(*pairs)[value], value)
        elif name in YES_NO_COLUMNS:
            shown[name] = F.when(value, "oui").otherwise("non")
        elif name in INSTANT_COLUMNS:
            shown[name] = display_timestamp(value, params.display_timezone)
        elif name in PERCENT_COLUMNS:
            shown[name] = percent_or_dash(value)
        elif name in TWO_DECIMAL_COLUMNS:
            shown[name] = F.round(value.cast("double"), 2)
    named = {name: label for name, label in COLUMN_LABELS.items() if name in df.columns}
    return df.withColumns(shown).withColumnsRenamed(named)
