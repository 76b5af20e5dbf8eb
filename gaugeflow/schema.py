"""Declared schemas of the wire record, the facts, the gold tables and the serving frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = T.StringType()
REAL = T.DoubleType()
INT = T.IntegerType()
LONG = T.LongType()
INSTANT = T.TimestampType()
DATE = T.DateType()
FLAG = T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def _pick(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([schema[name] for name in names])


# Names and types of the columns of records, tables and frames.
WIRE = _struct(
    station_id=TEXT,
    station_name=TEXT,
    latitude=REAL,
    longitude=REAL,
    bikes_available=INT,
    free_slots=INT,
    timestamp=TEXT,
    network_id=TEXT,
    city=TEXT,
    station_key=TEXT,
    ingested_at=TEXT,
)

CLEAN = _struct(
    station_key=TEXT,
    network_id=TEXT,
    city=TEXT,
    station_id=TEXT,
    station_name=TEXT,
    latitude=REAL,
    longitude=REAL,
    bikes_available=INT,
    free_slots=INT,
    capacity=INT,
    utilization_rate=REAL,
    zone_id=TEXT,
    snapshot_timestamp=INSTANT,
    ingested_at=INSTANT,
    event_date=DATE,
    event_hour=INT,
)

FACT = T.StructType([*CLEAN.fields, T.StructField("batch_id", LONG, True)])

FACT_KEY = ("station_key", "snapshot_timestamp")
ALERT_KEY = ("station_key", "snapshot_timestamp", "alert_type")

# Nested documents as a bike-share REST API serves them.
STATION_PAYLOAD = _struct(
    id=TEXT,
    name=TEXT,
    latitude=REAL,
    longitude=REAL,
    free_bikes=INT,
    empty_slots=INT,
    timestamp=TEXT,
    extra=_struct(uid=TEXT, address=TEXT),
)
SNAPSHOT_DOCUMENT = _struct(
    network_id=TEXT,
    city=TEXT,
    ingested_at=TEXT,
    network=_struct(stations=T.ArrayType(STATION_PAYLOAD)),
)
NETWORK_ENTRY = _struct(
    id=TEXT, name=TEXT, href=TEXT, location=_struct(city=TEXT, country=TEXT)
)
CATALOG_DOCUMENT = _struct(networks=T.ArrayType(NETWORK_ENTRY))
NETWORK_TARGET = _struct(
    requested_city=TEXT, city=TEXT, network_id=TEXT, network_name=TEXT, href=TEXT
)

_RANKED = T.StructType([*CLEAN.fields[:13], T.StructField("utilization_rank", INT, True)])

GOLD = {
    "latest_station_status": FACT,
    "top_utilization_stations": _RANKED,
    "low_availability_zones": _struct(
        city=TEXT,
        zone_id=TEXT,
        snapshot_timestamp=INSTANT,
        avg_bikes_available=REAL,
        avg_free_slots=REAL,
        avg_utilization_rate=REAL,
        station_count=LONG,
        shortage_flag=FLAG,
    ),
    "daily_usage_peaks": _struct(
        city=TEXT, usage_date=DATE, usage_hour=INT, estimated_activity=REAL, peak_rank=INT
    ),
    "geographic_imbalance": _struct(
        city=TEXT,
        zone_id=TEXT,
        snapshot_timestamp=INSTANT,
        avg_bikes_available=REAL,
        avg_capacity=REAL,
        zone_availability_ratio=REAL,
        city_availability_ratio=REAL,
        imbalance_score=REAL,
    ),
    "critical_stations": _struct(
        station_key=TEXT,
        city=TEXT,
        station_id=TEXT,
        station_name=TEXT,
        snapshot_timestamp=INSTANT,
        bikes_available=INT,
        free_slots=INT,
        utilization_rate=REAL,
        rolling_15m_utilization=REAL,
        is_empty=FLAG,
        alert_level=TEXT,
    ),
    "station_alerts": _struct(
        station_key=TEXT,
        city=TEXT,
        station_id=TEXT,
        station_name=TEXT,
        snapshot_timestamp=INSTANT,
        alert_type=TEXT,
        alert_message=TEXT,
        bikes_available=INT,
        free_slots=INT,
        utilization_rate=REAL,
        created_at=INSTANT,
    ),
}

# What the folds of later batches need besides the gold tables: the readings of the rolling window
# that ends at each station's latest row, and the two edges of each station's dates.
RECENT_READINGS = _pick(
    FACT, "station_key", "event_date", "snapshot_timestamp", "bikes_available", "utilization_rate"
)
_EDGE = _pick(
    FACT, "station_key", "city", "event_date", "event_hour", "snapshot_timestamp",
    "bikes_available", "free_slots",
)
TRANSITIONS = T.StructType(
    [*GOLD["station_alerts"].fields[:-1], T.StructField("alert_date", DATE, True)]
)
LATE_ROWS = T.StructType([*CLEAN.fields, T.StructField("watermark", INSTANT, True)])
REJECTED = _struct(raw=TEXT, reason=TEXT, rejected_on=DATE)
STATION_DAYS = _struct(station_key=TEXT, event_date=DATE, first_reading=_EDGE, last_reading=_EDGE)

_SUMMARY = _struct(
    city=TEXT,
    station_count=LONG,
    avg_utilization_rate=REAL,
    avg_bikes_available=REAL,
    empty_stations=LONG,
    low_stock_stations=LONG,
)

# What each serving function returns, in this order, also when there is no data.
FRAMES = {
    "latest": _pick(
        FACT, "city", "station_name", "latitude", "longitude", "bikes_available", "free_slots",
        "capacity", "utilization_rate", "zone_id", "snapshot_timestamp", "ingested_at",
    ),
    "top_stations": _pick(
        _RANKED, "city", "station_name", "bikes_available", "free_slots", "capacity",
        "utilization_rate", "zone_id", "snapshot_timestamp", "utilization_rank",
    ),
    "city_summary": _SUMMARY,
    "zones": _pick(
        GOLD["low_availability_zones"], "city", "zone_id", "station_count",
        "avg_bikes_available", "avg_free_slots", "avg_utilization_rate", "shortage_flag",
        "snapshot_timestamp",
    ),
    "peaks": GOLD["daily_usage_peaks"],
    "critical": _pick(
        GOLD["critical_stations"], "city", "station_name", "bikes_available", "free_slots",
        "utilization_rate", "rolling_15m_utilization", "is_empty", "snapshot_timestamp",
        "alert_level",
    ),
    "alerts": _pick(
        GOLD["station_alerts"], "city", "station_name", "alert_type", "alert_message",
        "bikes_available", "free_slots", "utilization_rate", "snapshot_timestamp", "created_at",
    ),
    "imbalance": _pick(
        GOLD["geographic_imbalance"], "city", "zone_id", "avg_bikes_available", "avg_capacity",
        "zone_availability_ratio", "city_availability_ratio", "imbalance_score",
        "snapshot_timestamp",
    ),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns: missing ones as null, extras dropped, order fixed."""
    return df.select(
        *[
            (F.col(field.name) if field.name in df.columns else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in schema.fields
        ]
    )
