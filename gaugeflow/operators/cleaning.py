"""Typing, validation and derived columns of raw station records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.geo import zone_id
from gaugeflow.functions.timestamps import parse_timestamp
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.schema import CLEAN, WIRE

# Columns a record must carry, in the order the rejection report names them.
REQUIRED = (
    "station_key",
    "station_id",
    "station_name",
    "city",
    "network_id",
    "snapshot_timestamp",
    "ingested_at",
    "latitude",
    "longitude",
    "bikes_available",
    "free_slots",
)
GAUGES = ("bikes_available", "free_slots")
# Typed time column and the wire text it is read from.
TIMES = {"snapshot_timestamp": "timestamp", "ingested_at": "ingested_at"}

# (name of the fault, condition of a typed row that has it)
FAULTS = [(f"missing {name}", f"{name} IS NULL") for name in REQUIRED] + [
    (f"negative {name}", f"{name} < 0") for name in GAUGES
]


def _type_gauges(df: DataFrame) -> DataFrame:
    """Numbers as typed columns; what cannot be read becomes null."""
    kinds = {"latitude": "double", "longitude": "double"} | {name: "int" for name in GAUGES}
    return df.withColumns(
        {name: F.expr(f"try_cast({name} AS {kind})") for name, kind in kinds.items()}
    )


def _times() -> dict[str, Column]:
    return {name: parse_timestamp(F.col(source)) for name, source in TIMES.items()}


def _is_free_of(fault_columns: Sequence[str]) -> str:
    """SQL condition of rows without any fault that concerns these columns."""
    faults = [rule for name, rule in FAULTS if name.split()[-1] in fault_columns]
    return " AND ".join(f"NOT ({rule})" for rule in faults)


def clean_snapshots(
    df: DataFrame, params: Params = DEFAULTS, keep: Sequence[str] = ()
) -> DataFrame:
    """Valid records with capacity, fullness, zone, date and hour; narrow, no shuffle.

    Both times are parsed inside a one-row generator. Over plain columns the validity filter would
    be pushed below the parsing, and every text would be parsed twice; a generator holds it back
    and stays inside the same compiled stage. ``keep`` names further input columns to carry
    through.
    """
    parsed = F.struct(*[value.alias(name) for name, value in _times().items()])
    untimed = [name for name in REQUIRED if name not in TIMES]
    return (
        _type_gauges(df)
        .filter(_is_free_of(untimed))
        .withColumn("_times", F.explode(F.array(parsed)))
        .withColumns({name: F.expr(f"_times.{name}") for name in TIMES})
        .filter(_is_free_of(list(TIMES)))
        .withColumn("capacity", F.try_add("bikes_available", "free_slots"))
        .withColumns(
            {
                "utilization_rate": F.expr(
                    "IF(capacity > 0, bikes_available / capacity, 0.0D)"
                ),
                "zone_id": zone_id(
                    F.col("latitude"), F.col("longitude"), params.zone_decimals
                ),
                "event_date": F.to_date("snapshot_timestamp"),
                "event_hour": F.hour("snapshot_timestamp"),
            }
        )
        .select(*CLEAN.names, *keep)
    )


_UNREADABLE = "_unreadable"


def reject_messages(messages: DataFrame) -> DataFrame:
    """(raw, reason) of the messages (value) that decoding or cleaning drops, in one pass.

    reason is the first rule that the record breaks, or 'unreadable' for a text that is no JSON
    object of the declared kinds. raw is the whole text, so that a mended reader can take it again.
    """
    schema = T.StructType([*WIRE.fields, T.StructField(_UNREADABLE, T.StringType())])
    raw = F.col("value").cast("string")
    record = F.from_json(raw, schema, {"columnNameOfCorruptRecord": _UNREADABLE})
    # A generator keeps the parsing from being repeated for each rule.
    parsed = messages.select(raw.alias("raw"), F.explode(F.array(record)).alias("record"))
    typed = _type_gauges(parsed.select("raw", "record.*")).withColumns(_times())
    cases = " ".join(f"WHEN {rule} THEN '{name}'" for name, rule in FAULTS)
    unreadable = F.col("raw").isNull() | F.col(_UNREADABLE).isNotNull()
    reason = F.when(unreadable, "unreadable").otherwise(F.expr(f"CASE {cases} END"))
    return typed.select("raw", reason.alias("reason")).filter("reason IS NOT NULL")


def rejected_snapshots(df: DataFrame) -> DataFrame:
    """Records that cleaning drops, with the first rule each one breaks."""
    cases = " ".join(f"WHEN {rule} THEN '{name}'" for name, rule in FAULTS)
    typed = _type_gauges(df).withColumns(_times()).drop("timestamp")
    return typed.withColumn("reason", F.expr(f"CASE {cases} END")).filter("reason IS NOT NULL")


def count_reject_reasons(df: DataFrame) -> DataFrame:
    return (
        rejected_snapshots(df)
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )
