"""Nested REST documents landed as files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.operators.networks import normalize_payload, resolve_targets
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.schema import CATALOG_DOCUMENT, NETWORK_TARGET, SNAPSHOT_DOCUMENT, conform
from gaugeflow.sources import files
from gaugeflow.sources.commits import CommitLog


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType, one_per_file: bool = False
) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", one_per_file).json(path)


def read_snapshots(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    return read_documents(spark, path, SNAPSHOT_DOCUMENT, one_per_file)


def read_catalog(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    return explode_catalog(read_documents(spark, path, CATALOG_DOCUMENT, one_per_file))


def explode_stations(documents: DataFrame) -> DataFrame:
    """One row per station of each snapshot document, with the document's context."""
    return documents.select(
        "network_id", "city", "ingested_at", F.explode("network.stations").alias("station")
    ).select("network_id", "city", "ingested_at", "station.*")


def explode_snapshot(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Wire records of snapshot documents."""
    return normalize_payload(explode_stations(documents), keep)


def explode_catalog(documents: DataFrame) -> DataFrame:
    """One row per network, with its position in the catalog."""
    return documents.select(F.posexplode("networks").alias("position", "network")).select(
        "position",
        "network.id",
        "network.name",
        "network.href",
        F.col("network.location.city").alias("city"),
        F.col("network.location.country").alias("country"),
    )


def save_targets(targets: DataFrame, path: str) -> None:
    """Keep resolved networks for a run in which discovery fails; one row per requested city.

    They are written aside and checked; a commit then makes them the current ones. Readers see the
    old targets or the new ones, and what cannot stand in for a discovery replaces nothing.
    """
    spark = targets.sparkSession
    name = uuid.uuid4().hex
    conform(targets, NETWORK_TARGET).coalesce(1).write.json(f"{path}/{name}")
    written = spark.read.schema(NETWORK_TARGET).json(f"{path}/{name}")
    usable = written.filter("requested_city IS NOT NULL AND network_id IS NOT NULL")
    n, cities = usable.agg(F.count("*"), F.count_distinct("requested_city")).first()
    if not n or n != cities or n != written.count():
        files.delete(spark, f"{path}/{name}")
        raise RuntimeError("these targets cannot be used by a later run")

    def change(state: dict) -> dict:
        # The folder before the last one goes; a reader may still be in the last.
        for old in state.get("older", ()):
            files.delete(spark, f"{path}/{old}")
        return {"current": name, "older": [state["current"]] if state else []}

    _targets_log(spark, path).commit(change)


def saved_targets(spark: SparkSession, path: str) -> DataFrame | None:
    _, state = _targets_log(spark, path).read()
    if not state:
        return None
    return spark.read.schema(NETWORK_TARGET).json(f"{path}/{state['current']}")


def _targets_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path}/commits", keep=5)


def discover_targets(
    spark: SparkSession,
    catalog_path: str,
    requested: Sequence[str],
    saved_path: str,
    params: Params = DEFAULTS,
    one_per_file: bool = True,
) -> DataFrame:
    """Networks of the requested cities from the landed catalog, saved for later runs.

    If the catalog is missing, unreadable or has none of the cities, the targets saved last stand
    in; without any, an error says so.
    """
    try:
        catalog = read_catalog(spark, catalog_path, one_per_file)
        targets = resolve_targets(catalog, requested, None, params)
    except (AnalysisException, RuntimeError):
        return resolve_targets(None, requested, saved_targets(spark, saved_path), params)
    save_targets(targets, saved_path)
    return saved_targets(spark, saved_path)
