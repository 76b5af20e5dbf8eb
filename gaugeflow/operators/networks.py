"""Station payload normalisation and the match of requested cities to networks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.text import filled, fold_label, fold_text
from gaugeflow.functions.timestamps import repair_timestamp_text
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.schema import NETWORK_TARGET, WIRE


def normalize_payload(stations: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Wire records from raw station objects; a station without any id is left out.

    Input: the payload columns plus network_id, city and ingested_at; ``keep`` names further ones
    to carry through.
    """
    station_id = F.coalesce(filled(F.col("id")), F.col("extra.uid"))
    stamped = repair_timestamp_text(F.col("timestamp"))
    shaped = stations.withColumns(
        {
            "station_id": station_id,
            "station_name": F.coalesce(filled(F.col("name")), F.col("extra.address")),
            "bikes_available": F.col("free_bikes"),
            "free_slots": F.col("empty_slots"),
            "timestamp": F.coalesce(stamped, F.col("ingested_at")),
            "station_key": F.concat("network_id", F.lit(":"), station_id),
            "ingested_at": repair_timestamp_text(F.col("ingested_at")),
        }
    )
    return shaped.filter(F.col("station_key").isNotNull()).select(*WIRE.names, *keep)


def _candidates(
    catalog: DataFrame, requested: Sequence[str], params: Params
) -> DataFrame:
    """One row per eligible network and requested city whose labels agree.

    The requests are a configured list, so they sit in the plan as literals and every network row
    tests them in place: no join. ``catalog`` has id, name, href, city, country and position.
    """
    wishes = F.array(
        *[
            F.struct(F.lit(name).alias("wish"), F.lit(fold_text(name)).alias("label"))
            for name in requested
        ]
    ).cast("array<struct<wish:string,label:string>>")
    eligible = (
        catalog.filter(F.upper("country").isin(*params.supported_countries))
        .withColumn("_city", fold_label("city"))
        .withColumn("_name", fold_label(F.coalesce("name", F.lit(""))))
        .filter(F.col("_city") != "")
    )
    hits = F.filter(
        wishes,
        lambda wish: (wish["label"] != "")
        & (F.col("_city").contains(wish["label"]) | wish["label"].contains(F.col("_city"))),
    )
    return (
        eligible.withColumn("_hit", F.explode(hits)).select(
            F.col("_hit.wish").alias("requested_city"),
            F.when(F.col("_hit.label") == F.col("_city"), 0).otherwise(1).alias("score"),
            F.length("_city").alias("label_length"),
            "_name",
            "position",
            F.coalesce("city", "_hit.wish").alias("city"),
            F.col("id").alias("network_id"),
            F.coalesce("name", "id").alias("network_name"),
            F.coalesce("href", F.concat(F.lit("/networks/"), F.col("id"))).alias("href"),
        )
    )


def match_networks(
    catalog: DataFrame, requested: Sequence[str], params: Params = DEFAULTS
) -> DataFrame:
    """The best network per requested city, with the number of networks it was chosen from.

    Best: equal label before contained label, shorter label, network name, catalog position. A
    minimum over the ordered tuple, so map tasks already reduce to one row per request.
    """
    return (
        _candidates(catalog, requested, params)
        .groupBy("requested_city")
        .agg(
            F.min(
                F.struct(
                    "score", "label_length", "_name", "position",
                    "city", "network_id", "network_name", "href",
                )
            ).alias("_best"),
            F.count(F.lit(1)).alias("candidates"),
        )
        .select(
            "requested_city",
            "_best.city",
            "_best.network_id",
            "_best.network_name",
            "_best.href",
            "candidates",
            (F.col("candidates") > 1).alias("ambiguous"),
        )
    )


def unmatched_cities(
    catalog: DataFrame, requested: Sequence[str], params: Params = DEFAULTS
) -> DataFrame:
    """Requested cities without any network."""
    asked = catalog.sparkSession.createDataFrame(
        [(name,) for name in requested], "requested_city string"
    )
    found = _candidates(catalog, requested, params).select("requested_city").distinct()
    return asked.join(found, "requested_city", "left_anti")


def resolve_targets(
    catalog: DataFrame | None,
    requested: Sequence[str],
    saved: DataFrame | None = None,
    params: Params = DEFAULTS,
) -> DataFrame:
    """Fresh targets if there are any, else the saved ones; an error when both are missing."""
    if catalog is not None:
        fresh = match_networks(catalog, requested, params).select(*NETWORK_TARGET.names)
        if not fresh.isEmpty():
            return fresh
    if saved is not None and not saved.isEmpty():
        return saved.select(*NETWORK_TARGET.names)
    raise RuntimeError("none of the requested cities has a network")
