"""Station snapshots and a network catalog derived from the generated test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.operators.dedupe import facts_by_arrival
from gaugeflow.params import Params
from gaugeflow.schema import WIRE

# Thresholds that give a useful number of rows on the derived stations.
PARAMS = Params(low_availability_threshold=8, critical_utilization_threshold=0.6)
CATALOG_PARAMS = Params(supported_countries=("AMERICA", "EUROPE"))
REQUESTED = ("nation_1", "NATION_3", " Nation_8 ", "nowhere")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire records plus ``arrival_id``: one snapshot per event, one real hour per poll minute."""
    readings = table(spark, sf_dir, "events").selectExpr(
        "event_id AS e",
        "user_id AS u",
        "event_type AS t",
        "value AS v",
        "CASE WHEN user_id % 37 = 0 THEN 0 WHEN user_id % 10 = 3 THEN 2 "
        "ELSE 8 + user_id % 15 END AS cap",
        "timestampadd(MINUTE, timestampdiff(HOUR, TIMESTAMP '2024-01-01 00:00:00', "
        "CAST(ts AS TIMESTAMP)), TIMESTAMP '2024-01-01 18:00:00') AS at",
    ).selectExpr(
        "*",
        "CAST(floor(v) AS BIGINT) % (cap + 1) AS b",
        "date_format(at, \"yyyy-MM-dd'T'HH:mm:ss\") AS iso",
        "date_format(timestampadd(SECOND, CAST(e % 60 AS INT), at), "
        "\"yyyy-MM-dd'T'HH:mm:ss\") AS ingested",
    )
    return readings.selectExpr(
        "CAST(u AS STRING) AS station_id",
        "concat('Station ', u) AS station_name",
        "CAST(43.001 + u % 5 + 0.003 * (u % 7) AS DOUBLE) AS latitude",
        "CAST(-0.999 + u % 5 + 0.003 * (u % 4) AS DOUBLE) AS longitude",
        "CAST(CASE WHEN t = 'error' AND v > 150 THEN -1 ELSE b END AS INT) AS bikes_available",
        "CAST(CASE WHEN t = 'view' AND v > 200 THEN NULL ELSE cap - b END AS INT) AS free_slots",
        "CASE WHEN e % 997 = 0 THEN 'not-a-timestamp' WHEN e % 3 = 0 THEN concat(iso, '+00:00Z') "
        "ELSE concat(iso, 'Z') END AS timestamp",
        "concat('net_', u % 5) AS network_id",
        "concat('city_', u % 5) AS city",
        "concat('net_', u % 5, ':', u) AS station_key",
        "concat(ingested, 'Z') AS ingested_at",
        "e AS arrival_id",
    ).select("arrival_id", *WIRE.names)


def facts_with_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts_by_arrival(raw_snapshots(spark, sf_dir), "arrival_id", PARAMS)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts_with_arrival(spark, sf_dir).drop("arrival_id")


def arrived_late_half(spark: SparkSession, sf_dir: str):
    """Condition on ``arrival_id``: the second half of all arrivals."""
    newest = table(spark, sf_dir, "events").agg(F.max("event_id")).scalar()
    return F.col("arrival_id") * 2 > newest


def payloads(spark: SparkSession, sf_dir: str, blanks: bool) -> DataFrame:
    """Raw station objects, if asked with blanks that extra fields or the poll time make up for."""
    e = F.col("arrival_id")

    def absent(every: int):
        return (e % every == 0) & F.lit(blanks)

    return raw_snapshots(spark, sf_dir).select(
        F.when(absent(11), "").otherwise(F.col("station_id")).alias("id"),
        F.when(~absent(13), F.col("station_name")).alias("name"),
        "latitude",
        "longitude",
        F.col("bikes_available").alias("free_bikes"),
        F.col("free_slots").alias("empty_slots"),
        F.when(absent(17), " ").otherwise(F.col("timestamp")).alias("timestamp"),
        F.struct(
            F.col("station_id").alias("uid"), F.col("station_name").alias("address")
        ).alias("extra"),
        "network_id",
        "city",
        "ingested_at",
        "arrival_id",
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One network per supplier: city is the nation, country the region."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("position"),
            F.col("s_suppkey").cast("string").alias("id"),
            F.col("s_name").alias("name"),
            F.concat(F.lit("/v2/networks/"), "s_suppkey").alias("href"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
        )
    )
