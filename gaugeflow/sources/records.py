"""Keyed JSON records on a topic, and the optional JDBC export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.schema import WIRE


def decode_records(messages: DataFrame, schema: T.StructType = WIRE) -> DataFrame:
    """Message values as columns; unreadable messages become rows of nulls."""
    record = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(record.alias("record")).select("record.*")


def encode_records(records: DataFrame, key: str = "station_key") -> DataFrame:
    """(key, JSON value) messages; absent fields stay in the text as null."""
    body = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"})
    return records.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("key"), body.alias("value")
    )


def kafka_source_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def stream_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Decoded records of a topic (needs the Kafka connector on the class path)."""
    return decode_records(spark.readStream.format("kafka").options(**options).load())


def publish_topic(records: DataFrame, servers: str, topic: str) -> None:
    (
        encode_records(records)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def stream_json_folder(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Wire records landed as JSON lines."""
    reader = spark.readStream.schema(WIRE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str
) -> dict[str, str]:
    """Replace the rows, keep the table and its grants."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "truncate": "true",
    }


def export_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("overwrite").save()
