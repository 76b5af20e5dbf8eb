from __future__ import annotations

from conftest import rows, wire
from pyspark.sql import functions as F

from gaugeflow.functions.geo import zone_id
from gaugeflow.functions.timestamps import (
    display_timestamp,
    parse_timestamp,
    repair_timestamp_text,
    snapshot_token,
    time_bucket,
)
from gaugeflow.operators.cleaning import clean_snapshots, count_reject_reasons
from gaugeflow.operators.dedupe import facts_by_arrival, transform_snapshots
from gaugeflow.schema import CLEAN, WIRE
from gaugeflow.sources.records import decode_records, encode_records


def test_valid_record_is_enriched_and_negative_count_dropped(frame):
    cleaned = clean_snapshots(frame([wire(), wire(station_key="quaybikes:124", bikes_available=-1)]))
    assert cleaned.columns == CLEAN.names
    (row,) = cleaned.collect()
    assert (row.capacity, row.utilization_rate, row.zone_id) == (10, 0.6, "47.22_-1.55")
    assert (str(row.event_date), row.event_hour) == ("2026-04-21", 9)


def test_zero_capacity_is_kept_with_zero_fullness(frame):
    (row,) = clean_snapshots(frame([wire(bikes_available=0, free_slots=0)])).collect()
    assert row.utilization_rate == 0.0


def test_every_required_column_and_both_times_are_enforced(frame):
    broken = [wire(**{name: None}) for name in WIRE.names]
    broken.append(wire(timestamp="soon"))
    assert clean_snapshots(frame(broken)).count() == 0
    assert clean_snapshots(frame(broken + [wire()])).count() == 1


def test_reject_report_names_the_first_broken_rule(frame):
    bad = [
        wire(station_key=None, city=None),
        wire(city=None),
        wire(timestamp="soon"),
        wire(free_slots=-3),
        wire(bikes_available=-1, free_slots=None),
        wire(),
    ]
    assert rows(count_reject_reasons(frame(bad))) == [
        ("missing city", 1),
        ("missing free_slots", 1),
        ("missing snapshot_timestamp", 1),
        ("missing station_key", 1),
        ("negative free_slots", 1),
    ]


def test_text_numbers_are_read_or_rejected(frame):
    text = frame([wire()]).select(
        *[F.col(name).cast("string").alias(name) for name in WIRE.names]
    )
    odd = text.withColumn("bikes_available", F.lit("many"))
    assert clean_snapshots(text.unionByName(odd)).count() == 1


def test_timestamp_forms(spark):
    forms = {
        "2026-04-21T11:59:43.000998+00:00Z": "2026-04-21 11:59:43.000998",
        "2026-04-21T11:59:43+02:00": "2026-04-21 09:59:43",
        " 2026-04-21T11:59:43Z ": "2026-04-21 11:59:43",
        "2026-04-21 11:59:43": "2026-04-21 11:59:43",
        "2026-04-21T11:59:43-0130Z": "2026-04-21 13:29:43",
        "gone": None,
        "": None,
    }
    df = spark.createDataFrame([(text,) for text in forms], "t string")
    parsed = {r.t: r.p for r in df.select("t", parse_timestamp(F.col("t")).cast("string").alias("p")).collect()}
    assert parsed == forms


def test_timestamp_text_repair(spark):
    forms = {
        "2026-04-21T11:59:43.000998+00:00Z": "2026-04-21T11:59:43.000998+00:00",
        "\t2026-04-21T11:59:43Z ": "2026-04-21T11:59:43Z",
        "2026-04-21T11:59:43-0130Z": "2026-04-21T11:59:43-0130",
        "  ": None,
    }
    df = spark.createDataFrame([(text,) for text in forms], "t string")
    repaired = df.select("t", repair_timestamp_text(F.col("t")).alias("r")).collect()
    assert {r.t: r.r for r in repaired} == forms


def test_token_display_and_bucket(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2026-04-21 12:00:00' AS a, TIMESTAMP '2026-01-21 12:00:00.25' AS b, "
        "CAST(NULL AS TIMESTAMP) AS c, TIMESTAMP '1969-12-31 23:59:59' AS d"
    )
    row = df.select(
        snapshot_token(F.col("a")),
        snapshot_token(F.col("b")),
        display_timestamp(F.col("a")),
        display_timestamp(F.col("b")),
        display_timestamp(F.col("c")),
        time_bucket(F.col("d"), 60),
    ).first()
    assert tuple(row) == (
        "2026-04-21T12:00:00+00:00",
        "2026-01-21T12:00:00.250000+00:00",
        "21/04/2026 14:00:00",
        "21/01/2026 13:00:00",
        "-",
        -1,
    )


def test_zone_grid_edges(spark):
    places = {(47.2184, -1.5536): "47.22_-1.55", (-0.001, -0.996): "0.00_-1.00", (7.0, 0.1): "7.00_0.10"}
    df = spark.createDataFrame(list(places), "a double, b double")
    zones = df.select("a", "b", zone_id(F.col("a"), F.col("b"), 2).alias("z")).collect()
    assert {(r.a, r.b): r.z for r in zones} == places
    odd = spark.sql("SELECT double('NaN') AS a, 1e300 AS b")
    assert odd.select(zone_id(F.col("a"), F.col("b"), 2)).first()[0].startswith("NaN_1")


def test_messages_round_trip_and_bad_json_becomes_nulls(frame, spark):
    records = frame([wire(), wire(station_key=None), wire(station_key="quaybikes:9", free_slots=None)])
    messages = encode_records(records)
    assert rows(messages, "key") == [("quaybikes:417",), ("quaybikes:9",)]
    assert '"free_slots":null' in {r.key: r.value for r in messages.collect()}["quaybikes:9"]
    assert rows(decode_records(messages)) == rows(records.filter("station_key IS NOT NULL"))
    bad = spark.createDataFrame(
        [("{broken",), ('{"bikes_available": 4.0, "city": "Paris"}',)], "value string"
    )
    assert rows(decode_records(bad), "bikes_available", "city") == [(None, "Paris"), (None, None)]


def test_first_arrival_wins_and_stream_form_keeps_one(frame):
    copies = frame([wire(bikes_available=n) for n in (5, 7, 9)]).withColumn(
        "arrival", F.when(F.col("bikes_available") == 7, 0).otherwise(F.col("bikes_available"))
    )
    assert rows(facts_by_arrival(copies, "arrival"), "bikes_available") == [(7,)]
    assert transform_snapshots(copies.drop("arrival")).count() == 1
