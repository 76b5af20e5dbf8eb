from __future__ import annotations

import pytest
from conftest import random_readings, reading, rows
from pyspark.sql import functions as F

from gaugeflow.functions import display
from gaugeflow.operators import alerts, metrics, timeline, zones
from gaugeflow.operators.lateness import late_rows
from gaugeflow.params import Params
from gaugeflow.plans import frames, serving
from gaugeflow.schema import FRAMES, GOLD, conform


@pytest.fixture
def latest(facts):
    return facts(
        [
            reading("A", 0, 3, 7, "Paris"),
            reading("B", 1, 91, 9, "Lyon"),
            reading("C", 2, 1, 9, "Lyon"),
            reading("D", 3, 0, 5, "Lille"),
        ]
    )


def _instant(text: str):
    return F.lit(text).cast("timestamp")


def _log(spark, entries):
    return spark.createDataFrame(
        entries,
        "refreshed_at int, latest_snapshot string, total_stations bigint, "
        "avg_utilization_rate double, empty_stations bigint, critical_station_count bigint",
    )


def _deltas(spark, entries):
    found = metrics.metric_deltas(_log(spark, entries)).orderBy("refreshed_at")
    return [
        (
            r.delta_total_stations,
            round(r.delta_avg_utilization_rate, 6),
            r.delta_empty_stations,
            r.delta_critical_station_count,
            r.snapshot_changed,
        )
        for r in found.collect()
    ]


def test_deltas_between_snapshots(spark):
    old, new = (57, 0.31, 12, 4), (60, 0.36, 9, 7)
    zero = (0, 0.0, 0, 0)
    change = (3, 0.05, -3, 3)
    assert _deltas(spark, [(1, "s1", *old), (2, "s2", *new), (3, "s2", *old)]) == [
        (*zero, True),
        (*change, True),
        (*change, False),
    ]
    # The metrics of an unchanged refresh are not kept for the next comparison.
    later = (61, 0.36, 9, 7)
    assert _deltas(spark, [(1, "s1", *old), (2, "s1", *new), (3, "s2", *later)])[2] == (
        4, 0.05, -3, 3, True,
    )


def test_deltas_without_a_snapshot(spark):
    old, gap, new = (57, 0.31, 12, 4), (0, 0.0, 0, 0), (60, 0.36, 9, 7)
    found = _deltas(spark, [(1, None, *gap), (2, "s1", *old), (3, None, *gap), (4, "s2", *new)])
    assert found == [
        (0, 0.0, 0, 0, False),
        (57, 0.31, 12, 4, True),
        (57, 0.31, 12, 4, False),
        (60, 0.36, 9, 7, True),
    ]


def test_metrics_by_refresh_equal_a_recount(facts):
    params = Params(critical_utilization_threshold=0.5)
    history = facts(random_readings(300, 9, 5)).cache()
    found = metrics.metrics_by_refresh(history, 1800, params).collect()
    assert len(found) > 10
    for row in found[::5]:
        past = history.filter(F.col("snapshot_timestamp") < F.lit(row.refreshed_at))
        latest = timeline.latest_status(past)
        critical = alerts.critical_stations(latest, past, params)
        expected = metrics.overview_metrics(
            latest, critical, alerts.stamp(alerts.empty_alerts(latest), F.lit(row.refreshed_at)),
            F.lit(row.refreshed_at),
        ).first()
        assert row.total_stations == expected.total_stations
        assert row.avg_utilization_rate == pytest.approx(expected.avg_utilization_rate)
        assert row.empty_stations == expected.empty_stations == expected.alert_count_1h
        assert row.critical_station_count == expected.critical_station_count


def test_overview_of_nothing(spark):
    tables = [spark.createDataFrame([], GOLD[name]) for name in
              ("latest_station_status", "critical_stations", "station_alerts")]
    row = metrics.overview_metrics(*tables, _instant("2026-04-21 12:00:00")).first()
    assert tuple(row) == (0, 0, 0.0, 0, 0, 0, 0)


@pytest.mark.parametrize(
    ("now", "level", "age"),
    [
        ("2026-04-21 09:03:10", "live", 10),
        ("2026-04-21 09:05:00", "live", 120),
        ("2026-04-21 09:08:05", "warning", 305),
        ("2026-04-21 08:00:00", "live", 0),
    ],
)
def test_freshness(latest, now, level, age):
    row = serving.freshness(latest, _instant(now)).first()
    assert (row.level, row.age_seconds) == (level, age)
    assert row.message.endswith(f"il y a {age // 60} min {age % 60:02d} s.")
    assert row.snapshot_token == "2026-04-21T09:03:00+00:00"
    assert row.latest_snapshot_local == "21/04/2026 11:03:00"


def test_freshness_of_nothing(spark):
    empty = spark.createDataFrame([], GOLD["latest_station_status"])
    row = serving.freshness(empty, _instant("2026-04-21 09:08:05")).first()
    assert (row.level, row.snapshot_token, row.latest_ingested_local) == ("info", None, "-")


def test_focus(latest):
    names = lambda focus: rows(serving.focus_stations(latest, focus), "station_id")
    assert names("tension") == [("B",), ("C",), ("D",)]
    assert names("empty") == [("D",)]
    assert len(names("all")) == 4
    with pytest.raises(ValueError):
        serving.focus_stations(latest, "other")


@pytest.mark.parametrize(
    ("chosen", "cities"),
    [
        (["Lyon", "Nantes"], ["Lyon"]),
        (["Nantes"], ["Lille", "Lyon", "Paris"]),
        ([], ["Lille", "Lyon", "Paris"]),
    ],
)
def test_city_choice(latest, chosen, cities):
    found = serving.filter_cities(latest, chosen, serving.city_options(latest))
    assert rows(found.select("city").distinct()) == [(city,) for city in cities]


def test_city_options_fall_back_to_the_configured_ones(latest, spark):
    assert [r.city for r in serving.city_options(latest, ["Metz"]).collect()] == [
        "Lille", "Lyon", "Paris",
    ]
    empty = spark.createDataFrame([], GOLD["latest_station_status"])
    assert [r.city for r in serving.city_options(empty, ["Nice", "Metz"]).collect()] == [
        "Metz", "Nice",
    ]


def test_declared_columns(latest, spark):
    shaped = conform(latest.drop("zone_id").withColumn("extra", F.lit(1)), FRAMES["latest"])
    assert shaped.columns == FRAMES["latest"].names
    assert shaped.first().zone_id is None
    absent = serving.query_table(
        spark, "no_such_table", "SELECT * FROM no_such_table", {}, FRAMES["top_stations"]
    )
    assert absent.columns == FRAMES["top_stations"].names
    assert absent.count() == 0


def test_queries_with_parameters(latest, spark):
    latest.createOrReplaceTempView("stations_now")
    sql = "SELECT * FROM stations_now WHERE city = :city ORDER BY station_name LIMIT :n"
    found = serving.query_table(
        spark, "stations_now", sql, {"city": "Lyon", "n": 1}, FRAMES["latest"]
    )
    assert rows(found, "station_name") == [("Station B",)]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        serving.query_table(
            spark, "stations_now", "SELECT nothing FROM stations_now", {}, FRAMES["latest"]
        ).collect()


def test_zones_and_imbalance(facts):
    latest = facts(
        [reading("1", 0, 1, 9), reading("2", 1, 3, 1), reading("3", 0, 0, 0, "Lyon")]
    )
    (lyon, paris) = zones.low_availability_zones(latest).orderBy("city").collect()
    assert (paris.avg_bikes_available, paris.station_count, paris.shortage_flag) == (2.0, 2, False)
    assert (lyon.shortage_flag, lyon.avg_utilization_rate) == (True, 0.0)
    scores = zones.geographic_imbalance(latest).collect()
    assert [round(r.imbalance_score, 9) for r in scores] == [0.0, 0.0]


def test_map_frames(latest, spark):
    odd = latest.unionByName(
        latest.limit(1).withColumns({"latitude": F.lit(None).cast("double")})
    )
    assert frames.map_points(odd).count() == 4
    marks = {r.station_id: r for r in frames.station_markers(latest).collect()}
    assert {key: r.station_state for key, r in marks.items()} == {
        "A": "normal", "B": "sous tension", "C": "sous tension", "D": "vide",
    }
    assert marks["D"].fill_color == [200, 85, 61, 205]
    assert (marks["A"].radius, marks["A"].utilization_label) == (200, "30.0%")
    tiny = latest.limit(1).withColumn("capacity", F.lit(None).cast("int"))
    assert frames.station_markers(tiny).first().radius == 80
    centre = frames.map_centroid(frames.map_points(latest)).first()
    assert (round(centre.lat, 4), round(centre.lon, 4)) == (47.2184, -1.5536)


def test_localized_tables(latest):
    critical = alerts.critical_stations(latest, latest, Params(critical_utilization_threshold=0))
    shown = frames.localize(conform(critical, FRAMES["critical"])).orderBy("Station")
    assert shown.columns[:3] == ["Ville", "Station", "Velos disponibles"]
    assert [tuple(r)[4:] for r in shown.collect()] == [
        ("10.0%", "10.0%", "non", "21/04/2026 11:02:00", "critique"),
        ("0.0%", "0.0%", "oui", "21/04/2026 11:03:00", "vide et critique"),
    ]
    zone = zones.low_availability_zones(latest).withColumn("other", F.lit("x"))
    row = frames.localize(zone).orderBy("Ville").first()
    assert (row["Zone sous tension"], row["Utilisation moyenne"], row["other"]) == (
        "oui", "0.0%", "x",
    )


def test_number_formats(spark):
    df = spark.sql("SELECT 1234567 AS n, 0.1234 AS r, -3 AS down, 0 AS zero, 0.0004D AS tiny, 0.03D AS up")
    row = df.select(
        display.grouped_count(F.col("n")),
        display.percent(F.col("r")),
        display.signed_count(F.col("down")),
        display.signed_count(F.col("zero")),
        display.signed_count(F.col("n"), "st."),
        display.signed_rate(F.col("tiny")),
        display.signed_rate(F.col("up"), "pts"),
        display.count_direction(F.col("down")),
        display.rate_direction(F.col("tiny")),
        display.rate_direction(F.col("up")),
    ).first()
    assert tuple(row) == (
        "1 234 567", "12.3%", "-3", "Stable", "+1234567 st.", "Stable", "+3.0 pts", "down",
        "neutral", "up",
    )


def test_late_rows_include_the_watermark_itself(facts):
    history = facts([reading("1", m, 1, 1) for m in (0, 60, 50, 51, 49)]).withColumn(
        "batch",
        F.when(F.minute("snapshot_timestamp") == 0, 0).otherwise(1),
    )
    found = late_rows(history, "batch")
    assert [r.snapshot_timestamp.minute for r in found.orderBy("snapshot_timestamp").collect()] == [49, 50]
