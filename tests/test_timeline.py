from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import START, random_readings, reading, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from gaugeflow.operators import activity, alerts, ranking, timeline
from gaugeflow.params import Params


def _station():
    return Window.partitionBy("station_key").orderBy("snapshot_timestamp")


@pytest.fixture
def history(facts):
    return facts(random_readings(900, 12, seed=7)).cache()


def _brute_rolling(history):
    """{(station, time): mean} by comparing all rows of a station in Python."""
    stations: dict[str, list] = {}
    for row in history.collect():
        stations.setdefault(row.station_key, []).append(row)
    means = {}
    for members in stations.values():
        for row in members:
            inside = [
                other.utilization_rate
                for other in members
                if timedelta(0)
                <= row.snapshot_timestamp - other.snapshot_timestamp
                <= timedelta(minutes=15)
            ]
            means[row.station_key, row.snapshot_timestamp] = sum(inside) / len(inside)
    return means


def test_latest_is_the_newest_row(history):
    newest = (
        history.withColumn("n", F.row_number().over(_station().orderBy(F.desc("snapshot_timestamp"))))
        .filter("n = 1")
        .drop("n")
    )
    assert rows(timeline.latest_status(history)) == rows(newest)


@pytest.mark.parametrize("bucket", [60, 3600, 86400])
def test_previous_equals_plain_lag(history, bucket):
    plain = history.withColumn("prev_free_slots", F.lag("free_slots").over(_station()))
    sliced = timeline.previous_per_key(
        history, "station_key", "snapshot_timestamp", ["free_slots"], bucket
    )
    assert rows(sliced) == rows(plain)


@pytest.mark.parametrize("bucket", [600, 3600, 7200])
def test_rolling_mean_equals_brute_force(history, bucket):
    expected = _brute_rolling(history)
    found = timeline.rolling_utilization(history, Params(rolling_bucket_seconds=bucket))
    assert found.count() == len(expected)
    for row in found.collect():
        assert row.rolling_15m_utilization == pytest.approx(
            expected[row.station_key, row.snapshot_timestamp]
        )


def test_window_includes_both_ends(facts):
    history = facts([reading("1", 0, 0, 4), reading("1", 15, 4, 0), reading("1", 30.01, 0, 4)])
    found = timeline.rolling_utilization(history).orderBy("snapshot_timestamp").collect()
    assert [row.rolling_15m_utilization for row in found] == [0.0, 0.5, 0.0]
    at_latest = timeline.rolling_at_latest(timeline.latest_status(history), history)
    assert at_latest.first().rolling_15m_utilization == 0.0


def test_rolling_mean_of_values_that_do_not_fit(spark):
    inf, nan = float("inf"), float("nan")
    cases = {
        "nan": [0.5, nan, None, 0.5],
        "up": [0.5, inf, 0.5, 0.5],
        "both": [inf, -inf, 0.5, 0.5],
        "big": [0.5, 2e12, 0.5, 0.5],
    }
    readings = [
        (name, START + timedelta(minutes=10 * k), value)
        for name, values in cases.items()
        for k, value in enumerate(values)
    ]
    history = spark.createDataFrame(readings, "k string, at timestamp, v double")
    found: dict[str, list] = {}
    for row in timeline.rolling_time_avg(history, "k", "at", "v", "mean").orderBy("k", "at").collect():
        found.setdefault(row.k, []).append(row.mean)
    assert repr(found["nan"]) == repr([0.5, nan, nan, 0.5])
    assert found["up"] == [0.5, inf, inf, 0.5]
    assert repr(found["both"]) == repr([inf, nan, -inf, 0.5])
    assert found["big"] == [0.5, None, None, 0.5]


@pytest.mark.parametrize("bucket", [600, 7200])
def test_rolling_mean_of_few_rows_is_that_of_doubles_in_order(facts, bucket):
    # All minutes of four hours, in capacities whose shares are no short decimals.
    readings = [reading("1", k, k * 7 % 11, 11 + k % 3 - k * 7 % 11) for k in range(240)]
    history = facts(readings).cache()
    members = history.orderBy("snapshot_timestamp").collect()
    expected = {}
    for n, row in enumerate(members):
        total, inside = 0.0, members[max(n - 15, 0) : n + 1]
        for other in inside:
            total += other.utilization_rate
        expected[row.snapshot_timestamp] = total / len(inside)
    found = timeline.rolling_utilization(history, Params(rolling_bucket_seconds=bucket))
    assert {
        row.snapshot_timestamp: row.rolling_15m_utilization for row in found.collect()
    } == expected
    at_latest = timeline.rolling_at_latest(timeline.latest_status(history), history).first()
    assert at_latest.rolling_15m_utilization == expected[at_latest.snapshot_timestamp]


def test_rolling_mean_of_rows_of_one_time(spark):
    times = [0, 0, 5, *[10 + k / 100 for k in range(40)], 20]
    history = spark.createDataFrame(
        [("a", START + timedelta(minutes=at), float(n)) for n, at in enumerate(times)],
        "k string, at timestamp, v double",
    )
    found = timeline.rolling_time_avg(history, "k", "at", "v", "mean").orderBy("at", "v").collect()
    for row in found:
        inside = [o.v for o in found if timedelta(0) <= row.at - o.at <= timedelta(minutes=15)]
        assert row["mean"] == pytest.approx(sum(inside) / len(inside))


def test_join_at_latest_equals_the_window_form(history):
    latest = timeline.latest_status(history)
    by_join = timeline.rolling_at_latest(latest, history)
    by_window = timeline.latest_status(timeline.rolling_utilization(history))
    assert {
        row.station_key: pytest.approx(row.rolling_15m_utilization) for row in by_window.collect()
    } == {row.station_key: row.rolling_15m_utilization for row in by_join.collect()}


def test_window_that_does_not_divide_the_day(history):
    params = Params(rolling_window_seconds=1000)
    latest = timeline.latest_status(history)
    by_join = timeline.rolling_at_latest(latest, history, params)
    by_window = timeline.latest_status(timeline.rolling_utilization(history, params))
    column = F.round("rolling_15m_utilization", 9)
    assert rows(by_join, "station_key", column) == rows(by_window, "station_key", column)


@pytest.mark.parametrize("bucket", [900, 7200, 86400])
def test_transitions_equal_plain_lag(history, bucket):
    params = Params(critical_utilization_threshold=0.5, rolling_bucket_seconds=bucket)
    logged = alerts.alert_history(history, params)
    flags = {(r.station_key, r.snapshot_timestamp, r.alert_type) for r in logged.collect()}
    expected = set()
    for kind in ("empty", "critical"):
        on = {(key, at) for key, at, which in flags if which == kind}
        before: dict[str, bool] = {}
        for row in history.orderBy("station_key", "snapshot_timestamp").collect():
            now = (row.station_key, row.snapshot_timestamp) in on
            if now and not before.get(row.station_key, False):
                expected.add((row.station_key, row.snapshot_timestamp, kind))
            before[row.station_key] = now
    found = alerts.alert_transitions(history, params).collect()
    assert len(found) == len(expected) > 0
    assert {(r.station_key, r.snapshot_timestamp, r.alert_type) for r in found} == expected


def test_critical_needs_few_bikes_and_a_full_window(facts):
    history = facts(
        [reading("1", 0, 9, 1), reading("1", 5, 10, 0), reading("1", 10, 2, 0)]
        + [reading("2", 0, 9, 1), reading("2", 10, 0, 10)]
        + [reading("3", 0, 2, 0)]
    )
    latest = timeline.latest_status(history)
    critical = alerts.critical_stations(latest, history)
    assert rows(critical, "station_id", "is_empty", "alert_level") == [
        ("1", False, "critical"),
        ("3", False, "critical"),
    ]
    current = alerts.current_alerts(latest, critical)
    assert rows(current, "station_id", "alert_type", "alert_message") == [
        ("1", "critical", "Station 1 is critically constrained"),
        ("2", "empty", "Station 2 is empty"),
        ("3", "critical", "Station 3 is critically constrained"),
    ]


def _plain_activity(history):
    moved = F.greatest(
        *[
            F.abs(F.col(name) - F.coalesce(F.lag(name).over(_station()), F.col(name)))
            for name in ("bikes_available", "free_slots")
        ]
    )
    return (
        history.withColumn("moved", moved.cast("double"))
        .groupBy(
            "city",
            F.col("event_date").alias("usage_date"),
            F.col("event_hour").alias("usage_hour"),
        )
        .agg(F.sum("moved").alias("estimated_activity"))
    )


def test_hourly_activity_equals_the_plain_window(history):
    assert rows(activity.hourly_activity(history)) == rows(_plain_activity(history))


def test_hourly_activity_when_a_station_changes_city(facts):
    history = facts(
        [
            reading("1", 0, 5, 5, "Paris"),
            reading("1", 10, 7, 3, "Lyon"),
            reading("1", 20, 1, 9, "Paris"),
            reading("1", 200, 4, 6, "Lyon"),
        ]
    )
    assert rows(activity.hourly_activity(history)) == rows(_plain_activity(history))


@pytest.mark.parametrize("seed", [1, 2])
def test_folded_activity_equals_the_full_form_with_late_facts(facts, seed):
    history = facts(random_readings(500, 8, seed))
    minute = F.unix_seconds("snapshot_timestamp") / 60
    # Half of the new facts are older than the known ones; one station is new altogether.
    new = (minute % 3 == 0) | (F.col("station_id") == "4")
    known, fresh = history.filter(~new), history.filter(new)
    latest = timeline.latest_status(known)
    assert activity.has_late_facts(fresh, latest)
    folded = activity.fold_activity(activity.hourly_activity(known), fresh, latest, known)
    assert rows(folded) == rows(activity.hourly_activity(history))


def test_folded_activity_in_order_needs_no_history(facts):
    history = facts(random_readings(400, 8, 3))
    new = F.col("snapshot_timestamp") >= F.lit("2026-04-21 14:00:00").cast("timestamp")
    known, fresh = history.filter(~new), history.filter(new)
    latest = timeline.latest_status(known)
    assert not activity.has_late_facts(fresh, latest)
    folded = activity.fold_activity(activity.hourly_activity(known), fresh, latest)
    assert rows(folded) == rows(activity.hourly_activity(history))
    folded_latest = timeline.fold_latest(latest, fresh)
    assert rows(folded_latest) == rows(timeline.latest_status(history))


def test_global_rank_equals_the_single_window(history):
    order = [F.desc("utilization_rate"), F.asc("bikes_available"), F.asc("station_name")]
    plain = history.withColumn("utilization_rank", F.dense_rank().over(Window.orderBy(*order)))
    assert rows(ranking.utilization_ranking(history, partitions=5)) == rows(plain)
    top = ranking.top_utilization(history, 9)
    assert rows(top) == rows(plain.filter("utilization_rank <= 9"))
