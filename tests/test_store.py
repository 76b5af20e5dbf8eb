from __future__ import annotations

import pytest
from conftest import random_readings, reading, rows
from pyspark.sql import functions as F

from gaugeflow.operators import activity, alerts, timeline
from gaugeflow.operators.upsert import append_if_absent, restrict_to_spans
from gaugeflow.params import Params
from gaugeflow.plans.refresh import recent_history, refresh_all, refresh_batch
from gaugeflow.schema import FACT_KEY
from gaugeflow.session import fresh_dir
from gaugeflow.sources import files
from gaugeflow.sources.store import PUBLISHED, StationStore

PARAMS = Params(critical_utilization_threshold=0.5, low_availability_threshold=4)


@pytest.fixture
def store(spark):
    return StationStore(spark, fresh_dir(spark, "store"), keep_versions=3)


def _created():
    return F.lit("2026-04-22 00:00:00").cast("timestamp")


def _by_batch(table):
    return rows(table.drop("batch_id"))


def test_first_writer_of_a_key_wins(facts):
    old = facts([reading("1", 0, 1, 1), reading("2", 0, 2, 2)])
    new = facts([reading("1", 0, 9, 9), reading("1", 5, 3, 3)])
    merged = append_if_absent(old, new, FACT_KEY)
    assert rows(merged, "station_id", "bikes_available") == [("1", 1), ("1", 3), ("2", 2)]


def test_spans_restrict_the_comparison_without_changing_it(facts):
    stored = facts([reading("1", minute, 1, 1) for minute in (0, 10, 20, 2000, 4000)])
    incoming = facts([reading("2", minute, 1, 1) for minute in (5, 20, 2000)])

    def kept(batch=incoming):
        left = restrict_to_spans(stored, batch, "event_date", "snapshot_timestamp")
        assert left.columns == stored.columns
        return sorted(r.snapshot_timestamp.strftime("%d %H:%M") for r in left.collect())

    assert kept() == ["21 09:10", "21 09:20", "22 18:20"]
    assert kept(incoming.limit(0)) == []


def test_any_number_of_dates_prunes_the_scan(spark, facts):
    path = fresh_dir(spark, "dates")
    days = range(0, 600)
    stored = facts([reading("1", day * 1440, 1, 1) for day in days])
    stored.coalesce(1).write.partitionBy("event_date").parquet(path)
    wanted = facts([reading("2", day * 1440, 1, 1) for day in days if day % 6])
    left = restrict_to_spans(
        spark.read.parquet(path), wanted, "event_date", "snapshot_timestamp"
    )
    assert left.count() == 500
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_date" in plan and "INSET" in plan.upper()


def test_recent_history_covers_windows_across_midnight(facts):
    # 15:00 hours after the start is midnight.
    history = facts([reading("1", minute, 1, 1) for minute in (880, 890, 898, 902, 905, 960)])
    latest = history.filter(F.col("snapshot_timestamp") == history.agg(
        F.max("snapshot_timestamp")).scalar() - F.expr("INTERVAL 55 MINUTES"))
    found = recent_history(latest, history, PARAMS)
    assert [r.snapshot_timestamp.strftime("%H:%M") for r in found.collect()] == [
        "23:50", "23:58", "00:02", "00:05",
    ]


def test_empty_store_has_the_declared_columns(store):
    assert store.facts().count() == store.alerts().count() == 0
    for name, schema in PUBLISHED.items():
        assert store.gold(name).columns == schema.names


def test_repeated_batches_change_nothing(store, facts):
    first = facts([reading("1", 0, 1, 1), reading("2", 0, 2, 2)])
    second = facts([reading("1", 0, 9, 9), reading("1", 5, 3, 3)])
    store.append_facts(first, "run", 0)
    expected = [("1", 0, 1), ("1", 1, 3), ("2", 0, 2)]
    for _ in range(3):
        fresh = store.append_facts(second, "run", 1)
        assert rows(fresh, "bikes_available") == [(3,)]
        assert rows(store.facts(), "station_id", "batch_id", "bikes_available") == expected
    # A new run numbers its batches from 0 again and must not replace older ones.
    store.append_facts(facts([reading("3", 0, 4, 4)]), "other", 0)
    assert store.facts().count() == 4
    for _ in range(2):
        store.append_archive(first.withColumn("batch_id", F.lit(0)), "run", 0)
    assert _by_batch(store.archive()) == _by_batch(first)


def test_numeric_city_names_survive_the_archive(store, facts):
    batch = facts([reading("1", 0, 1, 1, city="0042")])
    store.append_archive(batch, "run", 0)
    assert rows(store.archive(), "city") == [("0042",)]


def test_alert_log_keeps_one_row_per_natural_key(store, facts):
    latest = facts([reading("1", 0, 0, 5), reading("2", 0, 1, 0)])
    critical = alerts.critical_stations(latest, latest, PARAMS)
    current = alerts.stamp(alerts.current_alerts(latest, critical), _created())
    for batch in (0, 0, 1):
        store.append_alerts(current, "run", batch)
    assert rows(store.alerts(), "station_id", "alert_type") == [("1", "empty"), ("2", "critical")]


def _check_gold(store, known):
    """Every published table equals its full form over all facts."""
    latest = timeline.latest_status(known)
    assert rows(store.gold("latest_station_status").drop("batch_id")) == rows(
        latest.drop("batch_id")
    )
    hourly = activity.hourly_activity(known)
    assert rows(store.gold("hourly_activity")) == rows(hourly)
    assert rows(store.gold("daily_usage_peaks")) == rows(activity.daily_usage_peaks(hourly))
    critical = alerts.critical_stations(latest, known, PARAMS)
    rate = F.round("rolling_15m_utilization", 9)
    assert rows(store.gold("critical_stations"), "station_key", rate, "alert_level") == rows(
        critical, "station_key", rate, "alert_level"
    )
    assert store.gold("top_utilization_stations").count() == latest.count()
    cities = latest.select("city").distinct().count()
    assert store.gold("low_availability_zones").count() == cities
    assert store.gold("geographic_imbalance").count() == cities


def test_batches_folded_in_equal_a_full_refresh(store, facts, spark):
    history = facts(random_readings(300, 6, 11, minutes=2000)).cache()
    minute = F.unix_seconds("snapshot_timestamp") / 60
    parts = [
        history.filter(minute % 5 < 2),
        history.filter((minute % 5 >= 2) & (minute % 5 < 4)),
        history.filter(minute % 5 >= 4),
    ]
    known = None
    for number, part in enumerate(parts):
        batch = part.withColumn("batch_id", F.lit(number).cast("bigint"))
        known = batch if known is None else known.unionByName(batch)
        for _ in range(2):
            refresh_batch(store, batch, "run", number, PARAMS, _created())
        _check_gold(store, known)
    logged = rows(store.alerts())
    assert len({row[:1] + row[4:6] for row in logged}) == len(logged)
    assert len(store._versions()) == 3
    everything = StationStore(spark, fresh_dir(spark, "full"))
    everything.append_facts(history, "run", 0)
    refresh_all(everything, "run", 0, PARAMS, _created())
    for name in PUBLISHED:
        drop = [c for c in ("batch_id", "rolling_15m_utilization", "avg_utilization_rate",
                            "zone_availability_ratio", "city_availability_ratio",
                            "imbalance_score") if c in PUBLISHED[name].names]
        assert rows(everything.gold(name).drop(*drop)) == rows(store.gold(name).drop(*drop)), name


def test_a_crash_before_publishing_leaves_the_old_tables(store, facts, monkeypatch):
    first = facts([reading("1", 0, 3, 3)]).withColumn("batch_id", F.lit(0).cast("bigint"))
    second = facts([reading("1", 5, 9, 1)]).withColumn("batch_id", F.lit(1).cast("bigint"))
    refresh_batch(store, first, "run", 0, PARAMS, _created())

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(StationStore, "publish", lost)
        with pytest.raises(RuntimeError):
            refresh_batch(store, second, "run", 1, PARAMS, _created())
    assert rows(store.gold("latest_station_status"), "bikes_available") == [(3,)]
    refresh_batch(store, second, "run", 1, PARAMS, _created())
    assert rows(store.gold("latest_station_status"), "bikes_available") == [(9,)]
    assert rows(store.gold("hourly_activity"), "estimated_activity") == [(6.0,)]


def _batch(facts, number, *records):
    return facts(list(records)).withColumn("batch_id", F.lit(number).cast("bigint"))


def test_many_repeats_of_a_batch_lose_nothing(store, facts):
    refresh_batch(store, _batch(facts, 0, reading("1", 0, 3, 3)), "run", 0, PARAMS, _created())
    again = _batch(facts, 1, reading("1", 5, 9, 1), reading("2", 5, 4, 4))
    for _ in range(8):
        refresh_batch(store, again, "run", 1, PARAMS, _created())
    _check_gold(store, store.facts())
    assert len(store._versions()) == 2
    assert rows(store.gold("hourly_activity"), "estimated_activity") == [(6.0,)]


def test_a_crash_before_publishing_and_a_new_run(store, facts, monkeypatch):
    first = _batch(facts, 0, reading("1", 0, 3, 3))
    second = _batch(facts, 1, reading("1", 5, 9, 1))
    refresh_batch(store, first, "a", 0, PARAMS, _created())
    with monkeypatch.context() as patch:
        patch.setattr(StationStore, "publish", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_batch(store, second, "a", 1, PARAMS, _created())
    # The new run reads everything again; what the lost one stored is not new to it.
    both = _batch(facts, 0, reading("1", 0, 3, 3), reading("1", 5, 9, 1))
    refresh_batch(store, both, "b", 0, PARAMS, _created())
    _check_gold(store, store.facts())
    assert rows(store.gold("latest_station_status"), "bikes_available") == [(9,)]
    assert rows(store.gold("hourly_activity"), "estimated_activity") == [(6.0,)]
    assert store.pending() == []
    folders = [n for n in files.names(store.spark, f"{store.root}/gold") if len(n) == 32]
    assert len(folders) == len(store._versions())


def test_a_repeat_after_another_run_counts_once(store, facts):
    parts = [("a", 0, 0, 3), ("a", 1, 5, 9), ("b", 0, 10, 2)]
    for run, number, minute, bikes in [*parts, parts[1], parts[0]]:
        batch = _batch(facts, number, reading("1", minute, bikes, 10 - bikes))
        refresh_batch(store, batch, run, number, PARAMS, _created())
    _check_gold(store, store.facts())
    assert rows(store.gold("hourly_activity"), "estimated_activity") == [(13.0,)]


def test_a_rebuild_holds_every_stored_batch(store, facts):
    for number in (0, 1, 2, 5):
        batch = _batch(facts, number, reading("1", number, number + 1, 4))
        store.append_facts(batch, "run", number)
    refresh_all(store, "run", 5, PARAMS, _created())
    assert store._versions()[0]["holds"] == {"run": [[0, 2], [5, 5]]}
    assert store.holds("run", 1) and not store.holds("run", 3)
    refresh_batch(
        store, _batch(facts, 3, reading("1", 30, 0, 9)), "run", 3, PARAMS, _created()
    )
    assert store._versions()[0]["holds"] == {"run": [[0, 3], [5, 5]]}
    _check_gold(store, store.facts())


def test_replaced_text_and_deleted_versions(spark):
    path = f"{fresh_dir(spark, 'text')}/pointer.json"
    for text in ("one", "zwei – ü"):
        files.replace_text(spark, path, text)
        assert files.read_text(spark, path) == text
    files.delete(spark, path)
    assert not files.exists(spark, path)
