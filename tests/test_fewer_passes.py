"""Each step of a fold reads and sends a row once, where it took it twice."""

from __future__ import annotations

from conftest import random_readings, reading

from gaugeflow.operators import activity, cleaning, dedupe, timeline
from gaugeflow.session import fresh_dir
from gaugeflow.sources.store import StationStore
from gaugeflow.workload import queries, stations

SMALLEST = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rolling_mean_sends_no_leaving_rows(facts):
    rolled = timeline.rolling_utilization(facts(random_readings(60, 3, 5)))
    sent = _plan(rolled).partition("Exchange hashpartitioning")[2]
    assert sent and "_sign" not in sent


def test_a_long_window_beside_short_ones(facts):
    dense = [reading("1", n / 2, n % 9, 9 - n % 9) for n in range(80)]
    sparse = [reading("2", 7 * n, n % 5, 5) for n in range(12)]
    both = timeline.rolling_utilization(facts(dense + sparse)).collect()
    for row in both:
        window = [
            other.utilization_rate
            for other in both
            if other.station_key == row.station_key
            and 0 <= (row.snapshot_timestamp - other.snapshot_timestamp).total_seconds() <= 900
        ]
        assert abs(row.rolling_15m_utilization - sum(window) / len(window)) < 1e-12


def test_folded_activity_joins_the_history_once(facts):
    history = facts(random_readings(300, 8, 5)).cache()
    known, fresh = (history.filter(f"minute(snapshot_timestamp) % 2 = {n}") for n in (0, 1))
    folded = activity.fold_activity(
        activity.hourly_activity(known), fresh, timeline.latest_status(known), known,
        activity.station_days(known),
    )
    hours = [line for line in _plan(folded).splitlines() if "Window" in line and "_hour" in line]
    assert len([line for line in hours if "lag(" in line]) == 2
    expected = {tuple(row) for row in activity.hourly_activity(history).collect()}
    assert {tuple(row) for row in folded.collect()} == expected


def test_the_first_batch_meets_no_stored_rows(spark, facts, monkeypatch):
    store = StationStore(spark, fresh_dir(spark, "first"))
    joined = []
    from gaugeflow.sources import store as module

    absent = module.absent_rows
    monkeypatch.setattr(module, "absent_rows", lambda *a: joined.append(1) or absent(*a))
    for number in range(2):
        rows = [reading("1", minute, 3, 3) for minute in range(number + 1)]
        store.append_facts(facts(rows), "run", number)
        assert len(joined) == number
    assert store.facts().count() == 2


def test_both_halves_come_from_one_pass_over_the_arrivals(spark):
    arrivals = queries._arrivals_by_half(spark, SMALLEST).persist()
    try:
        halves = queries._halves(arrivals)
        assert all("FileScan" not in _plan(half).partition("InMemoryRelation")[0] for half in halves)
        assert all("InMemoryTableScan" in _plan(half) for half in halves)
        raw = stations.raw_snapshots(spark, SMALLEST)
        cleaned = cleaning.clean_snapshots(raw, queries.PARAMS, keep=["arrival_id"])
        second = stations.arrived_late_half(spark, SMALLEST)
        for half, part in zip(halves, (~second, second), strict=True):
            alone = dedupe.first_per_key(cleaned.filter(part), dedupe.FACT_KEY, "arrival_id")
            assert sorted(map(tuple, half.collect())) == sorted(
                map(tuple, alone.select(*half.columns).collect())
            )
    finally:
        arrivals.unpersist()
