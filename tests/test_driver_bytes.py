"""Joins whose sides grow with the stations or the facts send neither through the driver."""

from __future__ import annotations

import pytest
from conftest import random_readings

from gaugeflow.operators import activity, alerts, ranking, timeline
from gaugeflow.operators.upsert import absent_rows


@pytest.fixture
def joined(spark, facts):
    history = facts(random_readings(300, 8, 5)).cache()
    known, fresh = (history.filter(f"minute(snapshot_timestamp) % 2 = {n}") for n in (0, 1))
    latest, days = timeline.latest_status(known), activity.station_days(known)
    late = activity.late_stations(fresh, latest)
    critical = alerts.critical_stations(latest, known)
    stations = fresh.select("station_key").distinct()
    dates = alerts.changed_dates(days, fresh, late)
    return {
        "absent": absent_rows(fresh, known, ["station_key", "snapshot_timestamp"]),
        "activity": activity.fold_activity(
            activity.hourly_activity(known), fresh, latest, known, days
        ),
        "whole activity": activity.fold_activity(
            activity.hourly_activity(known), fresh, latest, known
        ),
        "recent": timeline.fold_recent(known, fresh, latest),
        "critical": alerts.fold_critical(critical, latest, known, stations),
        "transitions": alerts.new_transitions(known, fresh, late),
        "dates": dates,
        "anew": alerts.transitions_anew(known, dates),
        "rank": ranking.top_utilization(latest, 5),
    }


def test_no_broadcast(joined):
    plans = {
        name: df._jdf.queryExecution().executedPlan().toString() for name, df in joined.items()
    }
    assert [name for name, plan in plans.items() if "Broadcast" in plan] == []
