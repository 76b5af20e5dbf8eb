"""Refresh of all gold tables: in full from the facts, or by folding one batch in."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.timestamps import seconds_before
from gaugeflow.operators.activity import (
    daily_usage_peaks,
    fold_activity,
    fold_station_days,
    hourly_activity,
    late_stations,
    station_days,
)
from gaugeflow.operators.alerts import (
    alert_transitions,
    changed_dates,
    critical_stations,
    current_alerts,
    fold_critical,
    new_transitions,
    stamp,
    transitions_anew,
)
from gaugeflow.operators.ranking import UTILIZATION_ORDER, dense_rank_global
from gaugeflow.operators.timeline import fold_latest, fold_recent, latest_status
from gaugeflow.operators.upsert import restrict_to_spans
from gaugeflow.operators.zones import geographic_imbalance, low_availability_zones
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.schema import conform
from gaugeflow.sources.store import INTERNAL, PUBLISHED, Dates, StationStore


def together(spark: SparkSession, *tasks: Callable[[], Any]) -> list[Any]:
    """Run independent Spark jobs side by side: most are small and leave executors idle."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [future.result() for future in futures]


def recent_history(latest: DataFrame, facts: DataFrame, params: Params) -> DataFrame:
    """Facts of the dates, and the times on them, that these rows' rolling windows cover."""
    until = F.col("snapshot_timestamp")
    windows = latest.select(
        seconds_before(until, params.rolling_window_seconds).alias("since"), until.alias("until")
    ).withColumn("event_date", F.explode(F.sequence(F.to_date("since"), F.to_date("until"))))
    midnight = F.col("event_date").cast("timestamp")
    next_midnight = F.date_add("event_date", 1).cast("timestamp")
    covered = windows.select(
        "event_date",
        F.explode(
            F.array(F.greatest("since", midnight), F.least("until", next_midnight))
        ).alias("snapshot_timestamp"),
    )
    return restrict_to_spans(facts, covered, "event_date", "snapshot_timestamp")


class _Version:
    """The tables of a version that is being written, each read back from its files.

    So later tables neither recompute earlier ones nor depend on executors that held them.
    """

    def __init__(self, store: StationStore) -> None:
        self.store = store
        self.path = store.new_version()

    def write(self, table: str, df: DataFrame) -> DataFrame:
        schema = (PUBLISHED | INTERNAL)[table]
        return self.store.write_version(self.path, table, conform(df, schema))

    def derive(
        self,
        latest: DataFrame,
        activity: DataFrame,
        critical: Callable[[], DataFrame],
        params: Params,
    ) -> DataFrame:
        """Writes what follows from the latest rows and the activity; returns the critical ones."""

        def rank() -> DataFrame:
            keys = f"{self.path}/ranked_keys"
            return dense_rank_global(latest, UTILIZATION_ORDER, "utilization_rank", scratch=keys)

        return together(
            self.store.spark,
            lambda: self.write("critical_stations", critical()),
            lambda: self.write("top_utilization_stations", rank()),
            lambda: self.write("daily_usage_peaks", daily_usage_peaks(activity)),
            lambda: self.write(
                "low_availability_zones", low_availability_zones(latest, params)
            ),
            lambda: self.write("geographic_imbalance", geographic_imbalance(latest)),
        )[0]


def _dates(facts: DataFrame) -> list[str]:
    """The dates of these facts as ISO text; they come to the driver, one short row each."""
    return [d.isoformat() for (d,) in facts.select("event_date").distinct().collect() if d]


def refresh_all(
    store: StationStore,
    run_id: str,
    batch_id: int,
    params: Params = DEFAULTS,
    created_at: Column | None = None,
) -> None:
    """Rebuild and publish all tables from the whole fact history, then log current alerts."""
    facts = store.facts()
    version = _Version(store)
    latest, activity, *dates = together(
        store.spark,
        lambda: version.write("latest_station_status", latest_status(facts)),
        lambda: version.write("hourly_activity", hourly_activity(facts)),
        lambda: store.write_dates("station_days", station_days(facts), None),
        lambda: store.write_dates("transitions", _dated(alert_transitions(facts, params)), None),
    )
    near = recent_history(latest, facts, params)
    none = store.spark.createDataFrame([], INTERNAL["recent_readings"])
    recent = version.write("recent_readings", fold_recent(none, near, latest, params))
    critical = version.derive(
        latest, activity, lambda: critical_stations(latest, recent, params), params
    )
    _log_alerts(store, latest, critical, run_id, batch_id, created_at)
    store.publish(version.path, run_id, batch_id, None, True, None, dates)


def refresh_batch(
    store: StationStore,
    batch: DataFrame,
    run_id: str,
    batch_id: int,
    params: Params = DEFAULTS,
    created_at: Column | None = None,
) -> None:
    """Archive and store one batch, fold it into the published tables, log current alerts.

    The work follows the batch, the number of stations and the facts of the dates that the batch
    touches; older dates are not opened. Only if the batch holds facts older than a station's latest
    row, the facts of these dates and the edges of the station's other dates are read. A batch that
    the published tables hold already changes nothing. Batches that were stored and never published,
    by this run or another, are folded in one by one before this one, and log their alerts.

    ``batch`` itself is read once, for the archive; all later steps read the archived rows. So a
    stream's stateful operator runs once per micro-batch, and losing an executor later does not
    bring it back. If another writer publishes meanwhile, the batch is folded into its version.

    A batch without rows, as a stream has one after each landing to drop old state, writes no table.
    """
    if store.holds(run_id, batch_id):
        return
    archived = store.append_archive(batch, run_id, batch_id)
    if store.current() and not store.has_archived(run_id, batch_id) and not store.pending():
        store.hold(run_id, batch_id)
        return
    store.append_facts(archived, run_id, batch_id)
    touched = set()
    while pending := store.pending():
        # Whatever was cut short comes first; this batch is the last.
        first = min(pending, key=lambda one: (one == (run_id, batch_id), one))
        base = store.current()
        try:
            touched.update(_fold(store, base, first, pending, params, created_at))
        except Exception:
            # Another writer's version came first; it also removes the folder of this one.
            if store.current() == base:
                raise
            continue
        if first == (run_id, batch_id):
            break
    for table in ("facts", "archive", "alerts", "transitions"):
        store.compact(table, touched)


def _fold(
    store: StationStore,
    base: str | None,
    batch: tuple[str, int],
    pending: list[tuple[str, int]],
    params: Params,
    created_at: Column | None,
) -> list[str]:
    """Publishes the current version with one more batch; returns the dates of its facts."""
    fresh = store.facts_of([batch])
    dates = _dates(fresh)
    known = store.gold("latest_station_status")
    near = store.gold("recent_readings")
    late = late_stations(fresh, known)
    some_late = not late.isEmpty()
    others = [one for one in pending if one != batch]
    history = days = None
    if some_late:
        history, days = store.facts_without(*pending, days=dates), store.station_days()
    version = _Version(store)

    def transitions() -> Dates:
        if some_late:
            return _changed_transitions(store, near, fresh, late, others, params)
        return store.write_dates("transitions", _dated(new_transitions(near, fresh, late, params)))

    latest, activity, *brought = together(
        store.spark,
        lambda: version.write("latest_station_status", fold_latest(known, fresh)),
        lambda: version.write(
            "hourly_activity",
            fold_activity(store.gold("hourly_activity"), fresh, known, history, days),
        ),
        lambda: store.write_dates(
            "station_days", fold_station_days(store.station_days(dates), fresh), dates
        ),
        transitions,
    )
    recent = version.write(
        "recent_readings", fold_recent(near, fresh, latest, params)
    )
    stations = fresh.select("station_key").distinct().hint("merge")
    old = store.gold("critical_stations")
    critical = version.derive(
        latest, activity, lambda: fold_critical(old, latest, recent, stations, params), params
    )
    # The alerts of stations without a new fact are in the log already.
    changed = [df.join(stations, "station_key", "left_semi") for df in (latest, critical)]
    _log_alerts(store, *changed, *batch, created_at)
    store.publish(version.path, *batch, [batch], False, base, brought)
    return dates


def _changed_transitions(
    store: StationStore,
    recent: DataFrame,
    fresh: DataFrame,
    late: DataFrame,
    others: list[tuple[str, int]],
    params: Params,
) -> Dates:
    """The transitions of a batch with late facts, with those that they change on their dates."""
    touched = fresh.select("station_key", "event_date").distinct()
    known = store.station_days().select(*touched.columns)
    changed = changed_dates(known.unionByName(touched).distinct(), fresh, late)
    # A row per station and date around the late facts.
    changed = changed.persist()
    try:
        facts = store.facts_without(*others, days=_dates(changed))
        anew = _dated(transitions_anew(facts, changed, params))
        marked = changed.filter("_anew").withColumnRenamed("event_date", "alert_date")
        instead = [d.isoformat() for (d,) in marked.select("alert_date").distinct().collect()]
        keys = marked.select("station_key", "alert_date").hint("merge")
        kept = store.transitions(instead).join(keys, keys.columns, "left_anti")
        rows = kept.select(*anew.columns).unionByName(anew)
        rows = rows.unionByName(_dated(new_transitions(recent, fresh, late, params)))
        return store.write_dates("transitions", rows, instead)
    finally:
        changed.unpersist()


def _dated(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("alert_date", F.to_date("snapshot_timestamp"))


def _log_alerts(
    store: StationStore,
    latest: DataFrame,
    critical: DataFrame,
    run_id: str,
    batch_id: int,
    created_at: Column | None,
) -> None:
    alerts = stamp(
        current_alerts(latest, critical),
        F.current_timestamp() if created_at is None else created_at,
    )
    store.append_alerts(alerts, run_id, batch_id)
