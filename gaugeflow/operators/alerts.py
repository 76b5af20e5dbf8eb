"""Critical stations and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.operators.timeline import (
    bucketed_rolling_avg,
    flag_rises,
    rolling_at_latest,
    rolling_utilization,
)
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.schema import GOLD

# Alert types, levels and message endings.
EMPTY = "empty"
CRITICAL = "critical"
EMPTY_AND_CRITICAL = "empty-and-critical"
MESSAGES = {EMPTY: " is empty", CRITICAL: " is critically constrained"}

_ALERT_COLUMNS = [name for name in GOLD["station_alerts"].names if name != "created_at"]


def is_empty() -> Column:
    return F.col("bikes_available") == 0


def is_critical(params: Params) -> Column:
    return (F.col("bikes_available") <= params.critical_bikes_threshold) & (
        F.col("rolling_15m_utilization") >= params.critical_utilization_threshold
    )


def as_alerts(df: DataFrame, kind: Column, keep: Sequence[str] = ()) -> DataFrame:
    message = F.concat("station_name", _ending(kind))
    return df.withColumns({"alert_type": kind, "alert_message": message}).select(
        *_ALERT_COLUMNS, *keep
    )


def _ending(kind: Column) -> Column:
    return F.when(kind == EMPTY, MESSAGES[EMPTY]).otherwise(MESSAGES[CRITICAL])


def critical_stations(
    latest: DataFrame, facts: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Stations with few bikes now and high mean fullness over the window that just ended.

    The test on the current row runs first, so only those stations look into the history.
    """
    scarce = latest.filter(F.col("bikes_available") <= params.critical_bikes_threshold)
    return (
        rolling_at_latest(scarce, facts, params)
        .filter(is_critical(params))
        .withColumn("is_empty", is_empty())
        .withColumn(
            "alert_level", F.when(is_empty(), EMPTY_AND_CRITICAL).otherwise(CRITICAL)
        )
        .select(*GOLD["critical_stations"].names)
    )


def fold_critical(
    critical: DataFrame,
    latest: DataFrame,
    recent: DataFrame,
    touched: DataFrame,
    params: Params = DEFAULTS,
) -> DataFrame:
    """Critical stations after more facts: those of the ``touched`` stations (station_key) anew
    from their ``recent`` readings, the others as they were."""
    touched = touched.hint("merge")
    kept = critical.join(touched, "station_key", "left_anti")
    anew = latest.join(touched, "station_key", "left_semi")
    return kept.unionByName(critical_stations(anew, recent, params).select(*kept.columns))


def empty_alerts(latest: DataFrame) -> DataFrame:
    return as_alerts(latest.filter(is_empty()), F.lit(EMPTY))


def critical_alerts(critical: DataFrame) -> DataFrame:
    return as_alerts(critical, F.lit(CRITICAL))


def current_alerts(latest: DataFrame, critical: DataFrame) -> DataFrame:
    return empty_alerts(latest).unionByName(critical_alerts(critical))


def alert_history(
    facts: DataFrame, params: Params = DEFAULTS, keep: Sequence[str] = ()
) -> DataFrame:
    """Alerts of every snapshot, as if each had been the newest one; one pass over the facts.

    ``keep`` names further fact columns to carry through.
    """
    kinds = F.array_compact(
        F.array(
            F.when(is_empty(), EMPTY), F.when(is_critical(params), CRITICAL)
        )
    )
    flagged = rolling_utilization(facts, params).withColumn("_kind", F.explode(kinds))
    return as_alerts(flagged, F.col("_kind"), keep)


def alert_transitions(
    facts: DataFrame, params: Params = DEFAULTS, keep: Sequence[str] = ()
) -> DataFrame:
    """Snapshots at which a station becomes empty or critical, not those at which it stays so.

    ``keep`` names further fact columns to carry through.
    """
    states = {EMPTY: "_empty", CRITICAL: "_critical"}
    flagged = bucketed_rolling_avg(
        facts,
        "station_key",
        "snapshot_timestamp",
        "utilization_rate",
        "rolling_15m_utilization",
        params.rolling_window_seconds,
        params.rolling_bucket_seconds,
    ).withColumns({"_empty": is_empty(), "_critical": is_critical(params)})
    rises = flag_rises(flagged, "station_key", list(states.values()))
    entered = F.array_compact(
        F.array(*[F.when(F.col(f"rises_{flag}"), kind) for kind, flag in states.items()])
    )
    return as_alerts(rises.withColumn("_kind", F.explode(entered)), F.col("_kind"), keep)


def new_transitions(
    recent: DataFrame, new_facts: DataFrame, late: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Transitions at the new facts of the stations that are not ``late`` (station_key).

    The ``recent`` readings end at the station's latest row, so they hold the window and the flags
    of the row before the first new one, and the windows of the new ones.
    """
    in_order = new_facts.join(late.hint("merge"), "station_key", "left_anti")
    stations = in_order.select("station_key").distinct().hint("merge")
    before = recent.join(stations, "station_key", "left_semi")
    rows = in_order.withColumn("_new", F.lit(True)).unionByName(
        before.withColumn("_new", F.lit(False)), allowMissingColumns=True
    )
    return alert_transitions(rows, params, keep=["_new"]).filter("_new").drop("_new")


def changed_dates(days: DataFrame, new_facts: DataFrame, late: DataFrame) -> DataFrame:
    """Dates of late stations that decide their transitions anew: station_key, event_date, _anew.

    ``days`` are the station days with the new facts. A late fact changes the windows of a quarter
    of an hour, so the rows of its date and perhaps of the next, and the flags that the row after
    them is compared with: ``_anew`` marks its date and the two that follow it for the station.
    The others are only read: the station's date before each marked one, and the calendar date
    before each of these, whose last windows reach into them.
    """
    key = ["station_key", "event_date"]
    touched = new_facts.select(*key).distinct().withColumn("_touched", F.lit(True))
    known = days.join(late.hint("merge"), "station_key").select(*key)
    timeline = known.join(touched.hint("merge"), key, "left")
    in_order = Window.partitionBy("station_key").orderBy("event_date")
    near = [F.col("_touched")] + [F.lag("_touched", k).over(in_order) for k in (1, 2)]
    marked = timeline.withColumn("_anew", F.coalesce(*near, F.lit(False)))
    leads = F.coalesce(F.lead("_anew").over(in_order), F.lit(False))
    read = marked.withColumn("_leads", leads).filter("_anew OR _leads").select(*key, "_anew")
    eve = read.select("station_key", F.date_sub("event_date", 1).alias("event_date"))
    both = read.unionByName(eve.withColumn("_anew", F.lit(False)))
    return both.groupBy(*key).agg(F.max("_anew").alias("_anew"))


def transitions_anew(
    facts: DataFrame, dates: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Transitions of the marked ``changed_dates``, from the facts of all of them."""
    rows = facts.join(dates.hint("merge"), ["station_key", "event_date"])
    return alert_transitions(rows, params, keep=["_anew"]).filter("_anew").drop("_anew")


def stamp(alerts: DataFrame, created_at: Column) -> DataFrame:
    return alerts.withColumn("created_at", created_at.cast("timestamp"))

