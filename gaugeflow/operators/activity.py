"""Hourly usage estimated from successive gauge readings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.timestamps import time_bucket
from gaugeflow.operators.timeline import previous_per_key
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.schema import STATION_DAYS

_GAUGES = ("bikes_available", "free_slots")
_HOUR = ("city", "usage_date", "usage_hour")


def _movement(now: dict[str, Column], before: dict[str, Column]) -> Column:
    """The larger change of the two gauges; nothing when there is no earlier reading."""
    changes = [F.abs(now[name] - F.coalesce(before[name], now[name])) for name in _GAUGES]
    return F.greatest(*changes).cast("double")


def usage_deltas(facts: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Per snapshot, the movement since the station's preceding snapshot."""
    moved = previous_per_key(
        facts, "station_key", "snapshot_timestamp", _GAUGES, params.lag_bucket_seconds
    )
    return moved.select(
        *facts.columns,
        _movement(
            {name: F.col(name) for name in _GAUGES},
            {name: F.col(f"prev_{name}") for name in _GAUGES},
        ).alias("usage_proxy"),
    )


def hourly_activity(facts: DataFrame) -> DataFrame:
    """Movement summed by city, date and hour.

    Each station hour is reduced to its inner movement plus its opening and closing reading; the
    movement across the hour edge is then found on those summaries. The history is shuffled once,
    by (station, hour), so no station forms one large group.
    """
    return _hourly(facts, {"true": 1})


def _hourly(facts: DataFrame, signs: dict[str, int]) -> DataFrame:
    """Movement by city, date and hour, summed with a sign over several timelines of the stations.

    ``signs`` has for each timeline the condition of the rows that belong to it.
    """
    readings = f"struct({', '.join(_GAUGES)})"
    in_hour = "IGNORE NULLS OVER (PARTITION BY station_key, _hour ORDER BY snapshot_timestamp)"
    timelines = list(enumerate(signs.items()))
    neighbours, summaries, carried, edges = {}, [], {}, []
    for n, (belongs, sign) in timelines:
        neighbours[f"_earlier_{n}"] = F.expr(f"lag(IF({belongs}, {readings}, NULL)) {in_hour}")
        neighbours[f"_later_{n}"] = F.expr(f"lead(IF({belongs}, 1, NULL)) {in_hour}")
        earlier, own = F.col(f"_earlier_{n}"), F.expr(belongs)
        opens, closes = own & earlier.isNull(), own & F.col(f"_later_{n}").isNull()
        moved = _movement(
            {name: F.col(name) for name in _GAUGES}, {name: earlier[name] for name in _GAUGES}
        )
        summaries += [
            F.sum(F.when(own, moved)).alias(f"_inner_{n}"),
            *[F.max(F.when(opens, F.col(name))).alias(f"_opening_{n}_{name}") for name in _GAUGES],
            *[F.max(F.when(closes, F.col(name))).alias(f"_closing_{n}_{name}") for name in _GAUGES],
            F.bool_or(closes).alias(f"_closes_{n}"),
        ]
        past_hours = (
            Window.partitionBy("station_key")
            .orderBy("_hour")
            .rangeBetween(Window.unboundedPreceding, -1)
        )
        closing = F.struct(*[F.col(f"_closing_{n}_{name}").alias(name) for name in _GAUGES])
        closing = F.when(F.col(f"_closes_{n}"), closing)
        carried[f"_carried_{n}"] = F.last(closing, ignorenulls=True).over(past_hours)
        edge = _movement(
            {name: F.col(f"_opening_{n}_{name}") for name in _GAUGES},
            {name: F.col(f"_carried_{n}")[name] for name in _GAUGES},
        )
        parts = [F.coalesce(part, F.lit(0.0)) for part in (F.col(f"_inner_{n}"), edge)]
        edges.append(F.lit(sign) * reduce(Column.__add__, parts))
    rows = facts.withColumn("_hour", time_bucket(F.col("snapshot_timestamp"), 3600)).withColumns(
        {"usage_date": F.col("event_date"), "usage_hour": F.col("event_hour")}
    )
    return (
        rows.withColumns(neighbours)
        .groupBy("station_key", "_hour", *_HOUR)
        .agg(*summaries)
        .withColumns(carried)
        .withColumn("_moved", reduce(Column.__add__, edges))
        .groupBy(*_HOUR)
        .agg(F.sum("_moved").alias("estimated_activity"))
    )


def daily_usage_peaks(activity: DataFrame) -> DataFrame:
    """Hours ranked inside each city and day; a group never exceeds 24 rows."""
    busiest = Window.partitionBy("city", "usage_date").orderBy(
        F.desc("estimated_activity"), "usage_hour"
    )
    return activity.withColumn("peak_rank", F.dense_rank().over(busiest))


_EDGE = STATION_DAYS["first_reading"].dataType.names


def station_days(facts: DataFrame) -> DataFrame:
    """First and last reading of each station and date."""
    reading, at = F.struct(*_EDGE), "snapshot_timestamp"
    return facts.groupBy("station_key", "event_date").agg(
        F.min_by(reading, at).alias("first_reading"), F.max_by(reading, at).alias("last_reading")
    )


def fold_station_days(days: DataFrame, new_facts: DataFrame) -> DataFrame:
    """The station days of the dates in ``days`` after more facts on these dates."""
    both = days.unionByName(station_days(new_facts))
    return both.groupBy("station_key", "event_date").agg(
        F.min_by("first_reading", F.col("first_reading.snapshot_timestamp")).alias("first_reading"),
        F.max_by("last_reading", F.col("last_reading.snapshot_timestamp")).alias("last_reading"),
    )


def fold_activity(
    activity: DataFrame,
    new_facts: DataFrame,
    latest: DataFrame,
    history: DataFrame | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """Hourly activity after more facts, from the rows they touch only.

    A new fact changes its own movement and that of the snapshot after it. Around the new facts of
    a station, the movement of its known rows is taken off, and that of the known and new rows
    together is added; rows that the new facts do not come between cancel out.

    For a station whose new facts all follow its ``latest`` row that row is all it takes. Stations
    with older facts read ``history``, cut to those stations; pass None only when there are none,
    see ``has_late_facts``. With ``days``, the ``station_days`` of the known facts, ``history`` need
    hold no other dates than those of the late stations' new facts: the rows before and after a
    date are the edges of the dates next to it.
    """
    columns = _EDGE
    fresh = new_facts.select(*columns)
    spans = _spans(fresh, latest)
    before = (
        latest.join(spans.filter(~F.col("_late")).hint("merge"), "station_key", "left_semi")
        .select(*columns)
    )
    if history is not None:
        late = spans.filter("_late")
        if days is None:
            around = _between(history.select(*columns), late)
        else:
            around = _touched_dates(history.select(*columns), fresh, days, late)
        before = before.unionByName(around)
    known, new = (df.withColumn("_known", F.lit(b)) for df, b in ((before, True), (fresh, False)))
    change = _hourly(known.unionByName(new), {"true": 1, "_known": -1})
    return (
        activity.unionByName(change)
        .groupBy(*_HOUR)
        .agg(F.sum("estimated_activity").alias("estimated_activity"))
    )


def _between(history: DataFrame, late: DataFrame) -> DataFrame:
    """Of each late station, the rows from the one before its first new fact to the one after its
    last."""
    touched = history.join(late.hint("merge"), "station_key")
    at, row = F.col("snapshot_timestamp"), F.struct(*history.columns)
    inside = touched.filter(at.between(F.col("_first"), F.col("_last"))).select(*history.columns)
    edges = (
        touched.groupBy("station_key")
        .agg(
            F.max_by(row, F.when(at < F.col("_first"), at)).alias("_before"),
            F.min_by(row, F.when(at > F.col("_last"), at)).alias("_after"),
        )
        .select(F.explode(F.array("_before", "_after")).alias("_edge"))
        .filter(F.col("_edge").isNotNull())
        .select("_edge.*")
    )
    return inside.unionByName(edges)


def _touched_dates(
    history: DataFrame, fresh: DataFrame, days: DataFrame, late: DataFrame
) -> DataFrame:
    """Of each late station, the rows of the dates of its new facts, and the nearest reading on
    either side of each such date."""
    key = ["station_key", "event_date"]
    stations = late.select("station_key").hint("merge")
    touched = fresh.select(*key).distinct().join(stations, "station_key")
    whole = history.join(touched.hint("merge"), key, "left_semi")
    known = days.join(stations, "station_key")
    timeline = known.join(touched.withColumn("_touched", F.lit(True)), key, "full_outer")
    in_order = Window.partitionBy("station_key").orderBy("event_date")
    follows = F.lag("_touched").over(in_order).alias("_follows")
    leads = F.lead("_touched").over(in_order).alias("_leads")
    # One row per station and date meets here, none of the dates that have none.
    near = timeline.select("*", follows, leads).filter("_touched IS NULL")
    edges = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(F.col("_follows"), F.col("first_reading")),
                F.when(F.col("_leads"), F.col("last_reading")),
            )
        )
    )
    return whole.unionByName(near.select(F.explode(edges).alias("_edge")).select("_edge.*"))


def _spans(fresh: DataFrame, latest: DataFrame) -> DataFrame:
    """Per touched station, the first and last new time and whether any precedes its latest."""
    known = latest.select("station_key", F.col("snapshot_timestamp").alias("_known"))
    return (
        fresh.groupBy("station_key")
        .agg(
            F.min("snapshot_timestamp").alias("_first"),
            F.max("snapshot_timestamp").alias("_last"),
        )
        .join(known.hint("merge"), "station_key", "left")
        .withColumn("_late", F.coalesce(F.col("_first") < F.col("_known"), F.lit(False)))
    )


def late_stations(new_facts: DataFrame, latest: DataFrame) -> DataFrame:
    """The stations (station_key) that got a fact older than their latest row."""
    return _spans(new_facts, latest).filter("_late").select("station_key")


def has_late_facts(new_facts: DataFrame, latest: DataFrame) -> bool:
    """Whether some station got a fact older than its latest row (runs a job, one row back)."""
    return not late_stations(new_facts, latest).isEmpty()
