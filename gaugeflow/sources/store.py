"""Fact history, archive, alert log and published gold tables as Parquet folders.

Rows are appended in parts. The state of the store (`CommitLog`) lists the parts of each date, so a
reader opens the parts of the dates it needs and lists nothing else; a part that no state names was
cut short and is never read. A batch that is appended again replaces its own parts. Parts of
published batches are merged by size classes, so a date has a few dozen at most and, once it is
past, a few large ones.

A batch is pending from the commit of its facts until a published version holds it. What is pending
when the next batch comes was cut short and is folded in first, whoever runs it. Every version lists
the batches that it holds. Several jobs may write to one store: a commit that was based on a state
that another has changed is made anew.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.operators.upsert import absent_rows, day_spans, within_spans
from gaugeflow.schema import (
    ALERT_KEY,
    FACT,
    FACT_KEY,
    GOLD,
    LATE_ROWS,
    RECENT_READINGS,
    REJECTED,
    STATION_DAYS,
    TRANSITIONS,
)
from gaugeflow.sources import files
from gaugeflow.sources.commits import CommitLog, Conflict

_RUN = T.StructField("run_id", T.StringType(), True)
_BATCH = T.StructField("batch_id", T.LongType(), True)
_ALERT_DATE = T.StructField("alert_date", T.DateType(), True)

ACTIVITY = T.StructType(GOLD["daily_usage_peaks"].fields[:-1])
PUBLISHED = {
    **{name: schema for name, schema in GOLD.items() if name != "station_alerts"},
    "hourly_activity": ACTIVITY,
}
#: Batches of a run whose newest event time is kept.
_BATCHES_KEPT = 20
#: Tables of a version that only later folds read.
INTERNAL = {"recent_readings": RECENT_READINGS}


@dataclass(frozen=True)
class Appended:
    """A table that grows by parts: its columns, its date, and folders inside a part."""

    schema: T.StructType
    day: str
    inner: tuple[str, ...] = ()


APPENDED = {
    "facts": Appended(T.StructType([*FACT.fields, _RUN]), "event_date"),
    "archive": Appended(T.StructType([*FACT.fields, _RUN]), "event_date", ("city",)),
    "alerts": Appended(
        T.StructType([*GOLD["station_alerts"].fields, _ALERT_DATE, _RUN, _BATCH]), "alert_date"
    ),
    "late_rows": Appended(T.StructType([*LATE_ROWS.fields, _RUN, _BATCH]), "event_date"),
    "rejected": Appended(T.StructType([*REJECTED.fields, _RUN, _BATCH]), "rejected_on"),
    "station_days": Appended(STATION_DAYS, "event_date"),
    "transitions": Appended(TRANSITIONS, "alert_date"),
}


@dataclass(frozen=True)
class Dates:
    """Parts of a table that a version brings: of these dates, beside or in place of what is there."""

    table: str
    parts: dict[str, str]
    #: Dates whose other parts go; None for those of all dates.
    instead: frozenset[str] | None = frozenset()


class StationStore:
    """Tables under one root folder. Run ids may hold letters, digits, dots, dashes, underscores."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keep_versions: int = 5,
        merge_at: int = 8,
        retain_seconds: int = 3600,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = keep_versions
        #: So many parts of one size class and date become one of the next class.
        self.merge_at = merge_at
        #: Replaced parts stay so long, for readers of an earlier state.
        self.retain_seconds = retain_seconds
        self._log = CommitLog(spark, f"{self.root}/commits")

    def _state(self) -> dict:
        return self._log.read()[1]

    # -- parts ----------------------------------------------------------------------------

    @staticmethod
    def _entries(state: dict, table: str, days: Iterable[str] | None) -> list[tuple[str, dict]]:
        by_day = state.get("parts", {}).get(table, {})
        wanted = by_day if days is None else sorted(set(days))
        return [(day, entry) for day in wanted for entry in by_day.get(day, ())]

    def _folder(self, table: str, day: str, part: str) -> str:
        return f"{self.root}/{table}/part={part}/{APPENDED[table].day}={day}"

    def _read_parts(self, table: str, parts: list[tuple[str, str]]) -> DataFrame:
        """Rows of these (day, part)."""
        schema = APPENDED[table].schema
        if not parts:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        paths = [self._folder(table, day, part) for day, part in parts]
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        return rows.select(*schema.names)

    def _rows(self, table: str, state: dict, days: Iterable[str] | None = None) -> DataFrame:
        entries = self._entries(state, table, days)
        return self._read_parts(table, [(day, entry["part"]) for day, entry in entries])

    def _write_part(self, table: str, df: DataFrame) -> tuple[str, list[str]]:
        """Writes the rows of ``df`` as a new part and returns it with the dates that it has.

        Rows are rebalanced by the partition columns: small partitions end up in one file each and
        a large one is split over several tasks at run time.
        """
        part, kind = uuid.uuid4().hex, APPENDED[table]
        columns = [kind.day, *kind.inner]
        # A folder of its own, so that writers do not meet in one output folder.
        (
            df.select(*kind.schema.names)
            .hint("rebalance", *columns)
            .write.partitionBy(*columns)
            .parquet(f"{self.root}/{table}/part={part}")
        )
        folders = files.names(self.spark, f"{self.root}/{table}/part={part}")
        return part, sorted(n.partition("=")[2] for n in folders if n.startswith(f"{kind.day}="))

    def _drop_part(self, table: str, part: str, days: Iterable[str]) -> None:
        for day in days:
            files.delete(self.spark, self._folder(table, day, part))
        folder = f"{self.root}/{table}/part={part}"
        if not any("=" in name for name in files.names(self.spark, folder)):
            files.delete(self.spark, folder)

    def _append(
        self,
        table: str,
        run_id: str,
        batch_id: int,
        days: list[str],
        rows: Callable[[DataFrame | None], DataFrame],
        alone: bool = False,
        pending: bool = False,
    ) -> None:
        """Stores what ``rows`` makes of the table's other rows on these dates (None: there are none).

        alone: the rows do not depend on the others, so these are not read.
        """
        own = [run_id, batch_id]

        def others(state: dict) -> list[tuple[str, str]]:
            entries = self._entries(state, table, days)
            return [(day, entry["part"]) for day, entry in entries if entry["by"] != own]

        def write() -> bool:
            known = [] if alone else others(self._state())
            fresh = rows(self._read_parts(table, known) if known else None)
            fresh = fresh.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id)})
            part, found = self._write_part(table, fresh)

            def change(state: dict) -> dict:
                if not alone and others(state) != known:
                    raise Conflict
                _replace(state, table, own, {day: part for day in found})
                if pending:
                    state.setdefault("pending", {})[_batch_key(run_id, batch_id)] = found
                return state

            try:
                self._log.commit(change)
            except Conflict:
                self._drop_part(table, part, found)
                return False
            return True

        while not write():
            pass

    def _own_rows(
        self, table: str, run_id: str, batch_id: int, days: Iterable[str] | None = None
    ) -> DataFrame:
        """Stored rows of one batch, from its own parts or, once these are merged, by column."""
        state = self._state()
        entries = self._entries(state, table, days)
        own = [(d, e["part"]) for d, e in entries if e["by"] == [run_id, batch_id]]
        if own:
            return self._read_parts(table, own)
        if not self._held(state, run_id, batch_id):
            return self._read_parts(table, [])
        return self._rows(table, state, days).filter(self._own(run_id, batch_id))

    @staticmethod
    def _own(run_id: str, batch_id: int) -> Column:
        return (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)

    def compact(self, table: str, days: Iterable[str] | None = None) -> int:
        """Merges small parts of these dates; returns how many parts went into larger ones.

        Parts of a batch that is still pending stay as they are. Merged parts leave the state at
        once and their folders later (``retain_seconds``).
        """
        merged = 0
        state = self._state()
        busy = [list(_batch_of(key)) for key in state.get("pending", {})]
        for day in sorted(set(day for day, _ in self._entries(state, table, days))):
            classes: dict[int, list[str]] = {}
            for _, entry in self._entries(state, table, [day]):
                if entry["by"] not in busy:
                    classes.setdefault(entry["class"], []).append(entry["part"])
            for size, parts in sorted(classes.items()):
                if len(parts) >= self.merge_at:
                    merged += self._merge(table, day, size, parts)
        return merged

    def _merge(self, table: str, day: str, size: int, parts: list[str]) -> int:
        rows = self._read_parts(table, [(day, part) for part in parts])
        new, found = self._write_part(table, rows)

        def change(state: dict) -> dict:
            entries = state["parts"][table][day]
            if not set(parts) <= {entry["part"] for entry in entries}:
                raise Conflict
            kept = [entry for entry in entries if entry["part"] not in parts]
            made = [{"part": new, "by": None, "class": size + 1} for _ in found]
            state["parts"][table][day] = [*made, *kept]
            _discard(state, [[table, day, part] for part in parts])
            return state

        try:
            state = self._log.commit(change)
        except Conflict:
            self._drop_part(table, new, found)
            return 0
        self._sweep(state)
        return len(parts)

    def _sweep(self, state: dict) -> None:
        """Removes the folders of parts that were replaced long enough ago."""
        until = time.time() - self.retain_seconds
        old = [item for at, item in state.get("discarded", ()) if at <= until]
        if not old:
            return
        for table, day, part in old:
            self._drop_part(table, part, [day])

        def change(state: dict) -> dict:
            state["discarded"] = [d for d in state["discarded"] if d[1] not in old]
            return state

        self._log.commit(change)

    # -- appended tables ------------------------------------------------------------------

    def facts(self, days: Iterable[str] | None = None) -> DataFrame:
        """All stored facts, or those of some dates (ISO text): only their parts are opened."""
        return self._rows("facts", self._state(), days).select(*FACT.names)

    def facts_without(
        self, *batches: tuple[str, int], days: Iterable[str] | None = None
    ) -> DataFrame:
        rows = self._rows("facts", self._state(), days)
        for run_id, batch_id in batches:
            rows = rows.filter(~self._own(run_id, batch_id))
        return rows.select(*FACT.names)

    def facts_of(self, batches: list[tuple[str, int]]) -> DataFrame:
        """Facts of these batches alone, each at the number its own run gave it."""
        pending = self._state().get("pending", {})
        parts = [
            self._own_rows("facts", run, number, pending.get(_batch_key(run, number)))
            for run, number in batches
        ]
        return reduce(DataFrame.unionByName, parts).select(*FACT.names)

    def append_facts(self, batch: DataFrame, run_id: str, batch_id: int) -> DataFrame:
        """Store the rows whose key is new and return them; the first writer of a key wins.

        ``batch`` is unique on the key and read twice, so persist it when it is costly to make.
        """
        spans = day_spans(batch, "event_date", "snapshot_timestamp")
        days = _days(spans, "event_date")

        def fresh(others: DataFrame | None) -> DataFrame:
            if others is None:
                return batch.drop("batch_id")
            known = within_spans(others, spans, "event_date", "snapshot_timestamp")
            return absent_rows(batch.drop("batch_id"), known, FACT_KEY)

        self._append("facts", run_id, batch_id, days, fresh, pending=True)
        return self._own_rows("facts", run_id, batch_id, days).select(*FACT.names)

    def append_archive(self, batch: DataFrame, run_id: str, batch_id: int) -> DataFrame:
        """Store every row of the batch and return them as read back; ``batch`` is read once."""
        if not self.holds(run_id, batch_id):
            self._append("archive", run_id, batch_id, [], lambda _: batch, alone=True)
        return self._own_rows("archive", run_id, batch_id).select(*FACT.names)

    def has_archived(self, run_id: str, batch_id: int) -> bool:
        """Whether the archive has a part of this batch alone (runs no job)."""
        own = [run_id, batch_id]
        return any(entry["by"] == own for _, entry in self._entries(self._state(), "archive", None))

    def archive(self) -> DataFrame:
        return self._rows("archive", self._state()).select(*FACT.names)

    def alerts(self) -> DataFrame:
        return self._rows("alerts", self._state()).select(*GOLD["station_alerts"].names)

    def append_alerts(self, alerts: DataFrame, run_id: str, batch_id: int) -> None:
        """Store the alerts whose (station, snapshot, type) is new."""
        dated = alerts.withColumn("alert_date", F.to_date("snapshot_timestamp"))
        spans = day_spans(dated, "alert_date", "snapshot_timestamp")

        def fresh(others: DataFrame | None) -> DataFrame:
            if others is None:
                return dated
            known = within_spans(others, spans, "alert_date", "snapshot_timestamp")
            return absent_rows(dated, known, ALERT_KEY)

        self._append("alerts", run_id, batch_id, _days(spans, "alert_date"), fresh)

    # -- rows behind the watermark --------------------------------------------------------

    def late_rows(self) -> DataFrame:
        return self._rows("late_rows", self._state()).select(*LATE_ROWS.names, "batch_id")

    def newest_before(self, run_id: str, batch_id: int) -> int | None:
        """The newest event time (microseconds) in the run's batches before this one."""
        known = self._state().get("newest", {}).get(run_id, [])
        return max((at for number, at in known if number < batch_id), default=None)

    def append_late_rows(
        self, rows: DataFrame, run_id: str, batch_id: int, newest: int | None
    ) -> None:
        """Store the late rows of a batch and the newest event time up to its end.

        The times of the last batches are kept, so that a repeated batch meets the same watermark.
        """
        self._append("late_rows", run_id, batch_id, [], lambda _: rows, alone=True)

        def change(state: dict) -> dict:
            known = state.setdefault("newest", {}).get(run_id, [])
            others = [one for one in known if one[0] != batch_id]
            if newest is not None:
                others.append([batch_id, newest])
            state["newest"][run_id] = sorted(others)[-_BATCHES_KEPT:]
            return state

        self._log.commit(change)

    def append_rejected(self, rows: DataFrame, run_id: str, batch_id: int) -> None:
        """Keep the (raw, reason) of a batch, dated today; a repeated batch replaces its own."""
        dated = rows.withColumn("rejected_on", F.current_date())
        self._append("rejected", run_id, batch_id, [], lambda _: dated, alone=True)

    def rejected(self, days: Iterable[str] | None = None) -> DataFrame:
        """raw, reason, rejected_on, run_id, batch_id of rejected messages, all or of some dates."""
        return self._rows("rejected", self._state(), days)

    # -- batches under way ----------------------------------------------------------------

    def announce(self, run_id: str, batch_id: int) -> None:
        """Notes that a batch is under way; it is pending once its facts are stored."""

        def change(state: dict) -> dict:
            state.setdefault("pending", {}).setdefault(_batch_key(run_id, batch_id), None)
            return state

        self._log.commit(change)

    def pending(self) -> list[tuple[str, int]]:
        """Batches whose facts are stored and that the current version does not hold."""
        state = self._state()
        stored = {key: days for key, days in state.get("pending", {}).items() if days is not None}
        batches = [_batch_of(key) for key in stored]
        return sorted(batch for batch in batches if not self._held(state, *batch))

    def holds(self, run_id: str, batch_id: int) -> bool:
        """Whether the current version contains the batch."""
        return self._held(self._state(), run_id, batch_id)

    @staticmethod
    def _held(state: dict, run_id: str, batch_id: int) -> bool:
        versions = state.get("versions")
        return bool(versions) and any(
            first <= batch_id <= last for first, last in versions[0]["holds"].get(run_id, [])
        )

    def stored_batches(self) -> dict[str, list[list[int]]]:
        """Numbers of all stored batches per run, as ranges. Batches follow each other, so a run
        is one range, or a few where batches had no new row."""
        facts = self._rows("facts", self._state())
        numbers = facts.select("run_id", "batch_id").distinct()
        per_run = Window.partitionBy("run_id").orderBy("batch_id")
        island = F.col("batch_id") - F.row_number().over(per_run)
        ranges = (
            numbers.withColumn("island", island)
            .groupBy("run_id", "island")
            .agg(F.min("batch_id").alias("first"), F.max("batch_id").alias("last"))
            .orderBy("run_id", "first")
        )
        held: dict[str, list[list[int]]] = {}
        for row in ranges.collect():
            held.setdefault(row.run_id, []).append([row.first, row.last])
        return held

    # -- published versions ---------------------------------------------------------------

    def _versions(self) -> list[dict]:
        """Newest first; at most ``keep_versions`` entries, each of another batch."""
        return self._state().get("versions", [])

    def current(self) -> str | None:
        """The folder of the current version."""
        versions = self._versions()
        return versions[0]["path"] if versions else None

    def new_version(self) -> str:
        return f"{self.root}/gold/{uuid.uuid4().hex}"

    def write_version(self, version: str, table: str, df: DataFrame) -> DataFrame:
        """Write one table of an unpublished version and read it back."""
        df.write.parquet(f"{version}/{table}")
        return self._table({"path": version}, table)

    def write_dates(
        self, table: str, rows: DataFrame, instead: Iterable[str] | None = ()
    ) -> Dates:
        """Write rows of a table that counts them once a version with them is published.

        They come beside the table's other rows, but on the dates ``instead`` (None: on all) in
        their place.
        """
        part, found = self._write_part(table, rows)
        gone = None if instead is None else frozenset(instead)
        return Dates(table, dict.fromkeys(found, part), gone)

    def station_days(self, days: Iterable[str] | None = None) -> DataFrame:
        """First and last reading of each station and date, as the current version has them."""
        return self._rows("station_days", self._state(), days)

    def transitions(self, days: Iterable[str] | None = None) -> DataFrame:
        """The snapshots at which stations became empty or critical, up to the current version."""
        return self._rows("transitions", self._state(), days)

    def publish(
        self,
        version: str,
        run_id: str,
        batch_id: int,
        batches: list[tuple[str, int]] | None = None,
        rebuilt: bool = False,
        based_on: str | None = None,
        dates: Sequence[Dates] = (),
    ) -> None:
        """Make a complete version the current one.

        It holds ``batches`` besides what the version before it held or, when ``rebuilt``, besides
        every stored batch. ``dates`` are the parts that come with it (`write_dates`). Raises
        `Conflict` if the current version is not the one it was folded from (``based_on``; a
        rebuilt one is based on none). Versions past the kept ones, and folders of versions that
        were never published, are removed.
        """
        stored = self.stored_batches() if rebuilt else None
        done = batches or [(run_id, batch_id)]

        def change(state: dict) -> dict:
            old = state.get("versions", [])
            if not rebuilt and based_on != (old[0]["path"] if old else None):
                raise Conflict
            held = stored if rebuilt else (old[0]["holds"] if old else {})
            for run, one in done:
                held = _with_batch(held, run, one)
            entry = {"path": version, "run_id": run_id, "batch_id": batch_id, "holds": held}
            # Only the current version needs its list; a repeat takes the place of its own entry.
            others = [
                {**e, "holds": {}} for e in old if (e["run_id"], e["batch_id"]) != (run_id, batch_id)
            ]
            state["versions"] = [entry, *others][: self.keep_versions]
            pending = state.get("pending", {})
            state["pending"] = {
                key: days for key, days in pending.items() if not self._held(state, *_batch_of(key))
            }
            for change_of in dates:
                _bring(state, change_of)
            return state

        kept = self._log.commit(change)["versions"]
        current = {e["path"].rpartition("/")[2] for e in kept}
        # Another writer's version that goes here could not have been published any more.
        for name in files.names(self.spark, f"{self.root}/gold"):
            if len(name) == 32 and name not in current:
                files.delete(self.spark, f"{self.root}/gold/{name}")

    def hold(self, run_id: str, batch_id: int) -> None:
        """Count a batch without rows as held by the current version, whose tables it leaves alone."""

        def change(state: dict) -> dict:
            newest = state["versions"][0]
            newest["holds"] = _with_batch(newest["holds"], run_id, batch_id)
            return state

        self._log.commit(change)

    def _table(self, version: dict | None, table: str) -> DataFrame:
        schema = (PUBLISHED | INTERNAL)[table]
        if version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{version['path']}/{table}")

    def gold(self, table: str) -> DataFrame:
        """A table of the current version; empty with its declared columns before the first."""
        versions = self._versions()
        return self._table(versions[0] if versions else None, table)


def _batch_key(run_id: str, batch_id: int) -> str:
    return f"{run_id}={batch_id}"


def _batch_of(key: str) -> tuple[str, int]:
    run_id, _, batch_id = key.rpartition("=")
    return run_id, int(batch_id)


def _days(rows: Sequence[Row], column: str) -> list[str]:
    return sorted(row[column].isoformat() for row in rows if row[column] is not None)


def _discard(state: dict, items: list[list[str]]) -> None:
    now = time.time()
    state["discarded"] = [*state.get("discarded", ()), *([now, item] for item in items)]


def _replace(state: dict, table: str, own: list, parts: dict[str, str]) -> None:
    """The batch's parts, in place of those that it had."""
    by_day = state.setdefault("parts", {}).setdefault(table, {})
    for day in list(by_day):
        old = [entry for entry in by_day[day] if entry["by"] == own]
        if old:
            by_day[day] = [entry for entry in by_day[day] if entry["by"] != own]
            _discard(state, [[table, day, entry["part"]] for entry in old])
    for day, part in parts.items():
        by_day.setdefault(day, []).append({"part": part, "by": own, "class": 0})


def _bring(state: dict, dates: Dates) -> None:
    by_day = state.setdefault("parts", {}).setdefault(dates.table, {})
    for day in list(by_day) if dates.instead is None else dates.instead:
        _discard(state, [[dates.table, day, e["part"]] for e in by_day.pop(day, ())])
    for day, part in dates.parts.items():
        by_day.setdefault(day, []).append({"part": part, "by": None, "class": 0})


def _with_batch(
    held: dict[str, list[list[int]]], run_id: str, batch_id: int
) -> dict[str, list[list[int]]]:
    """The ranges with one more number, joined where they touch."""
    ranges = sorted([*held.get(run_id, []), [batch_id, batch_id]])
    joined: list[list[int]] = []
    for first, last in ranges:
        if joined and first <= joined[-1][1] + 1:
            joined[-1] = [joined[-1][0], max(joined[-1][1], last)]
        else:
            joined.append([first, last])
    return {**held, run_id: joined}
