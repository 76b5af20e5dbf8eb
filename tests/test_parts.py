"""Commits, parts, merging, and what a batch reads."""

from __future__ import annotations

import random
import threading

import pytest
from conftest import random_readings, reading, rows
from pyspark.sql import functions as F
from test_store import PARAMS, _batch, _check_gold, _created

from gaugeflow.functions.timestamps import interval_seconds
from gaugeflow.operators import activity, alerts, timeline
from gaugeflow.plans.refresh import refresh_all, refresh_batch
from gaugeflow.session import fresh_dir
from gaugeflow.sources import files
from gaugeflow.sources.commits import CommitLog, Conflict
from gaugeflow.sources.store import StationStore
from gaugeflow.streaming.ingest import late_row_writer

DAY = 1440


def test_commits_of_many_writers_are_all_kept(spark):
    folder = fresh_dir(spark, "commits")

    def add(log: CommitLog, name: str) -> None:
        def change(state: dict) -> dict:
            return {"names": [*state.get("names", []), name]}

        log.commit(change)

    def work(writer: int) -> None:
        log = CommitLog(spark, folder, keep=6)
        for k in range(8):
            add(log, f"{writer}-{k}")

    threads = [threading.Thread(target=work, args=[w]) for w in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    number, state = CommitLog(spark, folder).read()
    assert number == 32
    assert sorted(state["names"]) == sorted(f"{w}-{k}" for w in range(4) for k in range(8))
    assert len(files.names(spark, folder)) <= 10


def test_a_file_is_created_once(spark):
    path = f"{fresh_dir(spark, 'once')}/1.json"
    assert files.create_text(spark, path, "first")
    assert not files.create_text(spark, path, "second")
    assert files.read_text(spark, path) == "first"
    assert files.names(spark, path.rpartition("/")[0]) == ["1.json"]


def test_a_refused_change_commits_nothing(spark):
    log = CommitLog(spark, fresh_dir(spark, "refused"))

    def refuse(_: dict) -> dict:
        raise Conflict

    with pytest.raises(Conflict):
        log.commit(refuse)
    assert log.read() == (0, {})


def _parts(store, table):
    by_day = store._state()["parts"][table]
    return {day: len(entries) for day, entries in by_day.items()}


def test_merged_parts_hold_the_same_rows(spark, facts):
    store = StationStore(spark, fresh_dir(spark, "merged"), merge_at=3, retain_seconds=0)
    batches = [_batch(facts, k, reading("1", k, k, 4), reading("2", k, 2, k)) for k in range(10)]
    for number, batch in enumerate(batches):
        store.append_facts(batch, "run", number)
        store.append_archive(batch, "run", number)
    before = rows(store.facts()), rows(store.archive())
    assert store.compact("facts") == 0  # nothing is published yet
    refresh_all(store, "run", 9, PARAMS, _created())
    for _ in range(3):
        store.compact("facts")
        store.compact("archive")
    assert (rows(store.facts()), rows(store.archive())) == before
    assert set(_parts(store, "facts").values()) == {1}
    assert len(files.names(spark, f"{store.root}/facts")) <= 2
    assert store.holds("run", 4) and store.stored_batches() == {"run": [[0, 9]]}
    # A merged batch that comes again changes nothing.
    store.append_archive(batches[4], "run", 4)
    refresh_batch(store, batches[4], "run", 4, PARAMS, _created())
    assert (rows(store.facts()), rows(store.archive())) == before


def test_parts_of_a_date_stay_few(spark, facts):
    store = StationStore(spark, fresh_dir(spark, "few"), merge_at=2)
    most = 0
    for number in range(9):
        batch = _batch(facts, number, reading("1", number, number, 4))
        refresh_batch(store, batch, "run", number, PARAMS, _created())
        most = max(most, *_parts(store, "facts").values(), *_parts(store, "archive").values())
    assert most <= 4  # one of each size class
    _check_gold(store, store.facts())
    assert rows(store.facts(), "batch_id") == [(k,) for k in range(9)]


def _spy(monkeypatch):
    """Dates of the fact parts that are read."""
    seen = []
    plain = StationStore._read_parts

    def read(self, table, parts):
        if table == "facts":
            seen.extend(day for day, _ in parts)
        return plain(self, table, parts)

    monkeypatch.setattr(StationStore, "_read_parts", read)
    return seen


def test_a_batch_opens_the_facts_of_its_dates_alone(spark, facts, monkeypatch):
    store = StationStore(spark, fresh_dir(spark, "dates"))
    days = [reading(s, d * DAY + 60, d + 1, 9 - d) for s in "12" for d in (0, 1, 3, 4)]
    refresh_batch(store, _batch(facts, 0, *days), "run", 0, PARAMS, _created())
    seen = _spy(monkeypatch)
    # In order; then late ones: inside a date, on a date without readings, before the first.
    steps = [
        ([reading("1", 4 * DAY + 90, 0, 4)], {"2026-04-25"}),
        ([reading("1", 1 * DAY + 30, 7, 2)], {"2026-04-22"}),
        ([reading("1", 2 * DAY + 30, 3, 3), reading("2", 2 * DAY + 1, 0, 9)], {"2026-04-23"}),
        ([reading("1", -DAY, 5, 5), reading("3", 0, 1, 1)], {"2026-04-20", "2026-04-21"}),
    ]
    # The transitions of a late station look at the dates around: two on and the ones before.
    around = {"2026-04-21", "2026-04-22", "2026-04-23", "2026-04-24", "2026-04-25"}
    for number, (records, dates) in enumerate(steps, 1):
        del seen[:]
        refresh_batch(store, _batch(facts, number, *records), "run", number, PARAMS, _created())
        assert set(seen) <= (dates if number == 1 else dates | around)
        with monkeypatch.context() as plain:
            plain.undo()
            _check_gold(store, store.facts())
            turned = rows(alerts.alert_transitions(store.facts(), PARAMS))
            assert rows(store.transitions().drop("alert_date")) == turned
    known = store.facts()
    assert rows(store.station_days()) == rows(activity.station_days(known))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_late_batches(spark, facts, seed):
    draw = random.Random(seed)
    records = random_readings(160, 5, seed, minutes=5 * DAY)
    draw.shuffle(records)
    store = StationStore(spark, fresh_dir(spark, "random"), merge_at=2)
    keys = ["station_key", "snapshot_timestamp"]
    known = None
    for number in range(3):
        part = facts(records[number::3]).dropDuplicates(keys)
        batch = part.withColumn("batch_id", F.lit(number).cast("bigint"))
        if known is not None:
            batch = batch.join(known.select(*keys), keys, "left_anti").select(*batch.columns)
        batch = batch.cache()
        refresh_batch(store, batch, "run", number, PARAMS, _created())
        known = store.facts()
    _check_gold(store, known)
    assert rows(store.station_days()) == rows(activity.station_days(known))
    latest = timeline.latest_status(known)
    every = rows(alerts.current_alerts(latest, alerts.critical_stations(latest, known, PARAMS)))
    turned = alerts.alert_transitions(known, PARAMS)
    assert rows(store.transitions().drop("alert_date")) == rows(turned)
    logged = set(rows(store.alerts().drop("created_at")))
    assert {row[:6] for row in every} <= {row[:6] for row in logged}


def test_alerts_of_a_batch_that_was_cut_short(spark, facts, monkeypatch):
    store = StationStore(spark, fresh_dir(spark, "cut"))
    with monkeypatch.context() as patch:
        patch.setattr(StationStore, "publish", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_batch(store, _batch(facts, 0, reading("1", 0, 0, 5)), "a", 0, PARAMS, _created())
    refresh_batch(store, _batch(facts, 1, reading("1", 5, 4, 1)), "a", 1, PARAMS, _created())
    assert rows(store.alerts(), "station_id", "alert_type") == [("1", "empty")]
    _check_gold(store, store.facts())


def test_two_writers_lose_nothing(spark, facts):
    root = fresh_dir(spark, "writers")
    shared = reading("7", 3, 1, 1)  # both bring this key
    failures = []

    def work(run: str, stations: str) -> None:
        store = StationStore(spark, root, merge_at=2)
        try:
            for number in range(3):
                own = [reading(s, 10 * number, number, 5) for s in stations]
                batch = _batch(facts, number, shared, *own)
                refresh_batch(store, batch, run, number, PARAMS, _created())
        except Exception as error:  # noqa: BLE001
            failures.append(error)

    threads = [threading.Thread(target=work, args=a) for a in (("a", "12"), ("b", "34"))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failures
    store = StationStore(spark, root)
    known = store.facts()
    assert known.count() == 4 * 3 + 1
    assert known.select("station_key", "snapshot_timestamp").distinct().count() == 13
    assert store.pending() == []
    _check_gold(store, known)


def test_only_the_dates_around_a_late_fact_are_opened(spark, facts, monkeypatch):
    store = StationStore(spark, fresh_dir(spark, "around"))
    days = [reading("1", d * DAY + 60, d % 3, 4) for d in range(10)]
    refresh_batch(store, _batch(facts, 0, *days), "run", 0, PARAMS, _created())
    seen = _spy(monkeypatch)
    late = _batch(facts, 1, reading("1", 3 * DAY + 70, 0, 9))
    refresh_batch(store, late, "run", 1, PARAMS, _created())
    assert set(seen) <= {f"2026-04-{day}" for day in range(22, 27)}
    turned = alerts.alert_transitions(store.facts(), PARAMS)
    assert rows(store.transitions().drop("alert_date")) == rows(turned)
    # The history of a rebuilt store is the same.
    refresh_all(store, "run", 1, PARAMS, _created())
    assert rows(store.transitions().drop("alert_date")) == rows(turned)


def test_late_rows_go_to_a_table(spark, facts):
    store = StationStore(spark, fresh_dir(spark, "late"))
    write = late_row_writer(store, "run", PARAMS)
    first = facts([reading("1", 60, 1, 1)])
    second = facts([reading("1", 49, 2, 2), reading("1", 50, 3, 3), reading("1", 51, 4, 4)])
    third = facts([reading("2", 80, 1, 1)])
    for number, batch in enumerate([first, second, third]):
        write(batch, number)
    write(second, 1)  # again: the watermark is that of its own time
    write(facts([]), 3)
    write(facts([reading("2", 70, 6, 6)]), 4)
    got = rows(store.late_rows(), "bikes_available", "batch_id")
    assert got == [(2, 1), (3, 1), (6, 4)]
    ends = {r.batch_id: r.watermark.strftime("%H:%M") for r in store.late_rows().collect()}
    assert ends == {1: "09:50", 4: "10:10"}


def test_intervals():
    assert interval_seconds("10 minutes") == 600
    assert interval_seconds("1 hour 30 minutes") == 5400
    with pytest.raises(ValueError):
        interval_seconds("soon")
