from __future__ import annotations

import json
import os
import time

import pytest
from conftest import random_readings, reading, rows, wire
from pyspark.sql import functions as F

from gaugeflow.operators import activity, alerts, timeline
from gaugeflow.operators.dedupe import transform_snapshots
from gaugeflow.params import Params
from gaugeflow.plans.dashboard import dashboard_frames
from gaugeflow.schema import FRAMES
from gaugeflow.session import fresh_dir
from gaugeflow.sources.records import stream_json_folder
from gaugeflow.sources.store import StationStore
from gaugeflow.streaming import ingest, job
from gaugeflow.streaming.transitions import stream_transitions

PARAMS = Params(critical_utilization_threshold=0.5)


def _land(folder, name, records):
    path = folder / f"{name}.json"
    path.write_text("\n".join(json.dumps(record) for record in records))
    stamp = 1_700_000_000 + int(name)
    os.utime(path, (stamp, stamp))


def _run(spark, folder, store, checkpoint, run_id="run", files_per_batch=1):
    records = stream_json_folder(spark, str(folder), files_per_batch)
    query = ingest.start(records, store, str(checkpoint), run_id, PARAMS, available_now=True)
    query.awaitTermination()
    return query


@pytest.fixture
def arrivals():
    """Slices in event-time order, with invalid rows and exact copies."""
    ordered = sorted(random_readings(240, 6, 21), key=lambda record: record["timestamp"])
    slices = [ordered[start : start + 80] for start in range(0, 240, 80)]
    for part in slices:
        part.extend([part[0], wire(bikes_available=-1), wire(timestamp="soon")])
    return slices


def test_stream_equals_batch_and_survives_a_restart(spark, frame, tmp_path, arrivals):
    landing = tmp_path / "in"
    landing.mkdir()
    store = StationStore(spark, fresh_dir(spark, "stream"))
    for number, part in enumerate(arrivals[:2]):
        _land(landing, str(number), part)
    _run(spark, landing, store, tmp_path / "checkpoint")
    _land(landing, "2", arrivals[2])
    _run(spark, landing, store, tmp_path / "checkpoint")

    raw = frame([record for part in arrivals for record in part])
    batch = transform_snapshots(raw).cache()
    assert rows(store.facts().drop("batch_id")) == rows(batch)
    assert rows(store.archive().drop("batch_id")) == rows(batch)
    assert store.facts().select("batch_id").distinct().count() == 3
    latest = timeline.latest_status(batch)
    assert rows(store.gold("latest_station_status").drop("batch_id")) == rows(latest)
    assert rows(store.gold("hourly_activity")) == rows(activity.hourly_activity(batch))
    every = alerts.alert_history(batch, PARAMS)
    key = ("station_key", "snapshot_timestamp", "alert_type")
    assert set(rows(store.alerts(), *key)) <= set(rows(every, *key))

    # A new checkpoint reads everything again; with a run id of its own nothing changes.
    before = rows(store.facts())
    _run(spark, landing, store, tmp_path / "other", run_id="second")
    assert rows(store.facts()) == before
    assert rows(store.gold("latest_station_status").drop("batch_id")) == rows(latest)
    assert rows(store.gold("hourly_activity")) == rows(activity.hourly_activity(batch))


def test_job_and_dashboard(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    _land(landing, "0", [reading("1", 0, 0, 5), reading("2", 1, 2, 0, "Lyon")])
    root = fresh_dir(spark, "job")
    job.main(
        ["--folder", str(landing), "--root", root, "--checkpoint", str(tmp_path / "c"),
         "--run-id", "r", "--available-now", "--critical-bikes-threshold", "2"]
    )
    as_of = F.lit("2026-04-21 09:02:00").cast("timestamp")
    shown = dashboard_frames(
        StationStore(spark, root), as_of, selected_cities=["Lyon"], focus="tension"
    )
    for name, schema in FRAMES.items():
        assert shown[name].columns == schema.names
        assert rows(shown[name].select("city").distinct()) == [("Lyon",)], name
    assert shown["map"].count() == 1
    row = shown["metrics"].first()
    assert (row.total_stations, row.tracked_cities, row.empty_stations) == (2, 2, 1)
    assert shown["freshness"].first().age_seconds == 60
    empty = dashboard_frames(StationStore(spark, fresh_dir(spark, "none")), as_of)
    assert all(empty[name].count() == 0 for name in FRAMES)
    assert empty["freshness"].first().level == "info"


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    _land(landing, "0", [reading("1", 60, 1, 1)])
    # The engine drops against the watermark of the batch before, so one batch lies between.
    _land(landing, "1", [reading("2", 60, 5, 5)])
    _land(landing, "2", [reading("1", 49, 2, 2), reading("1", 50, 3, 3), reading("1", 51, 4, 4)])
    store = StationStore(spark, fresh_dir(spark, "late"))
    late = ingest.LateRows()
    spark.streams.addListener(late)
    try:
        _run(spark, landing, store, tmp_path / "checkpoint")
        # Events reach listeners a little after the query has ended.
        for _ in range(100):
            if late.total == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(late)
    assert late.total == 2
    assert rows(store.facts(), "bikes_available") == [(1,), (4,), (5,)]


def test_streamed_transitions_equal_the_batch_form(spark, facts, tmp_path, arrivals):
    landing = tmp_path / "in"
    landing.mkdir()
    for number, part in enumerate(arrivals):
        _land(landing, str(number), part)
    clean = transform_snapshots(stream_json_folder(spark, str(landing), 1))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = (
        stream_transitions(clean, PARAMS)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    known = facts([record for part in arrivals for record in part]).dropDuplicates(
        ["station_key", "snapshot_timestamp"]
    )
    key = ("station_key", "snapshot_timestamp", "alert_type", "alert_message")
    expected = rows(alerts.alert_transitions(known, PARAMS), *key)
    assert rows(spark.read.parquet(out), *key) == expected
    assert expected
