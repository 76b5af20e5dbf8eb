from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gaugeflow.operators.cleaning import clean_snapshots  # noqa: E402
from gaugeflow.schema import WIRE  # noqa: E402
from gaugeflow.session import build_session  # noqa: E402

START = datetime(2026, 4, 21, 9, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def wire(**changes) -> dict:
    """One valid wire record, with changes."""
    record = {
        "station_id": "417",
        "station_name": "Quai Nord",
        "latitude": 47.2184,
        "longitude": -1.5536,
        "bikes_available": 6,
        "free_slots": 4,
        "timestamp": "2026-04-21T09:00:00Z",
        "network_id": "quaybikes",
        "city": "Paris",
        "station_key": "quaybikes:417",
        "ingested_at": "2026-04-21T09:00:01Z",
    }
    return record | changes


def reading(station: str, minute: float, bikes: int, slots: int, city: str = "Paris") -> dict:
    at = START + timedelta(minutes=minute)
    text = at.strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z"
    return wire(
        station_id=station,
        station_name=f"Station {station}",
        station_key=f"quaybikes:{station}",
        bikes_available=bikes,
        free_slots=slots,
        city=city,
        timestamp=text,
        ingested_at=text,
    )


@pytest.fixture
def frame(spark):
    """Builds a wire frame from record dicts."""

    def build(records: list[dict]):
        rows = [tuple(record[name] for name in WIRE.names) for record in records]
        return spark.createDataFrame(rows, WIRE)

    return build


@pytest.fixture
def facts(frame):
    """Builds cleaned facts from record dicts."""
    return lambda records: clean_snapshots(frame(records))


def rows(df, *columns) -> list[tuple]:
    return sorted((tuple(row) for row in df.select(*(columns or df.columns)).collect()), key=repr)


def random_readings(count: int, stations: int, seed: int, minutes: int = 600) -> list[dict]:
    """Unique (station, time) readings; station 0 holds about a third of them."""
    import random

    source = random.Random(seed)
    taken: dict[tuple, dict] = {}
    while len(taken) < count:
        station = 0 if source.random() < 0.33 else source.randrange(1, stations)
        minute = source.randrange(minutes * 4) / 4
        bikes = source.choice([0, 0, 1, 2, 5, 9])
        slots = source.choice([0, 0, 1, 4, 8])
        city = ["Paris", "Lyon", "Lille"][station % 3]
        taken.setdefault((station, minute), reading(str(station), minute, bikes, slots, city))
    return list(taken.values())
