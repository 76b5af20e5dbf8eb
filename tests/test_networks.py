from __future__ import annotations

import json

import pytest
from conftest import rows, wire
from pyspark.sql import functions as F

from gaugeflow.functions.text import fold_label, fold_text
from gaugeflow.operators.cleaning import reject_messages
from gaugeflow.operators.networks import (
    match_networks,
    normalize_payload,
    resolve_targets,
    unmatched_cities,
)
from gaugeflow.schema import NETWORK_TARGET, SNAPSHOT_DOCUMENT, STATION_PAYLOAD, WIRE
from gaugeflow.sources import documents, records
from gaugeflow.sources.store import StationStore
from gaugeflow.streaming.ingest import start_rejected


@pytest.fixture
def catalog(spark):
    def build(networks: list[tuple]):
        return spark.createDataFrame(
            [(n, *network) for n, network in enumerate(networks)],
            "position int, id string, name string, href string, city string, country string",
        )

    return build


NETWORKS = [
    ("quaybikes", "Quay Bikes", "/v2/networks/quaybikes", "Nantes", "FR"),
    ("dockwheel", "Dock Wheel", "/v2/networks/dockwheel", "Rennes", "fra"),
    ("elsewhere", "Elsewhere", "/v2/networks/elsewhere", "Nantes", "US"),
]


def test_only_supported_countries_match(catalog):
    targets = match_networks(catalog(NETWORKS), ["Nantes", "Rennes"])
    assert rows(targets, "requested_city", "network_id", "candidates", "ambiguous") == [
        ("Nantes", "quaybikes", 1, False),
        ("Rennes", "dockwheel", 1, False),
    ]


def test_best_match_order(catalog):
    found = catalog(
        [
            ("far", "A", None, "Besançon-les-Bains", "FR"),
            ("near", "B", None, "  BESANCON ", "FR"),
            ("twin-b", "Zeta", None, "Metz Centre", "FR"),
            ("twin-a", "Alpha", None, "Metz Centre", "FR"),
            ("later", "Alpha", None, "Metz Centre", "FR"),
            ("blank", "Blank", None, "", "FR"),
            ("none", "None", None, None, "FR"),
        ]
    )
    targets = match_networks(found, ["Besançon", "Metz", "Nulle part"])
    assert rows(targets, "requested_city", "network_id", "candidates", "href") == [
        ("Besançon", "near", 2, "/networks/near"),
        ("Metz", "twin-a", 3, "/networks/twin-a"),
    ]
    assert rows(unmatched_cities(found, ["Besançon", "Nulle part"])) == [("Nulle part",)]


def test_saved_targets_stand_in_for_a_failed_discovery(catalog, spark, tmp_path):
    targets = resolve_targets(catalog(NETWORKS), ["Nantes"])
    path = str(tmp_path / "targets")
    assert documents.saved_targets(spark, path) is None
    for _ in range(2):
        documents.save_targets(targets, path)
    saved = documents.saved_targets(spark, path)
    assert saved.schema == NETWORK_TARGET
    for broken in (None, catalog(NETWORKS[2:])):
        assert rows(resolve_targets(broken, ["Nantes"], saved)) == rows(targets)
    with pytest.raises(RuntimeError):
        resolve_targets(None, ["Nantes"])


def _payload(spark, **changes):
    station = {
        "id": "417",
        "name": "Quai Nord",
        "latitude": 47.21,
        "longitude": -1.56,
        "free_bikes": 6,
        "empty_slots": 4,
        "timestamp": "2026-04-21T09:00:00+00:00Z",
        "extra": ("u1", "1 rue A"),
    } | changes
    row = tuple(station[name] for name in STATION_PAYLOAD.names)
    return spark.createDataFrame([row], STATION_PAYLOAD).withColumns(
        {
            "network_id": F.lit("quaybikes"),
            "city": F.lit("Nantes"),
            "ingested_at": F.lit("2026-04-21T09:00:01Z"),
        }
    )


def test_payload_becomes_a_wire_record(spark):
    record = normalize_payload(_payload(spark))
    assert record.columns == WIRE.names
    assert record.first().asDict() == {
        "station_id": "417",
        "station_name": "Quai Nord",
        "latitude": 47.21,
        "longitude": -1.56,
        "bikes_available": 6,
        "free_slots": 4,
        "timestamp": "2026-04-21T09:00:00+00:00",
        "network_id": "quaybikes",
        "city": "Nantes",
        "station_key": "quaybikes:417",
        "ingested_at": "2026-04-21T09:00:01Z",
    }


def test_payload_fallbacks(spark):
    row = normalize_payload(_payload(spark, id="", name=None, timestamp=" ")).first()
    assert (row.station_id, row.station_key, row.station_name, row.timestamp) == (
        "u1", "quaybikes:u1", "1 rue A", "2026-04-21T09:00:01Z",
    )
    assert normalize_payload(_payload(spark, id=None, extra=(None, None))).count() == 0


def test_landed_documents(spark, tmp_path):
    poll = (
        '{"network_id": "quaybikes", "city": "Nantes", "ingested_at": "2026-04-21T09:00:01Z", '
        '"network": {"name": "x", "stations": [{"id": "1", "free_bikes": 2, "extra": {}}, '
        '{"extra": {"uid": "b", "address": "rue B"}}, {"name": "nameless"}]}}'
    )
    (tmp_path / "polls.json").write_text(poll + "\n")
    found = documents.explode_snapshot(documents.read_snapshots(spark, str(tmp_path / "polls.json")))
    assert rows(found, "station_key", "station_name", "bikes_available") == [
        ("quaybikes:1", None, 2),
        ("quaybikes:b", "rue B", None),
    ]
    assert documents.read_snapshots(spark, str(tmp_path)).schema == SNAPSHOT_DOCUMENT
    catalog = (
        '{"networks": [{"id": "quaybikes", "name": "Quay Bikes", "href": "/v2/networks/quaybikes",\n'
        ' "location": {"city": "Nantes", "country": "FR"}}]}'
    )
    (tmp_path / "catalog.json").write_text(catalog)
    networks = documents.read_catalog(spark, str(tmp_path / "catalog.json"))
    assert rows(match_networks(networks, ["nantes"]), "network_id", "city") == [("quaybikes", "Nantes")]


def test_labels(spark):
    labels = {
        "Besançon": "besancon",
        " Orléans   Métropole\t": "orleans metropole",
        "œuf ﬁn ②": "uf fin 2",
        "": "",
        None: "",
    }
    assert {text: fold_text(text) for text in labels} == labels
    df = spark.createDataFrame([(text,) for text in labels], "t string")
    assert {r.t: r.f for r in df.select("t", fold_label(F.col("t")).alias("f")).collect()} == labels


def test_connector_options():
    assert records.kafka_source_options("broker:9092", "stations") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "stations",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    limited = records.kafka_source_options("b", "t", max_offsets_per_trigger=5)
    assert limited["maxOffsetsPerTrigger"] == "5"
    assert records.jdbc_options("jdbc:x", "gold", "u", "p", "d")["truncate"] == "true"


def test_targets_that_cannot_stand_in_replace_nothing(catalog, spark, tmp_path):
    path = str(tmp_path / "targets")
    good = resolve_targets(catalog(NETWORKS), ["Nantes"])
    documents.save_targets(good, path)
    for bad in (good.limit(0), good.unionByName(good), good.withColumn("network_id", F.lit(None))):
        with pytest.raises(RuntimeError):
            documents.save_targets(bad, path)
    assert rows(documents.saved_targets(spark, path)) == rows(good)


def test_a_broken_catalog_falls_back(catalog, spark, tmp_path):
    landed, saved = tmp_path / "catalog", str(tmp_path / "targets")
    landed.mkdir()
    with pytest.raises(RuntimeError):
        documents.discover_targets(spark, str(tmp_path / "none"), ["Nantes"], saved)
    city = {"city": "Nantes", "country": "FR"}
    network = {"id": "n1", "name": "N", "href": "/networks/n1", "location": city}
    (landed / "1.json").write_text(json.dumps({"networks": [network]}))
    found = documents.discover_targets(spark, str(landed), ["Nantes"], saved)
    assert rows(found, "network_id") == [("n1",)]
    (landed / "1.json").write_text("429 too many requests")
    for path in (landed, tmp_path / "none"):
        assert rows(documents.discover_targets(spark, str(path), ["Nantes"], saved)) == rows(found)


def test_labels_without_python_equal_those_with_it(spark):
    texts = [chr(code) for code in range(0x250)] + ["Île-de-France\x1f  Œuvre", "ﬁn Ǆ", "東京 A", "", None]
    texts += [f"x{a}{b} " for a in "éßİĲŉ" for b in "Åøſ\u0301"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = frame.select("text", fold_label(F.col("text")).alias("label")).collect()
    assert {r.text: r.label for r in found} == {t: fold_text(t) for t in texts}


def test_rejected_messages_keep_their_text(spark, tmp_path):
    texts = [
        json.dumps(wire()), json.dumps(wire(bikes_available=-1)), "{broken", None, "[]",
        json.dumps(wire(timestamp="soon")), json.dumps(wire(latitude="far")), "{}",
    ]
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "0.txt").write_text("\n".join(t for t in texts if t is not None))
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    expected = {
        texts[1]: "negative bikes_available", "{broken": "unreadable", None: "unreadable",
        "[]": "unreadable", texts[5]: "missing snapshot_timestamp", texts[6]: "unreadable",
        "{}": "missing station_key",
    }
    assert {r.raw: r.reason for r in reject_messages(frame).collect()} == expected
    store = StationStore(spark, str(tmp_path / "store"))
    messages = spark.readStream.text(str(landing))
    query = start_rejected(messages, store, str(tmp_path / "c"), "run", available_now=True)
    query.awaitTermination()
    del expected[None]
    assert {r.raw: r.reason for r in store.rejected().collect()} == expected
