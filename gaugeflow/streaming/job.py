"""Run the streaming job: spark-submit gaugeflow/streaming/job.py --root ... --checkpoint ... ."""

from __future__ import annotations

import argparse
from dataclasses import replace

from gaugeflow.params import DEFAULTS
from gaugeflow.session import build_session
from gaugeflow.sources.records import kafka_source_options, stream_json_folder, stream_topic
from gaugeflow.sources.store import StationStore
from gaugeflow.streaming.ingest import start, start_late_rows


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--checkpoint", required=True, help="progress of this run")
    parser.add_argument("--run-id", required=True, help="new with every new checkpoint")
    parser.add_argument("--late-checkpoint", help="keep late rows too; progress of that query")
    parser.add_argument("--folder", help="read JSON lines landed here")
    parser.add_argument("--servers", help="read a topic from these brokers")
    parser.add_argument("--topic", default="station_status")
    parser.add_argument("--starting-offsets", default="earliest")
    parser.add_argument("--max-per-trigger", type=int, help="files or offsets per micro-batch")
    parser.add_argument("--available-now", action="store_true", help="stop when caught up")
    settings = {
        "poll_interval_seconds": "seconds between micro-batches",
        "watermark": "how late a snapshot may come, as '10 minutes'",
        "low_availability_threshold": "mean bikes under which a zone is short",
        "critical_bikes_threshold": "bikes up to which a station can be critical",
        "critical_utilization_threshold": "mean fullness from which it is",
        "top_station_limit": "ranks shown",
    }
    for name, text in settings.items():
        default = getattr(DEFAULTS, name)
        parser.add_argument(
            f"--{name.replace('_', '-')}", type=type(default), default=default, help=text
        )
    options = parser.parse_args(arguments)
    if bool(options.folder) == bool(options.servers):
        parser.error("give either --folder or --servers")
    spark = build_session("station-snapshots")
    if options.folder:
        records = stream_json_folder(spark, options.folder, options.max_per_trigger)
    else:
        records = stream_topic(
            spark,
            kafka_source_options(
                options.servers, options.topic, options.starting_offsets, options.max_per_trigger
            ),
        )
    store = StationStore(spark, options.root)
    params = replace(DEFAULTS, **{name: getattr(options, name) for name in settings})
    queries = [
        start(records, store, options.checkpoint, options.run_id, params, options.available_now)
    ]
    if options.late_checkpoint:
        queries.append(
            start_late_rows(
                records, store, options.late_checkpoint, options.run_id, params,
                options.available_now,
            )
        )
    for query in queries:
        query.awaitTermination()


if __name__ == "__main__":
    main()
