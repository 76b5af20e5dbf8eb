"""The streaming job: records to facts, archive, gold tables and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from gaugeflow.functions.timestamps import interval_seconds
from gaugeflow.operators.cleaning import clean_snapshots, reject_messages
from gaugeflow.operators.dedupe import transform_snapshots
from gaugeflow.operators.lateness import behind
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.plans.refresh import refresh_batch
from gaugeflow.schema import CLEAN, FACT
from gaugeflow.sources.store import StationStore

QUERY_NAME = "station_snapshots"


def micro_batch_writer(store: StationStore, run_id: str, params: Params = DEFAULTS):
    """The foreachBatch callback: tag the batch, then refresh every table from it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        refresh_batch(store, tagged.select(*FACT.names), run_id, batch_id, params)

    return write


def start(
    records: DataFrame,
    store: StationStore,
    checkpoint: str,
    run_id: str,
    params: Params = DEFAULTS,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the job on decoded wire records.

    Batch numbers begin at 0 with every new checkpoint, so ``run_id`` must be new with it too and
    stay the same when the job is resumed from it.
    """
    writer = (
        transform_snapshots(records, params)
        .writeStream.queryName(QUERY_NAME)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(micro_batch_writer(store, run_id, params))
    )
    return _triggered(writer, params, available_now).start()


def late_row_writer(store: StationStore, run_id: str, params: Params = DEFAULTS):
    """The foreachBatch callback that keeps the rows behind the watermark."""
    delay = interval_seconds(params.watermark)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            before = store.newest_before(run_id, batch_id)
            (own,) = batch.agg(F.max(F.unix_micros("snapshot_timestamp"))).first()
            known = [at for at in (before, own) if at is not None]
            rows = behind(batch.select(*CLEAN.names), before, delay)
            store.append_late_rows(rows, run_id, batch_id, max(known, default=None))
        finally:
            batch.unpersist()

    return write


def start_late_rows(
    records: DataFrame,
    store: StationStore,
    checkpoint: str,
    run_id: str,
    params: Params = DEFAULTS,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the side output of the job: valid rows that come behind the watermark go to a table.

    It reads the same records with a checkpoint of its own and holds no state but the newest event
    time of each batch, kept in the store, so a repeated batch gives the same rows. The watermark of
    a batch is that of all earlier batches, as in `late_rows`; the job's own stateful operator may
    compare with one batch less. Copies of a row are kept each.
    """
    writer = (
        clean_snapshots(records, params)
        .writeStream.queryName(f"{QUERY_NAME}_late")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(late_row_writer(store, run_id, params))
    )
    return _triggered(writer, params, available_now).start()


def start_rejected(
    messages: DataFrame,
    store: StationStore,
    checkpoint: str,
    run_id: str,
    params: Params = DEFAULTS,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the dead-letter output: messages (value) that give no fact, with the reason.

    To replay some, decode their raw text again: ``store.rejected(days)`` has it by date.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store.append_rejected(batch, run_id, batch_id)

    writer = (
        reject_messages(messages)
        .writeStream.queryName(f"{QUERY_NAME}_rejected")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return _triggered(writer, params, available_now).start()


def _triggered(
    writer: DataStreamWriter, params: Params, available_now: bool
) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{params.poll_interval_seconds} seconds")


class LateRows(StreamingQueryListener):
    """Counts the rows that state operators dropped behind the watermark, over a whole run.

    Register it before the query starts (`spark.streams.addListener`). Each batch is counted by its
    number, so a batch reported twice counts once.
    """

    def __init__(self) -> None:
        self.by_batch: dict[tuple[str, int], int] = {}

    @property
    def total(self) -> int:
        return sum(self.by_batch.values())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        if dropped:
            self.by_batch[(str(progress.runId), progress.batchId)] = dropped

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
