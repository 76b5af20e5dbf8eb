"""Batches without rows, as a stream has one after each landing."""

from __future__ import annotations

import pytest
from conftest import reading, rows
from pyspark.sql import functions as F

from gaugeflow.operators import ranking
from gaugeflow.params import Params
from gaugeflow.plans.refresh import refresh_batch
from gaugeflow.session import fresh_dir
from gaugeflow.sources.store import StationStore

PARAMS = Params(critical_utilization_threshold=0.5)


def _created():
    return F.lit("2026-04-22 00:00:00").cast("timestamp")


@pytest.fixture
def refresh(spark, facts):
    store = StationStore(spark, fresh_dir(spark, "empty"))

    def batch(number, *records):
        tagged = facts(list(records) or [reading("1", 0, 1, 1)])
        tagged = tagged.withColumn("batch_id", F.lit(number).cast("bigint"))
        refresh_batch(
            store, tagged if records else tagged.limit(0), "run", number, PARAMS, _created()
        )
        return store

    return batch


def test_a_batch_without_rows_is_held_and_writes_no_table(refresh):
    store = refresh(0, reading("1", 0, 3, 3))
    version = store.current()
    refresh(1)
    assert store.current() == version
    assert store.holds("run", 1) and store.pending() == []
    refresh(1)
    refresh(2, reading("1", 5, 4, 1))
    assert store.current() != version
    assert store._versions()[0]["holds"] == {"run": [[0, 2]]}
    assert rows(store.gold("latest_station_status"), "station_id", "bikes_available") == [("1", 4)]
    assert store.facts().count() == store.archive().count() == 2


def test_a_first_batch_without_rows_publishes_empty_tables(refresh):
    store = refresh(0)
    assert store.current() and store.holds("run", 0)
    assert store.gold("latest_station_status").count() == 0


def test_an_empty_batch_folds_in_what_was_cut_short(refresh, facts):
    store = refresh(0, reading("1", 0, 3, 3))
    lost = facts([reading("1", 5, 4, 1)]).withColumn("batch_id", F.lit(7).cast("bigint"))
    store.append_facts(lost, "lost", 7)
    refresh(1)
    assert store.holds("lost", 7) and store.holds("run", 1)
    assert rows(store.gold("latest_station_status"), "station_id", "bikes_available") == [("1", 4)]


def test_small_ranges_of_ranks_are_one_file(spark, facts):
    latest = facts([reading(str(n), 0, n, 40 - n) for n in range(20)])
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        scratch = fresh_dir(spark, "ranks")
        ranked = ranking.dense_rank_global(
            latest, ranking.UTILIZATION_ORDER, "place", scratch=scratch
        )
        assert sorted(place for (place,) in ranked.select("place").collect()) == [*range(1, 21)]
        assert spark.read.parquet(scratch).select("_range").distinct().count() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
