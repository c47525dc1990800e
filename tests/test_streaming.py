"""Streams against the batch form: duplicates, lateness, restarts and replays."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattledger.operators import live, parse
from wattledger.schemas import ARCHIVE, MESSAGE
from wattledger.session import use_rocksdb_state
from wattledger.sources.messages import read_file_messages
from wattledger.streaming import changes, queries
from wattledger.streaming.progress import PROGRESS, ProgressLog

START = datetime(2024, 1, 1)


def reading(i, minute, kwh=1.0, zone="Z1", household="h1", **other):
    at = START + timedelta(minutes=minute)
    return {
        "event_id": f"e{i}", "meter_id": f"m-{household}", "household_id": household,
        "grid_zone": zone, "power_consumption_kwh": kwh, "solar_generation_kwh": 0.25,
        "voltage": 230.0, "timestamp": at.isoformat(), "ingest_ts": at.timestamp(), **other,
    }


class Feed:
    """Lands message files one micro-batch at a time and drains them."""

    def __init__(self, spark, root):
        self.spark, self.root, self.offset = spark, root, 0
        self.landing = f"{root}/messages"

    def land(self, payloads):
        rows = []
        for p in payloads:
            self.offset += 1
            text = p if isinstance(p, str) else json.dumps(p)
            rows.append((0, self.offset, START, text))
        self.spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(self.landing)

    def parsed(self):
        return parse.parse_messages(read_file_messages(self.spark, self.landing))

    def all_messages(self):
        return parse.parse_messages(self.spark.read.schema(MESSAGE).parquet(self.landing))

    def zones(self):
        queries.start_zone_load(
            self.parsed(), f"{self.root}/zone", f"{self.root}/zone_alerts", f"{self.root}/cp", None
        ).awaitTermination()
        return self.newest("zone", queries.ZONE_KEY)

    def households(self):
        queries.start_household_running(
            self.parsed(), f"{self.root}/hh", f"{self.root}/hh_alerts", f"{self.root}/cp", None
        ).awaitTermination()
        return self.newest("hh", queries.HOUSEHOLD_KEY)

    def newest(self, table, keys):
        root = f"{self.root}/{table}"
        schema = self.spark.read.parquet(f"{root}/changes").drop("batch_id").schema
        return changes.newest(changes.read_changes(self.spark, root, schema), keys)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def zone_values(df):
    return {
        (r.grid_zone, r.window_start): (r.total_consumption_kwh, r.total_solar_kwh, r.reading_count)
        for r in df.collect()
    }


def test_duplicates_across_micro_batches_count_once(feed):
    """Six micro-batches in time order, each repeating events of the one before."""
    for b in range(6):
        fresh = [reading(b * 10 + i, b * 20 + i, 0.5 + i / 10, f"Z{i % 2}") for i in range(10)]
        again = [] if b == 0 else [
            reading((b - 1) * 10 + i, (b - 1) * 20 + i, 0.5 + i / 10, f"Z{i % 2}") for i in (7, 8, 9)
        ]
        feed.land(fresh + fresh[:2] + again)
        got = feed.zones()
    want = live.zone_load(feed.all_messages())
    assert zone_values(got) == zone_values(want)
    assert sum(v[2] for v in zone_values(got).values()) == 60


def test_late_inside_the_watermark_updates_its_window_outside_is_left_to_batch(feed):
    feed.land([reading(1, 30), reading(2, 65)])
    feed.zones()
    feed.land([reading(3, 51)])  # 14 minutes late: still counted
    assert zone_values(feed.zones())[("Z1", START)][2] == 2
    feed.land([reading(4, 300)])
    feed.zones()
    feed.land([reading(5, 301)])
    feed.zones()
    feed.land([reading(6, 10)])  # hours late
    live_view = zone_values(feed.zones())
    exact = zone_values(live.zone_load(feed.all_messages()))
    assert live_view[("Z1", START)][2] == 2
    assert exact[("Z1", START)][2] == 3


def test_late_reading_of_an_open_window_counts_once(feed):
    feed.land([reading(1, 51)])
    feed.zones()
    feed.land([reading(2, 55)])
    feed.zones()
    feed.land([reading(3, 10), reading(1, 51)])  # 45 minutes late, and a repeat
    assert zone_values(feed.zones())[("Z1", START)][2] == 3


def test_household_day_survives_restarts_and_keeps_newest(feed):
    for b in range(3):
        feed.land([reading(100 * b + i, 60 * b + i, 1.0, household=f"h{i % 3}") for i in range(9)])
        got = feed.households()
    want = live.household_running(feed.all_messages())
    cols = ["household_id", "sim_day", "consumption_kwh", "reading_count", "last_seen"]
    assert Counter(got.select(cols).collect()) == Counter(want.select(cols).collect())
    assert got.select("reading_count").distinct().first()[0] == 9


def test_state_in_rocksdb_gives_the_same_view(spark, feed):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    use_rocksdb_state(spark)
    try:
        for b in range(2):
            feed.land([reading(10 * b + i, 20 * b + i, 0.5) for i in range(8)] + [reading(1, 1, 0.5)])
            got = feed.zones()
    finally:
        spark.conf.set(key, before)
    assert zone_values(got) == zone_values(live.zone_load(feed.all_messages()))


def test_spike_alert_is_kept_once_per_household_and_day(feed):
    for b in range(3):
        feed.land([reading(b * 10 + i, b * 10 + i, 9.0) for i in range(3)])
        feed.households()
    log = feed.spark.read.parquet(f"{feed.root}/hh_alerts/changes")
    assert log.count() == 3  # raised by every micro-batch
    (row,) = feed.newest("hh_alerts", queries.HOUSEHOLD_ALERT_KEY).collect()
    assert (row.entity_id, row.metric_value) == ("h1", 9)


def test_replaying_a_micro_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    schema = "k string, v int"
    changes.write_changes(spark.createDataFrame([("a", 1), ("b", 1)], schema), root, 0)
    for _ in range(2):
        changes.write_changes(spark.createDataFrame([("a", 2)], schema), root, 1)
    rows = spark.createDataFrame([], schema)
    log = changes.read_changes(spark, root, rows.schema)
    assert log.count() == 3
    assert {r.k: r.v for r in changes.newest(log, ("k",)).collect()} == {"a": 2, "b": 1}


def test_compaction_keeps_the_newest_rows_and_accepts_later_batches(spark, tmp_path):
    old, new = f"{tmp_path}/old", f"{tmp_path}/new"
    schema = spark.createDataFrame([], "k string, v int").schema
    for b in range(5):
        rows = [("a", b), (f"only{b}", b)]
        changes.write_changes(spark.createDataFrame(rows, schema), old, b)
    changes.compact(spark, old, new, schema, ("k",), upto_batch=3)
    log = changes.read_changes(spark, new, schema)
    assert log.count() == 5  # one row per key
    changes.write_changes(spark.createDataFrame([("a", 4), ("only4", 4)], schema), new, 4)
    view = lambda root: {
        r.k: r.v for r in changes.newest(changes.read_changes(spark, root, schema), ("k",)).collect()
    }
    assert view(new) == view(old)


def test_archive_keeps_everything_and_prunes_by_day(spark, feed):
    feed.land([reading(1, 5), reading(2, 24 * 60 + 5), "not json", reading(3, 6, kwh=-1.0)])
    queries.start_archive(feed.parsed(), f"{feed.root}/raw", f"{feed.root}/cp", None).awaitTermination()
    archive = spark.read.schema(ARCHIVE).parquet(f"{feed.root}/raw")
    assert archive.count() == 4
    kept = {r.reject_reason: r.payload for r in archive.collect()}
    assert kept[None] is None and kept["UNPARSEABLE"] == "not json"
    assert archive.filter(F.col("sim_date").isNull()).count() == 1
    day = archive.filter(F.col("sim_date") == "2024-01-01")
    assert "PartitionFilters: [isnotnull(sim_date" in day._jdf.queryExecution().executedPlan().toString()


def test_all_four_queries_run_side_by_side(spark, feed):
    feed.land([reading(i, i, household=f"h{i}") for i in range(5)] + ["broken"])
    started = queries.start_all(feed.parsed(), feed.root, base_seconds=None)
    for query in started:
        query.awaitTermination()
    assert {q.name for q in started} == {"raw_archive", "zone_load", "household_running", "dead_letters"}
    assert spark.read.parquet(f"{feed.root}/meter_readings").count() == 6
    assert spark.read.parquet(f"{feed.root}/dead_letters").count() == 1
    assert spark.read.parquet(f"{feed.root}/rt_household_running/changes").count() == 5


def test_processing_time_trigger_and_stop(spark, feed):
    feed.land([reading(1, 1)])
    query = queries.start_archive(feed.parsed(), f"{feed.root}/raw", f"{feed.root}/cp", 1)
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{feed.root}/raw").count() == 1


def test_progress_log(spark, feed):
    log = ProgressLog(spark, f"{feed.root}/progress")
    spark.streams.addListener(log)
    try:
        feed.land([reading(1, 1), reading(2, 2)])
        queries.start_archive(
            feed.parsed(), f"{feed.root}/raw", f"{feed.root}/cp", None
        ).awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
        log.flush()
    rows = spark.read.schema(PROGRESS).parquet(f"{feed.root}/progress").collect()
    assert sum(r.input_rows or 0 for r in rows if r.query == "raw_archive") == 2
    assert {"started", "progress"} <= {r.event for r in rows}


def test_streaming_meters_are_close_to_exact(feed):
    feed.land([reading(i, i % 60, household=f"h{i}") for i in range(400)])
    (row,) = feed.zones().collect()
    assert row.active_meters == pytest.approx(400, rel=0.15)
