"""Streaming queries of the catalog: the event table replayed through the live queries.

Each query drains its source with the ``availableNow`` trigger into fresh directories
of the shared folder and returns what a reader of the live tables sees afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattledger.operators import parse
from wattledger.schemas import ARCHIVE
from wattledger.session import scratch_path
from wattledger.sources import meter_tables as mt
from wattledger.sources.messages import read_file_messages
from wattledger.streaming import changes, queries

# Restart points of the replay with restarts, at noon, so that a household's day is
# continued by the run after the restart.
RESTARTS = (datetime(2024, 1, 10, 12), datetime(2024, 1, 20, 12))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream. A glob, since a stream's base path may not be a file."""
    schema = mt.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def parsed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_messages(mt.messages(event_stream(spark, sf_dir)))


def _newest(spark: SparkSession, root: str, keys, order=()) -> DataFrame:
    log = spark.read.parquet(f"{root}/changes")
    schema = log.drop("batch_id").schema
    return changes.newest(changes.read_changes(spark, root, schema), keys, order)


def stream_zone_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-zone")
    queries.start_zone_load(
        parsed_stream(spark, sf_dir), f"{root}/zone", f"{root}/alerts", f"{root}/checkpoint", None
    ).awaitTermination()
    # Active meters are a sketch on a stream and are compared in the tests only.
    return _newest(spark, f"{root}/zone", queries.ZONE_KEY).drop(
        "active_meters", "last_seen", "updated_at", "batch_id"
    )


def stream_zone_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-alerts")
    queries.start_zone_load(
        parsed_stream(spark, sf_dir), f"{root}/zone", f"{root}/alerts", f"{root}/checkpoint", None
    ).awaitTermination()
    return _newest(spark, f"{root}/alerts", queries.ZONE_ALERT_KEY).drop("created_at", "batch_id")


def stream_household_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-household")
    queries.start_household_running(
        parsed_stream(spark, sf_dir), f"{root}/household", f"{root}/alerts", f"{root}/checkpoint",
        None,
    ).awaitTermination()
    return _newest(spark, f"{root}/household", queries.HOUSEHOLD_KEY, ("last_seen",)).drop(
        "updated_at", "batch_id"
    )


def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archive holds per day, refused readings and unreadable days included."""
    root = scratch_path(spark, "stream-archive")
    queries.start_archive(
        parsed_stream(spark, sf_dir), f"{root}/meter_readings", f"{root}/checkpoint", None
    ).awaitTermination()
    return (
        spark.read.schema(ARCHIVE)
        .parquet(f"{root}/meter_readings")
        .groupBy("sim_date", "reject_reason")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.count("payload").alias("payloads_kept"),
            F.max("kafka_offset").alias("last_offset"),
        )
    )


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-dead-letters")
    queries.start_dead_letters(
        parsed_stream(spark, sf_dir), f"{root}/checkpoint", None, "parquet", path=f"{root}/out"
    ).awaitTermination()
    fields = "event_id string, household_id string, reject_reason string, kafka_offset bigint"
    return (
        spark.read.schema("key string, value string")
        .parquet(f"{root}/out")
        .select("key", F.inline(F.array(F.from_json("value", fields))))
    )


def _land_in_pieces(events: DataFrame, path: str, late: Column | None = None) -> Iterator[int]:
    """Append the events as messages, piece by piece in time order.

    ``late`` events come with the piece after their own, if there is one.
    """
    piece = F.lit(0)
    for bound in RESTARTS:
        piece = piece + (F.col("ts") >= F.lit(bound).cast("timestamp_ntz")).cast("int")
    if late is not None:
        piece = F.least(piece + late.cast("int"), F.lit(len(RESTARTS)))
    for i in range(len(RESTARTS) + 1):
        mt.messages(events.filter(piece == i)).write.mode("append").parquet(path)
        yield i


def stream_upsert_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals over three runs of one checkpoint; the newest change wins.

    Messages land in time order before each run. Days cut by a restart are continued
    from the stored state and written again by the later run.
    """
    root = scratch_path(spark, "stream-restarted")
    landing = f"{root}/messages"
    for _ in _land_in_pieces(mt.table(spark, sf_dir, "events"), landing):
        parsed = parse.parse_messages(read_file_messages(spark, landing))
        queries.start_household_running(
            parsed, f"{root}/household", f"{root}/alerts", f"{root}/checkpoint", None
        ).awaitTermination()
    return _newest(spark, f"{root}/household", queries.HOUSEHOLD_KEY, ("last_seen",)).drop(
        "updated_at", "batch_id"
    )


def _zone_replay(spark: SparkSession, sf_dir: str, label: str, late: Column | None = None, **options) -> str:
    """The root of the live zone tables after three runs of one checkpoint."""
    root = scratch_path(spark, label)
    landing = f"{root}/messages"
    for _ in _land_in_pieces(mt.table(spark, sf_dir, "events"), landing, late):
        queries.start_zone_load(
            parse.parse_messages(read_file_messages(spark, landing)), f"{root}/zone", f"{root}/alerts",
            f"{root}/checkpoint", None, **options,
        ).awaitTermination()
    return root


def stream_zone_silent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones that were absent from windows that have closed, over three runs."""
    root = _zone_replay(spark, sf_dir, "stream-silent", zones=mt.dim_household(spark, sf_dir))
    raised = _newest(spark, f"{root}/alerts", queries.ZONE_ALERT_KEY)
    return raised.filter(F.col("alert_type") == "ZONE_SILENT").drop("created_at", "batch_id")


def stream_late_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone windows if every fifth event comes a piece late: those whose window is still open
    count, the others are left to the settlement."""
    root = _zone_replay(spark, sf_dir, "stream-late", late=F.col("event_id") % 5 == 3)
    return _newest(spark, f"{root}/zone", queries.ZONE_KEY).drop(
        "active_meters", "last_seen", "updated_at", "batch_id"
    )


STREAM_QUERIES = {
    f.__name__: f
    for f in (
        stream_zone_window, stream_zone_alerts, stream_household_day, stream_archive,
        stream_dead_letters, stream_upsert_restarted, stream_zone_silent, stream_late_readings,
    )
}
