"""The four continuous queries over the parsed stream.

Each query reads and parses the source by itself and has its own checkpoint, so one
failing sink does not hold back the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wattledger.operators import alerts, live
from wattledger.operators.parse import dead_letter_messages
from wattledger.schemas import ARCHIVE, LIMITS, Limits
from wattledger.streaming.changes import read_changes, write_changes
from wattledger.streaming.closing import advance

BASE_TRIGGER_SECONDS = 10


def _start(
    writer: DataStreamWriter, name: str, checkpoint: str, seconds: int | None
) -> StreamingQuery:
    """Start on a processing-time trigger, or drain the source and stop if none."""
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return (
        writer.queryName(name)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
        .trigger(**trigger)
        .start()
    )


def archive_rows(parsed: DataFrame) -> DataFrame:
    """Every reading as received; the payload is kept where the reading was refused."""
    return parsed.withColumn(
        "payload", F.when(~F.col("is_valid"), F.col("payload"))
    ).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in ARCHIVE.fields]
    )


def start_archive(
    parsed: DataFrame, path: str, checkpoint: str, seconds: int | None = 3 * BASE_TRIGGER_SECONDS
) -> StreamingQuery:
    writer = (
        archive_rows(parsed)
        .writeStream.format("parquet")
        .option("path", path)
        .partitionBy("sim_date")
        .outputMode("append")
    )
    return _start(writer, "raw_archive", checkpoint, seconds)


def start_dead_letters(
    parsed: DataFrame,
    checkpoint: str,
    seconds: int | None = BASE_TRIGGER_SECONDS,
    fmt: str = "kafka",
    **options: str,
) -> StreamingQuery:
    """Refused readings to a topic, or to files with the same key and value columns."""
    writer = (
        dead_letter_messages(parsed).writeStream.format(fmt).options(**options).outputMode("append")
    )
    return _start(writer, "dead_letters", checkpoint, seconds)


def start_zone_load(
    parsed: DataFrame,
    zone_root: str,
    alert_root: str,
    checkpoint: str,
    seconds: int | None = BASE_TRIGGER_SECONDS,
    width: str = live.WINDOW,
    lateness: str = live.LATENESS,
    limits: Limits = LIMITS,
    zones: DataFrame | None = None,
) -> StreamingQuery:
    """Live zone windows, in progress ones included, and their alerts.

    With ``zones`` (the household dimension) a zone that is absent from a window raises an
    alert as the window closes: an absence brings no row of its own, so what the watermark
    has passed is compared with the windows to be expected (``closing``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = live.zone_load_rows(batch, limits, "last_seen")
        stored = write_changes(rows.withColumn("updated_at", F.current_timestamp()), zone_root, batch_id)
        raised = alerts.zone_alerts(stored, limits)
        if zones is not None:
            closing = advance(stored, zone_root, batch_id, lateness)
            known = read_changes(stored.sparkSession, zone_root, stored.schema)
            if closing.since is not None:  # windows that closed before are not looked at again
                known = known.filter(F.col("window_end") > F.lit(closing.since))
            ends = closing.ends(stored.sparkSession, width)
            raised = raised.unionByName(alerts.silent_between(ends, known, zones, width))
        _write_alerts(raised, alert_root, batch_id)

    sums = live.zone_window_sums(live.live_readings(parsed, lateness, width))
    writer = sums.writeStream.foreachBatch(write).outputMode("update")
    return _start(writer, "zone_load", checkpoint, seconds)


def start_household_running(
    parsed: DataFrame,
    household_root: str,
    alert_root: str,
    checkpoint: str,
    seconds: int | None = 2 * BASE_TRIGGER_SECONDS,
    lateness: str = live.LATENESS,
    limits: Limits = LIMITS,
) -> StreamingQuery:
    """Running household-day totals and spike alerts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = write_changes(
            batch.withColumn("updated_at", F.current_timestamp()), household_root, batch_id
        )
        _write_alerts(alerts.spike_alerts(stored, limits), alert_root, batch_id)

    totals = live.household_totals(live.live_readings(parsed, lateness, live.DAY))
    writer = totals.writeStream.foreachBatch(write).outputMode("update")
    return _start(writer, "household_running", checkpoint, seconds)


def _write_alerts(raised: DataFrame, root: str, batch_id: int) -> None:
    write_changes(raised.withColumn("created_at", F.current_timestamp()), root, batch_id)


# Keys of the live tables. An alert repeated by a later batch replaces the earlier one:
# one per rule, zone and window, and one per rule, household and day.
ZONE_KEY = ("grid_zone", "window_start")
HOUSEHOLD_KEY = ("household_id", "sim_day")
ZONE_ALERT_KEY = ("alert_type", "entity_id", "window_start")
HOUSEHOLD_ALERT_KEY = ("alert_type", "entity_id", "sim_day")


def start_all(
    parsed: DataFrame,
    root: str,
    base_seconds: int | None = BASE_TRIGGER_SECONDS,
    dead_letter_format: str = "parquet",
    limits: Limits = LIMITS,
    zones: DataFrame | None = None,
    **dead_letter_options: str,
) -> list[StreamingQuery]:
    """Start all four queries under one root; alerts of zones and households apart.

    ``zones``, the household dimension, adds alerts of zones that fall silent.
    """
    root = root.rstrip("/")
    checkpoint = f"{root}/checkpoints"
    if dead_letter_format != "kafka":
        dead_letter_options = {"path": f"{root}/dead_letters", **dead_letter_options}

    def every(factor: int) -> int | None:
        return None if base_seconds is None else factor * base_seconds

    return [
        start_archive(parsed, f"{root}/meter_readings", checkpoint, every(3)),
        start_zone_load(
            parsed, f"{root}/rt_zone_load", f"{root}/rt_zone_alerts", checkpoint, every(1),
            limits=limits, zones=zones,
        ),
        start_household_running(
            parsed, f"{root}/rt_household_running", f"{root}/rt_household_alerts", checkpoint,
            every(2), limits=limits,
        ),
        start_dead_letters(
            parsed, checkpoint, every(1), dead_letter_format, **dead_letter_options
        ),
    ]


def await_any(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Return when the first query ends and stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
