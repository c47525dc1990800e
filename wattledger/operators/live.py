"""Live aggregates as pure functions over batch or streaming readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattledger.functions.energy import percent, surplus
from wattledger.operators.clean import deduplicate
from wattledger.schemas import (
    ENERGY, HOUSEHOLD_RUNNING_COLUMNS, LIMITS, PERCENT, TOTAL_ENERGY, VOLTAGE, WIDE_PERCENT,
    ZONE_LOAD_COLUMNS, Limits,
)

WINDOW = "1 hour"
# Meters buffer readings for up to 15 minutes while offline.
LATENESS = "900 seconds"
DAY = "1 day"


def live_readings(parsed: DataFrame, lateness: str = LATENESS, width: str = WINDOW) -> DataFrame:
    """Valid readings with their window ``w``, each event counted once in its window.

    On a stream the ids of a window's events are remembered for as long as the window is
    open, so a late reading counts until then; one whose window has closed is left to the
    settlement. State is as large as the open windows and belongs in RocksDB. In batch
    the same rule is the exact de-duplication.
    """
    if not parsed.isStreaming:
        return in_windows(counted_once(parsed), width)
    valid = parsed.filter(F.col("is_valid")).withColumn("seen_at", F.col("event_time"))
    watched = valid.withWatermark("event_time", lateness)
    once = watched.withColumn("w", F.window("event_time", width)).dropDuplicates(["event_id", "w"])
    # Only the window carries the watermark from here on; a stream may have one such column.
    return once.drop("event_time")


#: What the live aggregates need of a reading.
COUNTED_COLUMNS = (
    "event_time", "sim_date", "meter_id", "household_id", "grid_zone", "consumption_kwh",
    "solar_kwh", "voltage", "voltage_suspect",
)


def counted_once(parsed: DataFrame) -> DataFrame:
    """The valid readings of a batch, each event once, whatever windows they are put into.

    Stored once (``settle``), the rows serve zone windows, household days and the days on
    which meters report.
    """
    return deduplicate(parsed.filter(F.col("is_valid")))


def in_windows(once: DataFrame, width: str = WINDOW) -> DataFrame:
    """``live_readings`` from rows that are counted once already."""
    return once.withColumns({"seen_at": F.col("event_time"), "w": F.window("event_time", width)})


def zone_window_sums(live: DataFrame) -> DataFrame:
    """Tumbling-window sums per zone.

    Every measure aggregates partially before the shuffle, so few zones do not mean
    few busy tasks. Exact distinct meters are possible in batch only.
    """
    meters = (
        F.approx_count_distinct("meter_id") if live.isStreaming else F.count_distinct("meter_id")
    )
    steady = F.when(~F.col("voltage_suspect"), F.col("voltage"))
    return (
        live.groupBy("w", "grid_zone")
        .agg(
            F.sum("consumption_kwh").cast(TOTAL_ENERGY).alias("consumption"),
            F.sum("solar_kwh").cast(TOTAL_ENERGY).alias("solar"),
            meters.alias("active_meters"),
            F.sum(steady).alias("volts"),
            F.count(steady).alias("volt_readings"),
            F.count(F.lit(1)).alias("reading_count"),
            F.max("seen_at").alias("last_seen"),
        )
        .select(
            "grid_zone",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            F.to_date(F.col("w.start")).alias("sim_day"),
            "consumption", "solar", "active_meters", "volts", "volt_readings", "reading_count",
            "last_seen",
        )
    )


def zone_load_rows(sums: DataFrame, limits: Limits = LIMITS, *extra: str) -> DataFrame:
    """Zone sums as rows of the live zone table, with ``extra`` columns of the sums."""
    cap = F.lit(limits.renewable_cap_pct).cast(WIDE_PERCENT)
    volts = F.col("volts") / F.col("volt_readings").cast("decimal(18,0)")
    return sums.withColumns(
        {
            "total_consumption_kwh": F.col("consumption"),
            "total_solar_kwh": F.col("solar"),
            "net_import_kwh": surplus(F.col("consumption"), F.col("solar"), TOTAL_ENERGY),
            "renewable_pct": F.least(
                percent(F.col("solar"), F.col("consumption"), WIDE_PERCENT), cap
            ).cast(PERCENT),
            "avg_voltage": F.when(F.col("volt_readings") > 0, volts).cast(VOLTAGE),
        }
    ).select(*ZONE_LOAD_COLUMNS, *extra)


def zone_load(parsed: DataFrame, width: str = WINDOW, limits: Limits = LIMITS) -> DataFrame:
    return zone_load_rows(zone_window_sums(live_readings(parsed, width=width)), limits)


def meter_days(live: DataFrame) -> DataFrame:
    """(first, last, vouched) of each day with readings: its windows, and whether two meters report.

    Meters differ if the least and the greatest id do; no set of ids is kept.
    """
    start = F.col("w.start")
    return live.groupBy(F.to_date(start).alias("day")).agg(
        F.min(start).alias("first"),
        F.max(start).alias("last"),
        F.coalesce(F.min("meter_id") < F.max("meter_id"), F.lit(False)).alias("vouched"),
    ).drop("day")


def duplicate_scaled_zone_load(parsed: DataFrame, width: str = WINDOW) -> DataFrame:
    """The approximate form: raw sums scaled by the share of distinct events.

    Kept for comparison with the exact view. The number of distinct events comes from
    a two-level count instead of one set of ids per zone and window.
    """
    valid = parsed.filter(F.col("is_valid"))
    per_event = valid.groupBy(F.window("event_time", width).alias("w"), "grid_zone", "event_id").agg(
        F.sum("consumption_kwh").alias("consumption"),
        F.sum("solar_kwh").alias("solar"),
        F.count(F.lit(1)).alias("copies"),
    )
    sums = per_event.groupBy("w", "grid_zone").agg(
        F.sum("consumption").cast(TOTAL_ENERGY).alias("raw_consumption"),
        F.sum("solar").cast(TOTAL_ENERGY).alias("raw_solar"),
        F.sum("copies").alias("copies"),
        F.count(F.lit(1)).alias("reading_count"),
    )
    distinct, copies = (F.col(c).cast("decimal(18,0)") for c in ("reading_count", "copies"))

    def scaled(value):
        return (value.cast(ENERGY) * distinct / copies).cast(TOTAL_ENERGY)

    raw_net = surplus(F.col("raw_consumption"), F.col("raw_solar"), TOTAL_ENERGY)
    return sums.select(
        "grid_zone",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        scaled(F.col("raw_consumption")).alias("total_consumption_kwh"),
        scaled(F.col("raw_solar")).alias("total_solar_kwh"),
        scaled(raw_net).alias("net_import_kwh"),
        percent(F.col("raw_solar"), F.col("raw_consumption"), WIDE_PERCENT).alias("renewable_pct"),
        "reading_count",
        (F.col("copies") - F.col("reading_count")).alias("duplicates"),
    )


def household_totals(live: DataFrame) -> DataFrame:
    """Running totals per household and zone in one-day windows, so state can expire."""
    day = live.groupBy("w", "household_id", "grid_zone").agg(
        F.sum("consumption_kwh").cast(ENERGY).alias("consumption_kwh"),
        F.sum("solar_kwh").cast(ENERGY).alias("solar_kwh"),
        F.count(F.lit(1)).alias("reading_count"),
        F.max("seen_at").alias("last_seen"),
    )
    return day.withColumns(
        {
            "sim_day": F.to_date(F.col("w.start")),
            "net_import_kwh": surplus(F.col("consumption_kwh"), F.col("solar_kwh")),
        }
    ).select(*HOUSEHOLD_RUNNING_COLUMNS)


def household_running(parsed: DataFrame) -> DataFrame:
    return household_totals(live_readings(parsed, width=DAY))
