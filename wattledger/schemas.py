"""Declared schemas, numeric types and business limits."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import types as T

# Numeric types. Energy and money are decimals so that sums do not depend on the
# order in which partitions arrive; ratios are rounded once, at the end. Scales are those
# of the data model; precisions are wide enough for one household holding a third of
# a very large archive, which would overflow a 14-digit total.
READING_SOLAR = "decimal(14,5)"
ENERGY = "decimal(18,5)"
TOTAL_ENERGY = "decimal(22,5)"  # zone and grid totals
VOLTAGE = "decimal(7,2)"
MONEY = "decimal(16,4)"
REVENUE = "decimal(20,4)"
RATE = "decimal(10,4)"
INDEX = "decimal(8,4)"
PERCENT = "decimal(6,2)"
WIDE_PERCENT = "decimal(12,2)"
UNITS = "decimal(20,7)"

# The tier schedule (tier, block-1 cap, block-2 cap, block-2
# multiplier, block-3 multiplier) and the subsidy share of the energy charge.
TIER_BLOCKS = (
    ("DOMESTIC_LOW", "6.0", "8.0", "1.25", "1.60"),
    ("DOMESTIC_STD", "10.0", "12.0", "1.30", "1.70"),
    ("DOMESTIC_HIGH", "14.0", "16.0", "1.35", "1.80"),
    ("COMMERCIAL", "30.0", "40.0", "1.15", "1.30"),
)
SUBSIDY_RATE = "0.20"

# Allowed codes.
SEVERITIES = ("INFO", "WARNING", "CRITICAL")
RUN_LAYERS = ("speed", "batch", "ingestion", "serving")
RUN_STATUSES = ("RUNNING", "SUCCESS", "FAILED")


@dataclass(frozen=True)
class Limits:
    """Thresholds of validation, alerting and health checks."""

    max_plausible_kwh: float = 12.0
    min_voltage: float = 200.0
    max_voltage: float = 255.0
    renewable_low_pct: float = 15.0
    zone_overload_kwh: float = 45.0
    spike_factor: float = 3.0
    renewable_cap_pct: str = "999.99"
    meter_silence_seconds: int = 90
    min_coverage_pct: float = 80.0
    max_backlog_days: int = 3
    max_failed_runs: int = 3
    max_reject_ratio: float = 0.25

    @property
    def freshness_budget_seconds(self) -> int:
        return 2 * self.meter_silence_seconds


    @property
    def reading_energy(self) -> str:
        """The type of a validated reading: it holds every value the rule admits.

        With the default limit it is narrow, and its sums stay in longs.
        """
        if not math.isfinite(self.max_plausible_kwh):
            return "decimal(38,5)"
        return f"decimal({min(38, max(8, len(str(int(self.max_plausible_kwh))) + 5))},5)"


LIMITS = Limits()

# The fields of messages, archive, files and output tables below.
READING = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("meter_id", T.StringType()),
        T.StructField("household_id", T.StringType()),
        T.StructField("grid_zone", T.StringType()),
        T.StructField("power_consumption_kwh", T.DoubleType()),
        T.StructField("solar_generation_kwh", T.DoubleType()),
        T.StructField("voltage", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("sim_day", T.StringType()),
        T.StructField("ingest_ts", T.DoubleType()),
        T.StructField("quality_flags", T.ArrayType(T.StringType())),
        T.StructField("producer_run_id", T.StringType()),
    ]
)

# The shape every message source delivers, whatever the transport.
MESSAGE = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.StringType()),
    ]
)

ARCHIVE = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("meter_id", T.StringType()),
        T.StructField("household_id", T.StringType()),
        T.StructField("grid_zone", T.StringType()),
        T.StructField("power_consumption_kwh", T.DoubleType()),
        T.StructField("solar_generation_kwh", T.DoubleType()),
        T.StructField("voltage", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("ingest_ts", T.DoubleType()),
        T.StructField("quality_flags", T.ArrayType(T.StringType())),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("is_valid", T.BooleanType()),
        # Kept for rejected rows only, so that an unreadable message can be repaired.
        T.StructField("payload", T.StringType()),
        T.StructField("sim_date", T.DateType()),
    ]
)

TARIFF_FILE = T.StructType(
    [
        T.StructField("household_id", T.StringType()),
        T.StructField("tariff_rate", T.StringType()),
        T.StructField("billing_tier", T.StringType()),
        T.StructField("subsidy_flag", T.StringType()),
        T.StructField("standing_charge", T.StringType()),
        T.StructField("export_rate", T.StringType()),
    ]
)

WEATHER_FILE = T.StructType(
    [
        T.StructField("grid_zone", T.StringType()),
        T.StructField("forecast_date", T.StringType()),
        T.StructField("cloud_cover_pct", T.StringType()),
        T.StructField("expected_solar_index", T.StringType()),
        T.StructField("temperature_c", T.StringType()),
    ]
)

ZONE_LOAD_COLUMNS = (
    "grid_zone", "window_start", "window_end", "sim_day",
    "total_consumption_kwh", "total_solar_kwh", "net_import_kwh",
    "renewable_pct", "active_meters", "avg_voltage", "reading_count",
)

HOUSEHOLD_RUNNING_COLUMNS = (
    "household_id", "sim_day", "grid_zone", "consumption_kwh",
    "solar_kwh", "net_import_kwh", "reading_count", "last_seen",
)

ALERT_COLUMNS = (
    "alert_type", "severity", "entity_type", "entity_id", "sim_day",
    "window_start", "metric_value", "threshold", "message",
)

BILL_COLUMNS = (
    "sim_day", "household_id", "grid_zone", "billing_tier", "subsidy_flag",
    "gross_consumption_kwh", "solar_generation_kwh", "self_consumed_kwh",
    "net_import_kwh", "exported_kwh", "tariff_rate", "export_rate",
    "energy_charge", "export_credit", "standing_charge", "subsidy_amount",
    "total_bill", "self_sufficiency_pct", "reading_count",
    "rejected_reading_count",
)

ZONE_DAILY_COLUMNS = (
    "sim_day", "grid_zone", "households", "households_priced",
    "total_consumption_kwh", "total_solar_kwh", "net_import_kwh",
    "renewable_contribution_pct", "peak_hour", "peak_load_kwh",
    "forecast_solar_index", "actual_solar_index", "solar_forecast_error_pct",
    "total_revenue",
)
