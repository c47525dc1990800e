"""Every query by name, over meter-shaped views of a table directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattledger.operators import (
    alerts, billing, clean, days, expected, live, parse, quality, serving, zones,
)
from wattledger.plans.installation import INSTALLATION_QUERIES
from wattledger.plans.reconcile import FLAGGED_COLUMNS, priced_households
from wattledger.plans.replay import STREAM_QUERIES
from wattledger.schemas import RUN_LAYERS, RUN_STATUSES, SEVERITIES, Limits
from wattledger.session import pin_utc, settle
from wattledger.sources import meter_tables as mt

Query = Callable[[SparkSession, str], DataFrame]

# The clock of all queries that look back from "now".
NOW = "2024-01-30 22:30:00"
# Settled so far; later days are known from the live tables only.
SETTLED_BEFORE = "2024-01-20"
DETAIL_DAY = "2024-01-15"
DETAIL_ZONE = "ZONE-EAST"
DETAIL_HOUSEHOLD = "HH-00007"
# The test tables hold few readings per zone and hour.
TABLE_LIMITS = Limits(zone_overload_kwh=30.0)


def _now() -> Column:
    return F.lit(NOW).cast("timestamp")


def _readings(spark, sf):
    return mt.readings(spark, sf)


def _priced(spark, sf):
    return priced_households(_readings(spark, sf), mt.tariffs(spark, sf))


def _bills(spark, sf):
    settled_at = F.col("sim_day").cast("timestamp") + F.expr("INTERVAL 30 HOURS")
    return billing.bill_table(_priced(spark, sf)).withColumn("computed_at", settled_at)


def _settled_bills(spark, sf):
    return _bills(spark, sf).filter(F.col("sim_day") < F.lit(SETTLED_BEFORE).cast("date"))


def _zone_load(spark, sf):
    return live.zone_load(_readings(spark, sf))


def _running(spark, sf):
    return live.household_running(_readings(spark, sf))


def _merged(spark, sf):
    return serving.household_daily(_settled_bills(spark, sf), _running(spark, sf))


def _zone_daily(spark, sf, day: str | None = None):
    """Zone rows of all days, or of one; then only its readings are cleaned and stored."""
    readings = _readings(spark, sf)
    if day:
        readings = readings.filter(F.col("sim_date") == F.lit(day).cast("date"))
    # Three branches need the cleaned rows, so they are stored once.
    flagged = settle(clean.flag_clean(readings).select(*FLAGGED_COLUMNS), "flagged")
    priced = billing.price(billing.household_energy(flagged), mt.tariffs(spark, sf))
    return zones.zone_daily(
        flagged, priced, mt.weather(spark, sf), mt.active_households(spark, sf)
    )


def _checks(spark, sf):
    """Check rows of one run per day, recorded six hours after the day."""
    readings = _readings(spark, sf)
    # De-duplicated and stored once: statistics and coverage both start from these rows.
    flagged = settle(clean.flag_clean(readings).select(*FLAGGED_COLUMNS), "flagged")
    priced = billing.price(billing.household_energy(flagged), mt.tariffs(spark, sf))
    stats = clean.stats_of(flagged, clean.delivered(readings))
    rows = quality.dq_rows(stats, billing.tariff_coverage(priced))
    return rows.filter(F.col("sim_day").isNotNull()).withColumns(
        {
            "run_id": F.concat(F.lit("batch-"), F.col("sim_day").cast("string")),
            "recorded_at": F.col("sim_day").cast("timestamp") + F.expr("INTERVAL 30 HOURS"),
        }
    )


def _runs(spark, sf):
    """One audit row per day; a day that loses over a sixth of its readings failed."""
    stats = clean.clean_stats(_readings(spark, sf)).filter(F.col("sim_date").isNotNull())
    lost = F.col("rejected") * 6 > F.col("records_read")
    return stats.select(
        F.concat(F.lit("batch-"), F.col("sim_date").cast("string")).alias("run_id"),
        F.lit("batch").alias("layer"),
        F.lit("billing_reconciliation").alias("job_name"),
        F.col("sim_date").alias("sim_day"),
        F.when(lost, "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("records_read").alias("records_in"),
        F.col("records_valid").alias("records_out"),
        (F.col("sim_date").cast("timestamp") + F.expr("INTERVAL 30 HOURS")).alias("started_at"),
    )


def _once(spark, sf):
    """The readings that count live, de-duplicated and stored once for all live aggregates."""
    return settle(live.counted_once(_readings(spark, sf)).select(*live.COUNTED_COLUMNS), "live")


def _zone_load_of(once):
    return live.zone_load_rows(live.zone_window_sums(live.in_windows(once)))


def _silent_alerts(spark, sf, once):
    return alerts.silent_zone_alerts(
        _zone_load_of(once), mt.dim_household(spark, sf), days=live.meter_days(live.in_windows(once))
    )


def _alerts(spark, sf):
    once = _once(spark, sf)
    running = live.household_totals(live.in_windows(once, live.DAY))
    return alerts.all_alerts(
        alerts.zone_alerts(_zone_load_of(once), TABLE_LIMITS),
        alerts.spike_alerts(running, TABLE_LIMITS),
        _silent_alerts(spark, sf, once),
    )


def _alert_log(spark, sf):
    """Alerts with the time they were raised: an hour after their window or reading."""
    return _alerts(spark, sf).withColumn(
        "created_at", F.col("window_start") + F.expr("INTERVAL 1 HOUR")
    )


def _event_days(spark, sf):
    return _readings(spark, sf).filter(F.col("event_time").isNotNull()).select("sim_date").distinct()


def readings_parsed(spark, sf):
    parsed = parse.parse_messages(
        mt.messages(mt.table(spark, sf, "events")), now=F.lit("2024-02-01").cast("timestamp")
    )
    return parsed.select(
        "kafka_partition", "kafka_offset", "event_id", "meter_id", "household_id", "grid_zone",
        "consumption_kwh", "solar_kwh", "voltage", "event_time", "sim_date", "reject_reason",
        "is_valid", "voltage_suspect", "solar_missing",
        "ingest_lag_s",
    )


def reading_validation(spark, sf):
    return parse.reject_counts(_readings(spark, sf))


def solar_out_of_range(spark, sf):
    """Every 97th event claims a solar value no column can hold."""
    solar = F.col("solar_generation_kwh")
    broken = F.when(F.col("kafka_offset") % 97 == 0, solar * 1e12).otherwise(solar)
    return parse.solar_range_counts(_readings(spark, sf).withColumn("solar_generation_kwh", broken))


def dead_letter(spark, sf):
    parsed = parse.parse_messages(mt.messages(mt.table(spark, sf, "events")))
    return parse.dead_letters(parsed).drop("payload")


def clean_stats(spark, sf):
    return clean.clean_stats(_readings(spark, sf))


def readings_deduplicated(spark, sf):
    return clean.deduplicate(_readings(spark, sf)).select(
        "event_id", "sim_date", "household_id", "kafka_partition", "kafka_offset", "reject_reason"
    )


def dq_metrics(spark, sf):
    return _checks(spark, sf)


def solar_imputed(spark, sf):
    cleaned = clean.clean(_readings(spark, sf)).select(
        "event_id", "sim_date", "household_id", "consumption_kwh", "solar_measured_kwh"
    )
    return clean.impute_solar(settle(cleaned, "cleaned"))


def household_energy(spark, sf):
    return billing.household_energy(clean.flag_clean(_readings(spark, sf)))


def household_bill(spark, sf):
    return billing.bill_table(_priced(spark, sf))


def unpriced_households(spark, sf):
    return billing.unpriced(_priced(spark, sf))


def tariff_coverage(spark, sf):
    return billing.tariff_coverage(_priced(spark, sf))


def hourly_zone_load(spark, sf):
    return zones.hourly_zone_load(clean.clean(_readings(spark, sf)))


def zone_peak_hour(spark, sf):
    return zones.peak_hour(hourly_zone_load(spark, sf))


def clear_sky_potential(spark, sf):
    return zones.installed_capacity(mt.dim_household(spark, sf)).select(
        "grid_zone", F.col("capacity_kw").alias("zone_capacity_kw"),
        zones.cloudless_yield(F.col("capacity_kw")).alias("clear_sky_kwh"),
    )


def zone_daily(spark, sf):
    return _zone_daily(spark, sf)


def solar_forecast_error(spark, sf):
    return _zone_daily(spark, sf).select(
        "sim_day", "grid_zone", "forecast_solar_index", "actual_solar_index",
        "solar_forecast_error_pct",
    )


def live_zone_window(spark, sf):
    return _zone_load(spark, sf)


def live_zone_window_approx(spark, sf):
    """Active meters by sketch, as the streaming form counts them, held against the count.

    The sketch's relative deviation is 5 %; four of them, and two meters, are allowed.
    """
    live_rows = live.live_readings(_readings(spark, sf))
    exact, sketch = F.count_distinct("meter_id"), F.approx_count_distinct("meter_id")
    return live_rows.groupBy("w", "grid_zone").agg(
        exact.alias("active_meters"), (F.abs(sketch - exact) <= 0.2 * exact + 2).alias("within_bound")
    ).select("grid_zone", F.col("w.start").alias("window_start"), "active_meters", "within_bound")


def live_household_day(spark, sf):
    return _running(spark, sf)


def duplicate_scaled_zone_window(spark, sf):
    return live.duplicate_scaled_zone_load(_readings(spark, sf))


def alerts_low_renewable(spark, sf):
    return alerts.low_renewable_alerts(_zone_load(spark, sf), TABLE_LIMITS)


def alerts_overload(spark, sf):
    return alerts.overload_alerts(_zone_load(spark, sf), TABLE_LIMITS)


def alerts_spike(spark, sf):
    return alerts.spike_alerts(_running(spark, sf), TABLE_LIMITS)


def alerts_zone_silent(spark, sf):
    return _silent_alerts(spark, sf, _once(spark, sf))


def alerts_all(spark, sf):
    return _alerts(spark, sf)


def alert_summary(spark, sf):
    return serving.alert_summary(_alert_log(spark, sf), _now(), minutes=360)


def alerts_recent(spark, sf):
    return serving.recent_alerts(_alert_log(spark, sf), severity="CRITICAL", limit=50)


def household_daily_merged(spark, sf):
    return _merged(spark, sf)


def merged_source_counts(spark, sf):
    return serving.source_counts(_merged(spark, sf))


def merged_households_top(spark, sf):
    return serving.households(_merged(spark, sf), grid_zone=DETAIL_ZONE, limit=200)


def household_history(spark, sf):
    return serving.household_history(
        _merged(spark, sf), mt.dim_household(spark, sf), DETAIL_HOUSEHOLD, days=14
    )


def zone_latest(spark, sf):
    return serving.zone_latest(_zone_load(spark, sf))


def zone_latest_completed(spark, sf):
    return serving.zone_latest(_zone_load(spark, sf), completed_before=_now())


def grid_total(spark, sf):
    return serving.grid_total(serving.zone_latest(_zone_load(spark, sf)))


def zone_history(spark, sf):
    return serving.zone_history(_zone_load(spark, sf), DETAIL_ZONE, windows=48)


def billing_report_ranked(spark, sf):
    return serving.billing_report(household_bill(spark, sf))


def billing_top(spark, sf):
    """A rank counts the bills of its day only, so only that day is priced and ranked."""
    day = F.lit(DETAIL_DAY).cast("date")
    readings = _readings(spark, sf).filter(F.col("sim_date") == day)
    bills = billing.bill_table(priced_households(readings, mt.tariffs(spark, sf)))
    return serving.highest_bills(serving.billing_report(bills), day, limit=50)


def report_kpis(spark, sf):
    return serving.report_kpis(household_bill(spark, sf))


def zones_of_day(spark, sf):
    day = F.lit(DETAIL_DAY).cast("date")
    return serving.zones_of_day(_zone_daily(spark, sf, DETAIL_DAY), day)


def pending_days(spark, sf):
    """A day is billed once a household with a tariff has a reading that counts; no bill is
    priced to tell."""
    settled = _readings(spark, sf).filter(F.col("sim_date") < F.lit(SETTLED_BEFORE).cast("date"))
    billed = clean.clean(settled).join(mt.tariffs(spark, sf), "household_id", "left_semi")
    return days.pending_days(
        mt.published_days(spark, sf), _event_days(spark, sf), billed.select("sim_date").distinct()
    )


def next_pending_day(spark, sf):
    return days.next_day(pending_days(spark, sf))


def complete_days(spark, sf):
    return days.complete_days(mt.published_days(spark, sf))


def coverage_gate(spark, sf):
    """The day after each published one is asked for too; the last is not billed yet."""
    households = mt.active_households(spark, sf).agg(F.count(F.lit(1))).scalar()
    known = mt.published_days(spark, sf).select(F.col("sim_date").alias("sim_day"))
    asked = known.union(known.select(F.date_add("sim_day", 1))).distinct()
    return quality.coverage_gate(household_bill(spark, sf), households, days=asked)


def freshness_status(spark, sf):
    return quality.freshness_status(
        quality.freshness(
            _now(),
            rt_zone_load=(_zone_load(spark, sf), "window_end"),
            rt_household_running=(_running(spark, sf), "last_seen"),
            batch_household_bill=(_settled_bills(spark, sf), "computed_at"),
        )
    )


def backlog_status(spark, sf):
    return quality.backlog_status(
        _running(spark, sf), _settled_bills(spark, sf), _runs(spark, sf),
        F.lit("2024-01-20").cast("timestamp"),
    )


def quality_status(spark, sf):
    return quality.quality_status(_checks(spark, sf), _now(), minutes=7 * 24 * 60)


def latest_dq_checks(spark, sf):
    """A corrected second run of every day supersedes the first."""
    first = _checks(spark, sf)
    second = first.withColumns(
        {
            "run_id": F.concat("run_id", F.lit("-2")),
            "recorded_at": F.col("recorded_at") + F.expr("INTERVAL 1 HOUR"),
            "passed": F.col("passed") + F.col("failed"),
            "failed": F.lit(0).cast("bigint"),
        }
    )
    return quality.latest_checks(first.unionByName(second)).select(
        "sim_day", "check_name", "run_id", "passed", "failed"
    )


def recent_runs(spark, sf):
    return serving.recent_runs(_runs(spark, sf), limit=25)


def recent_checks(spark, sf):
    return serving.recent_checks(_checks(spark, sf), limit=50)


def constraint_violations(spark, sf):
    """The declared rules of a raw reading, violated on purpose by the faulty events."""
    return quality.constraint_violations(
        _readings(spark, sf).withColumn(
            "severity", F.when(F.col("is_valid"), "INFO").otherwise(F.col("reject_reason"))
        ),
        not_null=("event_id", "household_id", "grid_zone", "power_consumption_kwh"),
        allowed={"severity": SEVERITIES},
        unique=("event_id",),
    )


def run_constraints(spark, sf):
    return quality.constraint_violations(
        _runs(spark, sf),
        not_null=("run_id", "job_name", "started_at"),
        allowed={"layer": RUN_LAYERS, "status": RUN_STATUSES},
        unique=("run_id",),
    )


def zone_conflicts(spark, sf):
    """Households reporting from two zones; here a household moves with its voltage."""
    moved = _readings(spark, sf).withColumn(
        "grid_zone",
        F.when(F.col("voltage_suspect"), F.lit("ZONE-NORTH")).otherwise(F.col("grid_zone")),
    )
    return quality.zone_conflicts(clean.clean(moved))


def expected_solar_by_hour(spark, sf):
    return expected.solar_against_curve(
        clean.clean(_readings(spark, sf)), mt.weather(spark, sf), mt.active_households(spark, sf)
    )


def expected_demand_deviation(spark, sf):
    return expected.demand_against_curve(
        clean.clean(_readings(spark, sf)), mt.dim_household(spark, sf)
    )


BATCH_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        household_bill, readings_parsed, reading_validation, solar_out_of_range, dead_letter, readings_deduplicated,
        clean_stats, dq_metrics, solar_imputed, household_energy, unpriced_households,
        tariff_coverage, hourly_zone_load, zone_peak_hour, clear_sky_potential, zone_daily,
        solar_forecast_error, zones_of_day, live_zone_window, live_zone_window_approx,
        live_household_day, duplicate_scaled_zone_window, alerts_low_renewable, alerts_overload,
        alerts_spike, alerts_zone_silent, alerts_all, alert_summary, alerts_recent,
        household_daily_merged, merged_source_counts, merged_households_top, household_history,
        zone_latest, zone_latest_completed, grid_total, zone_history, billing_report_ranked,
        billing_top, report_kpis, complete_days, pending_days, next_pending_day, coverage_gate,
        freshness_status, backlog_status, quality_status, latest_dq_checks, recent_runs,
        recent_checks, constraint_violations, run_constraints, zone_conflicts,
        expected_solar_by_hour, expected_demand_deviation,
    )
}


def presented(query: Query) -> Query:
    """Exact decimals leave as doubles and instants as zone-less timestamps."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(pin_utc(spark), sf_dir)
        plain = []
        for name, dtype in df.dtypes:
            target = {"timestamp": "timestamp_ntz"}.get(dtype)
            if dtype.startswith("decimal"):
                target = "double"
            plain.append(F.col(name).cast(target).alias(name) if target else F.col(name))
        return df.select(*plain)

    return run


def catalog() -> dict[str, Query]:
    return {n: presented(q) for n, q in {**BATCH_QUERIES, **STREAM_QUERIES, **INSTALLATION_QUERIES}.items()}
