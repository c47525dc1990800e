"""The merged view and the read queries on top of the live and settled tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattledger.operators.ranking import rank_by_amount
from wattledger.schemas import MONEY, TOTAL_ENERGY, WIDE_PERCENT
from wattledger.functions.energy import percent

# The columns of the report.
REPORT_COLUMNS = (
    "sim_day", "grid_zone", "household_id", "billing_tier", "subsidy_flag",
    "gross_consumption_kwh", "solar_generation_kwh", "net_import_kwh", "exported_kwh",
    "self_sufficiency_pct", "tariff_rate", "energy_charge", "export_credit",
    "subsidy_amount", "standing_charge", "total_bill",
)


def household_daily(bills: DataFrame, running: DataFrame) -> DataFrame:
    """Settled row where there is one, live estimate elsewhere.

    Filters on day, zone or household applied to the result are pushed into both
    branches by the optimizer.
    """
    settled = bills.select(
        "sim_day", "household_id", "grid_zone",
        F.col("gross_consumption_kwh").alias("consumption_kwh"),
        F.col("solar_generation_kwh").alias("solar_kwh"),
        "net_import_kwh", "total_bill", "reading_count",
        F.lit("batch").alias("source"), F.lit(True).alias("is_final"),
        F.col("computed_at").alias("as_of"),
    )
    estimated = running.join(
        bills.select("sim_day", "household_id"), ["sim_day", "household_id"], "left_anti"
    ).select(
        "sim_day", "household_id", "grid_zone", "consumption_kwh", "solar_kwh", "net_import_kwh",
        F.lit(None).cast(MONEY).alias("total_bill"), "reading_count",
        F.lit("speed").alias("source"), F.lit(False).alias("is_final"),
        F.col("last_seen").alias("as_of"),
    )
    return settled.unionByName(estimated)


def _limited(df: DataFrame, *order: Column, limit: int, at_most: int) -> DataFrame:
    if not 1 <= limit <= at_most:
        raise ValueError(f"limit must be between 1 and {at_most}, got {limit}")
    return df.orderBy(*order).limit(limit)


def households(
    merged: DataFrame, sim_day=None, grid_zone: str | None = None, limit: int = 200
) -> DataFrame:
    """Merged rows by day and consumption, largest first; household breaks ties."""
    if sim_day is not None:
        merged = merged.filter(F.col("sim_day") == F.lit(sim_day))
    if grid_zone is not None:
        merged = merged.filter(F.col("grid_zone") == grid_zone)
    return _limited(
        merged, F.col("sim_day").desc(), F.col("consumption_kwh").desc(), F.col("household_id"),
        limit=limit, at_most=1000,
    )


def source_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


def household_history(
    merged: DataFrame, dim: DataFrame, household_id: str, days: int = 7
) -> DataFrame:
    """A household of the dimension with its last days; known but silent gives one row."""
    history = _limited(
        merged.filter(F.col("household_id") == household_id).drop("grid_zone"),
        F.col("sim_day").desc(), limit=days, at_most=60,
    )
    return dim.filter(F.col("household_id") == household_id).join(history, "household_id", "left")


def zone_latest(zone_load: DataFrame, completed_before: Column | None = None) -> DataFrame:
    """Newest window of each zone, optionally only windows already closed.

    The group limit of ``row_number() = 1`` runs before the shuffle too, so a few zones
    with long histories stay cheap.
    """
    if completed_before is not None:
        zone_load = zone_load.filter(F.col("window_end") <= completed_before)
    newest = Window.partitionBy("grid_zone").orderBy(F.col("window_start").desc())
    return (
        zone_load.withColumn("place", F.row_number().over(newest))
        .filter(F.col("place") == 1)
        .drop("place")
    )


def grid_total(latest: DataFrame) -> DataFrame:
    """The whole grid over each zone's newest window."""
    load, solar = F.col("load_kwh"), F.col("solar_kwh")
    return latest.agg(
        F.sum("total_consumption_kwh").cast(TOTAL_ENERGY).alias("load_kwh"),
        F.sum("total_solar_kwh").cast(TOTAL_ENERGY).alias("solar_kwh"),
        F.sum("active_meters").alias("active_meters"),
        F.count(F.lit(1)).alias("zones_reporting"),
        F.max("window_end").alias("as_of"),
    ).withColumn("renewable_pct", percent(solar, load, WIDE_PERCENT))


def zone_history(zone_load: DataFrame, grid_zone: str, windows: int = 24) -> DataFrame:
    return _limited(
        zone_load.filter(F.col("grid_zone") == grid_zone),
        F.col("window_start").desc(), limit=windows, at_most=500,
    )


def recent_alerts(alerts: DataFrame, severity: str | None = None, limit: int = 50) -> DataFrame:
    if severity is not None:
        alerts = alerts.filter(F.col("severity") == severity)
    return _limited(
        alerts, F.col("created_at").desc(), F.col("alert_type"), F.col("entity_id"),
        limit=limit, at_most=500,
    )


def alert_summary(alerts: DataFrame, now: Column, minutes: int = 15) -> DataFrame:
    """Alerts by kind in the last minutes, busiest first."""
    since = now - F.expr(f"INTERVAL {minutes} MINUTES")
    return (
        alerts.filter(F.col("created_at") > since)
        .groupBy("alert_type", "severity")
        .agg(F.count(F.lit(1)).alias("alerts"))
        .orderBy(F.col("alerts").desc(), "alert_type")
    )


def billing_report(bills: DataFrame) -> DataFrame:
    """All bill lines with the rank of the bill within its day."""
    return rank_by_amount(bills.select(*REPORT_COLUMNS), "sim_day", "total_bill", "bill_rank").select(
        *REPORT_COLUMNS, "bill_rank"
    )


def highest_bills(report: DataFrame, sim_day, limit: int = 200) -> DataFrame:
    return _limited(
        report.filter(F.col("sim_day") == F.lit(sim_day)),
        F.col("total_bill").desc(), F.col("household_id"), limit=limit, at_most=1000,
    )


def zones_of_day(zone_daily: DataFrame, sim_day) -> DataFrame:
    return zone_daily.filter(F.col("sim_day") == F.lit(sim_day)).orderBy("grid_zone")


def report_kpis(bills: DataFrame) -> DataFrame:
    """Per day over all of its bills: households, energy, solar share and revenue."""
    return (
        bills.groupBy("sim_day")
        .agg(
            F.count(F.lit(1)).alias("households_billed"),
            F.sum("gross_consumption_kwh").cast(TOTAL_ENERGY).alias("consumption_kwh"),
            F.sum("solar_generation_kwh").cast(TOTAL_ENERGY).alias("solar_kwh"),
            F.sum("total_bill").alias("revenue"),
        )
        .withColumn(
            "renewable_pct", percent(F.col("solar_kwh"), F.col("consumption_kwh"), WIDE_PERCENT)
        )
    )


def recent_runs(runs: DataFrame, limit: int = 25) -> DataFrame:
    return _limited(
        runs, F.col("started_at").desc(), F.col("run_id"), limit=limit, at_most=200
    )


def recent_checks(checks: DataFrame, limit: int = 50) -> DataFrame:
    return _limited(
        checks, F.col("recorded_at").desc(), F.col("check_name"), limit=limit, at_most=500
    )
