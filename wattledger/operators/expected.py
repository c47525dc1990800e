"""Measured energy against the expected daily curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattledger.functions.curves import demand_factor, solar_factor
from wattledger.operators.zones import installed_capacity
from wattledger.schemas import ENERGY, TOTAL_ENERGY


def solar_against_curve(cleaned: DataFrame, weather: DataFrame, dim: DataFrame) -> DataFrame:
    """Measured solar by zone, day and hour beside capacity times the solar curve.

    Readings are summed to zone-hours before weather and capacity are joined. Without a
    forecast or capacity the expectation is null and the measured energy stays.
    """
    measured = cleaned.groupBy("sim_date", "grid_zone", F.hour("event_time").alias("hour")).agg(
        F.coalesce(F.sum("solar_measured_kwh"), F.lit(0)).cast(TOTAL_ENERGY).alias("measured_kwh"),
        F.count("solar_measured_kwh").alias("readings"),
    )
    factor = solar_factor(F.col("hour").cast("double"), F.col("cloud_cover_pct"))
    return (
        measured.join(weather, ["sim_date", "grid_zone"], "left")
        .join(installed_capacity(dim), "grid_zone", "left")
        .withColumn("solar_factor", factor)
        .withColumn("expected_kwh", F.col("capacity_kw").cast("double") * factor)
        .select(
            "sim_date", "grid_zone", "hour", "measured_kwh", "readings", "solar_factor",
            "expected_kwh",
        )
    )


def demand_against_curve(cleaned: DataFrame, dim: DataFrame) -> DataFrame:
    """Household consumption by hour beside base load times the demand curve.

    A household that the dimension lacks has a null expectation.
    """
    hourly = cleaned.groupBy("sim_date", "household_id", F.hour("event_time").alias("hour")).agg(
        F.sum("consumption_kwh").cast(ENERGY).alias("measured_kwh")
    )
    factor = demand_factor(F.col("hour").cast("double"))
    expected = F.col("base_load_kw").cast("double") * factor
    return hourly.join(dim.select("household_id", "base_load_kw"), "household_id", "left").select(
        "sim_date", "household_id", "hour", "measured_kwh",
        expected.alias("expected_kwh"),
        (F.col("measured_kwh").cast("double") - expected).alias("deviation_kwh"),
    )
