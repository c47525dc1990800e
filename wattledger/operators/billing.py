"""Daily household energy and its price."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattledger.functions.energy import (
    billed_units, energy_charge, export_credit, percent, subsidy, surplus,
)
from wattledger.operators.clean import household_solar_median
from wattledger.schemas import (
    BILL_COLUMNS, ENERGY, MONEY, PERCENT, RATE, TIER_BLOCKS,
)


def household_energy(flagged: DataFrame) -> DataFrame:
    """Energy position per day, household and zone, missing solar imputed.

    The fill is a constant per household and day, so it is added to the sums
    (count of gaps times the median) rather than joined to every reading. Both
    aggregates start from the same columns and filters, so a lazy input is
    de-duplicated once and its exchange reused.
    """
    ok = F.col("billable")
    flagged = flagged.filter(F.col("sim_date").isNotNull() & F.col("household_id").isNotNull())
    sums = flagged.groupBy("sim_date", "household_id", "grid_zone").agg(
        F.sum("consumption_kwh").cast(ENERGY).alias("gross_consumption_kwh"),
        F.sum("solar_measured_kwh").cast(ENERGY).alias("measured"),
        F.count_if(ok & F.col("solar_measured_kwh").isNull()).alias("gaps"),
        F.count_if(ok).alias("reading_count"),
        F.count_if(~ok).alias("rejected_reading_count"),
    ).filter(F.col("reading_count") > 0)
    medians = household_solar_median(flagged)
    joined = sums.alias("s").join(
        medians.alias("m"),
        (F.col("s.sim_date") == F.col("m.sim_date"))
        & (F.col("s.household_id") == F.col("m.household_id"))
        & F.col("s.grid_zone").eqNullSafe(F.col("m.grid_zone")),
        "left",
    )
    zero = F.lit(0).cast(ENERGY)
    fill = F.coalesce(F.col("median_solar_kwh"), zero) * F.col("gaps").cast("decimal(12,0)")
    gross, solar = F.col("gross_consumption_kwh"), F.col("solar_generation_kwh")
    return (
        joined.select(
            "s.sim_date", "s.household_id", "s.grid_zone", "gross_consumption_kwh",
            (F.coalesce("measured", zero) + fill).cast(ENERGY).alias("solar_generation_kwh"),
            "reading_count", "rejected_reading_count",
        )
        .withColumns(
            {
                "self_consumed_kwh": F.least(gross, solar),
                "net_import_kwh": surplus(gross, solar),
                "exported_kwh": surplus(solar, gross),
            }
        )
        .withColumn("self_sufficiency_pct", percent(F.col("self_consumed_kwh"), gross, PERCENT))
    )


def tier_blocks(spark: SparkSession) -> DataFrame:
    """The constant tier schedule as a literal relation of four rows."""
    rows = F.array(
        *[
            F.struct(
                F.lit(tier).alias("billing_tier"),
                F.lit(cap1).cast("decimal(6,1)").alias("block1_cap"),
                F.lit(cap2).cast("decimal(6,1)").alias("block2_cap"),
                F.lit(mult2).cast("decimal(4,2)").alias("block2_mult"),
                F.lit(mult3).cast("decimal(4,2)").alias("block3_mult"),
            )
            for tier, cap1, cap2, mult2, mult3 in TIER_BLOCKS
        ]
    )
    return spark.range(1).select(F.inline(rows))


def price(energy: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Left-join the tariffs and price each household-day, unrounded.

    A household without a tariff stays visible with a null bill. Tariffs hold one row
    per household (and day, if they carry ``sim_date``); they grow with the estate, so
    the join strategy is left to run-time statistics. Only the four-row tier schedule
    is broadcast.
    """
    keys = [k for k in ("sim_date", "household_id") if k in tariffs.columns]
    priced = energy.join(tariffs, keys, "left").join(
        F.broadcast(tier_blocks(energy.sparkSession)), "billing_tier", "left"
    )
    return (
        priced.withColumn("billed_units_kwh", billed_units(F.col("net_import_kwh")))
        .withColumn("energy_charge", energy_charge(F.col("billed_units_kwh")))
        .withColumn("export_credit", export_credit(F.col("exported_kwh")))
        .withColumn("subsidy_amount", subsidy(F.col("energy_charge")))
        .withColumn(
            "total_bill",
            F.col("energy_charge") - F.col("export_credit")
            + F.col("standing_charge") - F.col("subsidy_amount"),
        )
        .drop("block1_cap", "block2_cap", "block2_mult", "block3_mult")
    )


def bill_table(priced: DataFrame) -> DataFrame:
    """Priced rows in the rounded output types of the settled bill."""
    rows = priced.filter(F.col("total_bill").isNotNull())
    money = ("energy_charge", "export_credit", "standing_charge", "subsidy_amount", "total_bill")
    return rows.withColumns(
        {
            "sim_day": F.col("sim_date"),
            "subsidy_flag": F.coalesce("subsidy_flag", F.lit(False)),
            "tariff_rate": F.col("tariff_rate").cast(RATE),
            "export_rate": F.col("export_rate").cast(RATE),
            **{c: F.col(c).cast(MONEY) for c in money},
        }
    ).select(*BILL_COLUMNS)


def tariff_coverage(priced: DataFrame) -> DataFrame:
    """Per day: household-days billed, without a tariff, and with an unknown tier."""
    no_tariff = F.col("tariff_rate").isNull()
    return priced.groupBy("sim_date").agg(
        F.count(F.lit(1)).alias("household_days"),
        F.count_if(no_tariff).alias("missing_tariff"),
        F.count_if(~no_tariff & F.col("total_bill").isNull()).alias("unknown_tier"),
    )


def unpriced(priced: DataFrame) -> DataFrame:
    """Household-days that cannot be billed, with the energy left unbilled."""
    return priced.filter(F.col("total_bill").isNull()).select(
        "sim_date", "household_id", "grid_zone", "gross_consumption_kwh", "net_import_kwh"
    )
