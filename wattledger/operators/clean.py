"""Exact de-duplication, cleaning statistics and solar imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wattledger.functions.validation import billable
from wattledger.schemas import LIMITS, READING_SOLAR, Limits

# Within a day the first delivered copy of an event wins. The id comes first: sorts
# compare its leading bytes and seldom have to look at the day.
EVENT_KEY = ("event_id", "sim_date")
DELIVERY_ORDER = ("kafka_offset", "kafka_partition")


def deduplicate(readings: DataFrame, key: tuple[str, ...] = EVENT_KEY) -> DataFrame:
    """One row per event, the first delivered. Rows without an event id are dropped.

    ``row_number() = 1`` is planned with a group limit on both sides of the
    exchange, so each map task sends at most one row per event: a key holding a third
    of all rows is thinned before it is shuffled.
    """
    first = Window.partitionBy(*key).orderBy(*DELIVERY_ORDER)
    return (
        readings.filter(F.col("event_id").isNotNull())
        .withColumn("delivery", F.row_number().over(first))
        .filter(F.col("delivery") == 1)
        .drop("delivery")
    )


def flag_clean(readings: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """De-duplicate, then mark the billable rows; only those carry energy values.

    Refused rows stay in, so that one aggregate yields both the energy and the number
    of refused readings.
    """
    ok = F.col("billable")
    return (
        deduplicate(readings)
        .withColumn("billable", billable(limits))
        .withColumns(
            {
                "consumption_kwh": F.when(
                    ok, F.col("power_consumption_kwh").cast(limits.reading_energy)
                ),
                "solar_measured_kwh": F.when(
                    ok, F.col("solar_generation_kwh").try_cast(READING_SOLAR)
                ),
            }
        )
    )


def clean(readings: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The de-duplicated, billable readings as exact decimals."""
    return flag_clean(readings, limits).filter(F.col("billable"))


def clean_stats(readings: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Per day: read, duplicates removed, rejected and valid, in one pass.

    The first level collapses the copies of an event on the map side, so neither a
    much-copied event nor the group of missing ids meets in one task.
    """
    arrival = F.struct(*DELIVERY_ORDER)
    per_event = readings.groupBy(*EVENT_KEY).agg(
        F.count(F.lit(1)).alias("copies"),
        F.min_by(billable(limits), arrival).alias("first_ok"),
    )
    has_id = F.col("event_id").isNotNull()
    none = F.lit(0).cast("bigint")
    return per_event.groupBy("sim_date").agg(
        F.sum("copies").alias("records_read"),
        F.sum(F.when(has_id, F.col("copies") - 1).otherwise(none)).alias("duplicates_removed"),
        F.sum(
            F.when(~has_id, F.col("copies"))
            .when(~F.col("first_ok"), F.lit(1).cast("bigint"))
            .otherwise(none)
        ).alias("rejected"),
        F.count_if(has_id & F.col("first_ok")).alias("records_valid"),
    )


def delivered(readings: DataFrame) -> DataFrame:
    """Per day: readings delivered, and those with an event id."""
    return readings.groupBy("sim_date").agg(
        F.count(F.lit(1)).alias("records_read"), F.count("event_id").alias("with_id")
    )


def stats_of(flagged: DataFrame, counts: DataFrame) -> DataFrame:
    """``clean_stats`` from rows that are de-duplicated already and the delivered counts."""
    kept = flagged.groupBy(F.col("sim_date").alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if("billable").alias("valid")
    )
    events, valid = (F.coalesce(F.col(c), F.lit(0)) for c in ("events", "valid"))
    return counts.join(kept, F.col("sim_date").eqNullSafe(F.col("day")), "left").select(
        "sim_date", "records_read",
        (F.col("with_id") - events).alias("duplicates_removed"),
        (F.col("records_read") - F.col("with_id") + events - valid).alias("rejected"),
        valid.alias("records_valid"),
    )


def household_solar_median(cleaned: DataFrame) -> DataFrame:
    """Median solar reading of each household and day, one row per zone it reported in.

    The exact lower median, whatever the number of readings: equal readings are counted
    where the rows are, and only the counts of distinct values are shuffled and summed up
    to the middle one.
    """
    key = ("sim_date", "household_id")
    value = F.col("solar_measured_kwh")
    counts = cleaned.groupBy(*key, "grid_zone", "solar_measured_kwh").agg(
        F.count("solar_measured_kwh").alias("n")
    )
    household = Window.partitionBy(*key)
    upto = F.sum("n").over(household.orderBy(value.asc_nulls_first()))
    middle = F.floor((F.sum("n").over(household) + 1) / F.lit(2))
    return (
        counts.withColumns({"upto": upto, "middle": middle})
        .groupBy(*key)
        .agg(
            F.min(F.when(F.col("upto") >= F.col("middle"), value)).alias("median_solar_kwh"),
            F.collect_set(F.struct("grid_zone")).alias("zones"),
        )
        .select(*key, "median_solar_kwh", F.inline("zones"))
    )


def impute_solar(cleaned: DataFrame) -> DataFrame:
    """Row-level imputation: measured value, else the household's median, else zero.

    Only the rows with a gap are joined; measured rows pass without a shuffle.
    ``cleaned`` is read three times and should be a stored or settled result.
    """
    gap = F.col("solar_measured_kwh").isNull()
    # No zones here: one row per household and day.
    measured_rows = cleaned.filter(~gap).withColumn("grid_zone", F.lit(None).cast("string"))
    medians = household_solar_median(measured_rows).drop("grid_zone")
    measured = cleaned.filter(~gap).withColumn("solar_kwh", F.col("solar_measured_kwh"))
    filled = (
        cleaned.filter(gap)
        .join(medians, ["sim_date", "household_id"], "left")
        .withColumn("solar_kwh", F.coalesce("median_solar_kwh", F.lit(0).cast(READING_SOLAR)))
        .drop("median_solar_kwh")
    )
    return measured.unionByName(filled)
