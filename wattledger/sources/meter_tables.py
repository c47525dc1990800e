"""Meter-shaped relations derived from general test tables.

``events`` become readings, ``customer`` becomes the tariff file and the household
dimension, and the days of the events become the weather file. The rules are plain
arithmetic, so that any SQL engine derives the same rows. Whole tables are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattledger.operators.parse import validate_readings
from wattledger.schemas import INDEX, MONEY, RATE, READING_SOLAR, VOLTAGE

# Zones by number and tiers with rate and standing charge.
ZONES = ("ZONE-NORTH", "ZONE-SOUTH", "ZONE-EAST", "ZONE-WEST", "ZONE-CENTRAL")
TIERS = (
    ("DOMESTIC_LOW", "0.14", "0.10"),
    ("DOMESTIC_STD", "0.21", "0.18"),
    ("DOMESTIC_HIGH", "0.28", "0.25"),
    ("COMMERCIAL", "0.33", "0.60"),
)
EXPORT_SHARE = "0.45"


def _by_number(number: Column, values: list) -> Column:
    """Pick a constant by number, inside code generation."""
    picked = F.when(number == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        picked = picked.when(number == i, value)
    return picked


def _padded(prefix: str, number: Column) -> Column:
    digits = number.cast("string")
    width = F.greatest(F.length(digits), F.lit(5))  # lpad would cut longer numbers
    return F.concat(F.lit(prefix), F.lpad(digits, width, F.lit("0")))


def zone_of(number: Column) -> Column:
    return _by_number(F.pmod(number, F.lit(len(ZONES))), [F.lit(z) for z in ZONES])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reading_rows(events: DataFrame) -> DataFrame:
    """Unvalidated readings; every 50th event is delivered twice, as a producer would."""
    # One integer field of a flat object: a pattern costs a fraction of a JSON parser here.
    k = F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1).try_cast("int")
    faulty = F.col("event_type") == "error"

    def fault(low: int, high: int) -> Column:
        return faulty & F.col("k").between(low, high)

    kwh = F.when(
        ~fault(0, 9),
        F.when(fault(10, 19), -F.col("value") / 10).otherwise(F.col("value") / 10),
    )
    # The generator keeps filters above it, so the parsed field and the converted energy
    # are computed once per delivery and not again inside every pushed-down condition.
    once = events.withColumn("k", k).select("*", kwh.cast(READING_SOLAR).alias("kwh"))
    first, second = (F.struct(F.lit(n).alias("copy"), "k", "kwh") for n in (0, 1))
    deliveries = F.when(F.col("event_id") % 50 == 0, F.array(first, second)).otherwise(
        F.array(first)
    )
    return (
        once.select(*events.columns, F.inline(deliveries))
        .select(
            F.when(~fault(30, 34), F.col("event_id").cast("string")).alias("event_id"),
            _padded("MTR-", F.col("user_id")).alias("meter_id"),
            F.when(~fault(20, 24), _padded("HH-", F.col("user_id"))).alias("household_id"),
            zone_of(F.col("user_id")).alias("grid_zone"),
            F.col("kwh").alias("power_consumption_kwh"),
            F.when(F.col("k") >= 5, F.col("k") * F.lit("0.04").cast("decimal(3,2)"))
            .cast(READING_SOLAR)
            .alias("solar_generation_kwh"),
            F.when(
                F.col("k") != 99, F.lit(230) + (F.col("k") - 50) * F.lit("0.7").cast("decimal(2,1)")
            )
            .cast(VOLTAGE)
            .alias("voltage"),
            F.when(~fault(25, 29), F.col("ts").cast("timestamp")).alias("event_time"),
            F.pmod("user_id", F.lit(6)).cast("int").alias("kafka_partition"),
            (F.col("event_id") * 2 + F.col("copy")).alias("kafka_offset"),
        )
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated readings, straight from the columnar table."""
    return validate_readings(reading_rows(table(spark, sf_dir, "events")))


def messages(events: DataFrame) -> DataFrame:
    """The same readings as transport messages; unreadable ones carry broken text."""
    rows = reading_rows(events).withColumns(
        {
            "timestamp": F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            "sim_day": F.date_format("event_time", "yyyy-MM-dd"),
            "ingest_ts": F.unix_micros("event_time") / 1_000_000,
        }
    )
    payload = F.to_json(
        F.struct(
            "event_id", "meter_id", "household_id", "grid_zone", "power_consumption_kwh",
            "solar_generation_kwh", "voltage", "timestamp", "sim_day", "ingest_ts",
        )
    )
    return rows.select(
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("event_time").alias("timestamp"),
        F.when(F.col("event_id").isNull(), F.lit("not json")).otherwise(payload).alias("value"),
    )


def tariffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tariff per customer in good standing; the others have none."""
    tier = F.pmod("c_custkey", F.lit(len(TIERS)))
    rate = _by_number(tier, [F.lit(r).cast(RATE) for _, r, _ in TIERS])
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") >= -500)
        .select(
            _padded("HH-", F.col("c_custkey")).alias("household_id"),
            _by_number(tier, [F.lit(t) for t, _, _ in TIERS]).alias("billing_tier"),
            rate.alias("tariff_rate"),
            _by_number(tier, [F.lit(s).cast(MONEY) for _, _, s in TIERS]).alias("standing_charge"),
            (rate * F.lit(EXPORT_SHARE).cast("decimal(3,2)")).cast(RATE).alias("export_rate"),
            ((tier == 0) & (F.col("c_custkey") % 10 < 7)).alias("subsidy_flag"),
        )
    )


def dim_household(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _padded("HH-", key).alias("household_id"),
        _padded("MTR-", key).alias("meter_id"),
        zone_of(key).alias("grid_zone"),
        (F.lit("0.25").cast("decimal(3,2)") + (key % 9) * F.lit("0.1").cast("decimal(2,1)"))
        .cast("decimal(8,3)")
        .alias("base_load_kw"),
        ((key % 10) * F.lit("0.6").cast("decimal(2,1)")).cast("decimal(8,2)").alias(
            "solar_capacity_kw"
        ),
        _by_number(F.pmod(key, F.lit(len(TIERS))), [F.lit(t) for t, _, _ in TIERS]).alias(
            "billing_tier"
        ),
    )


def active_households(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Households of the dimension that send events at all."""
    senders = table(spark, sf_dir, "events").select(
        _padded("HH-", F.col("user_id")).alias("household_id")
    )
    return dim_household(spark, sf_dir).join(senders, "household_id", "left_semi")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast per zone and day that occurs in the events."""
    day, zone_no = F.to_date("ts"), F.pmod("user_id", F.lit(len(ZONES)))
    return (
        table(spark, sf_dir, "events")
        .select(day.alias("sim_date"), zone_no.alias("zone_no"))
        .distinct()
        .withColumn(
            "cloud_cover_pct",
            (
                F.col("zone_no") * 7
                + F.datediff("sim_date", F.lit("2024-01-01").cast("date")) * 13
            ) % 80 + 5,
        )
        .select(
            "sim_date",
            zone_of(F.col("zone_no")).alias("grid_zone"),
            "cloud_cover_pct",
            (
                F.lit(1)
                - F.lit("0.75").cast("decimal(3,2)") * F.col("cloud_cover_pct").cast("decimal(5,0)") / 100
            )
            .cast(INDEX)
            .alias("expected_solar_index"),
        )
    )


def published_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with a tariff publication: every day of the events but each 11th."""
    day_no = F.datediff("sim_date", F.lit("2024-01-01").cast("date"))
    return (
        table(spark, sf_dir, "events")
        .select(F.to_date("ts").alias("sim_date"))
        .distinct()
        .filter(day_no % 11 != 10)
    )
