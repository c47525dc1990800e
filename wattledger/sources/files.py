"""Batch readers: archive, daily files, dimension, and which days exist."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattledger.schemas import ARCHIVE, INDEX, MONEY, RATE, TARIFF_FILE, WEATHER_FILE


def _of_days(df: DataFrame, first_day, last_day) -> DataFrame:
    """Keep a range of days; on a partition column this prunes directories."""
    if first_day is not None:
        df = df.filter(F.col("sim_date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        df = df.filter(F.col("sim_date") <= F.lit(last_day).cast("date"))
    return df


def read_archive(spark: SparkSession, path: str, first_day=None, last_day=None) -> DataFrame:
    """Archived readings, rejected ones included, of one day or a range of days."""
    return _of_days(spark.read.schema(ARCHIVE).parquet(path), first_day, last_day)


def _read_daily_csv(
    spark: SparkSession, path: str, columns: T.StructType, first_day, last_day
) -> DataFrame:
    # The header is checked against the declared columns instead of being inferred, so
    # a file with reordered columns fails instead of shifting values.
    schema = T.StructType([*columns.fields, T.StructField("sim_date", T.DateType())])
    df = spark.read.schema(schema).options(header=True, enforceSchema=False).csv(path)
    return _of_days(df, first_day, last_day)


def read_tariffs(spark: SparkSession, path: str, first_day=None, last_day=None) -> DataFrame:
    """Tariffs per day and household. A number that cannot be read becomes null."""
    raw = _read_daily_csv(spark, path, TARIFF_FILE, first_day, last_day)
    return raw.select(
        "sim_date", "household_id", "billing_tier",
        F.col("tariff_rate").try_cast(RATE).alias("tariff_rate"),
        F.col("standing_charge").try_cast(MONEY).alias("standing_charge"),
        F.col("export_rate").try_cast(RATE).alias("export_rate"),
        (F.lower("subsidy_flag") == "true").alias("subsidy_flag"),
    )


def read_weather(spark: SparkSession, path: str, first_day=None, last_day=None) -> DataFrame:
    """Forecasts per day and zone."""
    raw = _read_daily_csv(spark, path, WEATHER_FILE, first_day, last_day)
    return raw.select(
        "sim_date", "grid_zone",
        F.col("cloud_cover_pct").try_cast("double").alias("cloud_cover_pct"),
        F.col("expected_solar_index").try_cast(INDEX).alias("expected_solar_index"),
        F.col("temperature_c").try_cast("double").alias("temperature_c"),
    )


def read_dim_household(spark: SparkSession, fmt: str = "parquet", **options: str) -> DataFrame:
    """The household dimension from any batch format, e.g. ``fmt="jdbc"``.

    A JDBC source is read by one task unless ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` are given among the options.
    """
    return spark.read.format(fmt).options(**options).load().withColumn(
        "solar_capacity_kw", F.col("solar_capacity_kw").cast("decimal(8,2)")
    )


def partition_days(
    spark: SparkSession, path: str, marker: str | None = None, key: str = "sim_date"
) -> DataFrame:
    """Days with a ``sim_date=`` directory, or only those holding the marker file.

    Reads directory names only: one entry per day, never the data files.
    """
    pattern = f"{path.rstrip('/')}/{key}=*" + (f"/{marker}" if marker else "")
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = glob.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [str(status.getPath()) for status in fs.globStatus(glob) or []]
    names = [m.group(1) for p in found if (m := re.search(key + r"=(\d{4}-\d{2}-\d{2})", p))]
    return spark.createDataFrame([(d,) for d in names], "day string").select(
        F.col("day").cast("date").alias("sim_date")
    )


def write_times(spark: SparkSession, path: str) -> DataFrame:
    """(last_write) of every Parquet file below a folder; no row of them is read.

    A folder that doesn't exist yet has no files.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "last_write timestamp")
    listing = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet")
    return listing.load(path).select(F.col("modificationTime").alias("last_write"))
