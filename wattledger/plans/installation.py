"""Queries of a whole installation: the event tables as archive and files, settled by the job.

Each query lays out an installation in the shared folder (archive by day, tariff and
weather files with their markers, the dimension), settles the days up to a date, lets a
second run of the same days fail at its gate after it has written all its tables, and
returns what readers see then: the first run.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattledger.operators import quality, serving
from wattledger.plans import reconcile, replay, tables
from wattledger.plans.reconcile import Layout
from wattledger.schemas import ARCHIVE, Limits
from wattledger.session import scratch_path, together
from wattledger.sources import files, meter_tables as mt
from wattledger.streaming import queries

LAST_DAY = date(2024, 1, 19)
RUN, REFUSED_RUN = "settle-1", "settle-2"
#: The second run takes half of the plausible readings for faults, and no coverage suffices.
OTHER_LIMITS = Limits(max_plausible_kwh=6.0, min_coverage_pct=101.0)


def archive_rows(readings: DataFrame) -> DataFrame:
    """Readings in the columns and types of the archive."""
    have = set(readings.columns)
    return readings.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ARCHIVE.fields
        ]
    )


def daily_tariffs(tariffs: DataFrame, days: list[date]) -> DataFrame:
    """The tariffs as text, once per day.

    They are a small file of one or two splits and become many times as many rows: the few are
    spread over all tasks, in order, and written out as text before they are repeated.
    """
    columns = (
        "household_id", "tariff_rate", "billing_tier", "subsidy_flag", "standing_charge", "export_rate",
    )
    tasks = int(tariffs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = tariffs.select(*[F.col(c).cast("string").alias(c) for c in columns]).repartitionByRange(tasks, "household_id")
    return text.select("*", F.explode(F.array([F.lit(d) for d in days])).alias("sim_date"))


def laid_out(spark: SparkSession, sf_dir: str) -> Layout:
    """An installation with all readings archived and the published days marked."""
    layout = Layout(scratch_path(spark, "installation"))
    archive = archive_rows(mt.readings(spark, sf_dir)).hint("rebalance", "sim_date")
    # One row per day; the same tariffs are published each day.
    days = mt.table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct().collect()
    tariffs = daily_tariffs(mt.tariffs(spark, sf_dir), [r.d for r in days])
    weather = mt.weather(spark, sf_dir).select(
        "grid_zone", F.col("sim_date").cast("string").alias("forecast_date"), "cloud_cover_pct",
        "expected_solar_index", F.lit(20.0).alias("temperature_c"), "sim_date",
    )
    published = [r.sim_date for r in mt.published_days(spark, sf_dir).collect()]  # one row per day
    together(
        spark,
        lambda: tables.publish_days(tariffs, weather, layout.root, published),
        lambda: archive.write.partitionBy("sim_date").parquet(layout.meter_readings),
        lambda: tables.refresh_dimension(mt.active_households(spark, sf_dir), layout.dim_household),
    )
    return layout


def settled(spark: SparkSession, sf_dir: str) -> Layout:
    """The installation after one run that counts and one that was refused."""
    layout = laid_out(spark, sf_dir)
    first = files.partition_days(spark, layout.meter_readings).agg(F.min("sim_date")).first()[0]
    days = reconcile._days(first, LAST_DAY)
    reconcile.settle_days(spark, layout, first, LAST_DAY, run_id=RUN)
    gate = reconcile.coverage_at_least(spark, layout, days, OTHER_LIMITS)
    try:
        reconcile.settle_days(
            spark, layout, first, LAST_DAY, run_id=REFUSED_RUN, limits=OTHER_LIMITS, gate=gate
        )
    except ValueError:
        return layout
    raise AssertionError("the second run was to be refused")


def settled_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    bills = reconcile.settled(spark, settled(spark, sf_dir), "batch_household_bill")
    return bills.drop("computed_at")


def settled_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = reconcile.settled(spark, settled(spark, sf_dir), "batch_zone_daily")
    return zones.drop("computed_at")


def settled_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.settled_checks(spark, settled(spark, sf_dir)).drop("recorded_at")


def settled_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of both runs; the refused one has an error."""
    audit = spark.read.parquet(settled(spark, sf_dir).ops_pipeline_runs)
    return quality.latest_runs(audit).select(
        "run_id", "layer", "job_name", "sim_day", "status", "records_in", "records_out",
        F.col("error").isNotNull().alias("has_error"),
    )


def pending_from_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days to be settled after the runs, from folder names and commits."""
    return reconcile.find_pending_days(spark, settled(spark, sf_dir))


def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranked report of all settled days, read back from its CSV files."""
    layout = settled(spark, sf_dir)
    first = files.partition_days(spark, layout.meter_readings).agg(F.min("sim_date")).first()[0]
    reconcile.publish_report(spark, layout, first, LAST_DAY)
    texts = {"grid_zone", "household_id", "billing_tier"}
    kinds = {"sim_day": T.DateType(), "subsidy_flag": T.BooleanType(), "bill_rank": T.LongType()}
    fields = [
        T.StructField(c, T.StringType() if c in texts else kinds.get(c, T.DoubleType()))
        for c in (*serving.REPORT_COLUMNS, "bill_rank")
        if c != "sim_day"
    ]
    schema = T.StructType([*fields, T.StructField("sim_day", T.DateType())])
    return spark.read.schema(schema).options(header=True, enforceSchema=False).csv(layout.reports)


def _live_tables(spark: SparkSession, sf_dir: str, layout: Layout) -> None:
    """Zone load and household totals, drained from the event stream into their change logs."""
    for start, table in (
        (queries.start_zone_load, layout.rt_zone_load),
        (queries.start_household_running, layout.rt_household_running),
    ):
        parsed = replay.parsed_stream(spark, sf_dir)
        start(parsed, table, f"{table}_alerts", f"{layout.root}/checkpoints", None).awaitTermination()


def merged_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged view read from stored tables: committed bills, live totals elsewhere."""
    layout = settled(spark, sf_dir)
    _live_tables(spark, sf_dir, layout)
    merged = serving.household_daily(
        reconcile.settled(spark, layout, "batch_household_bill"), reconcile.running(spark, layout)
    )
    return merged.drop("as_of")


def freshness_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness by the time at which files were written, a minute and ten minutes later."""
    layout = settled(spark, sf_dir)
    _live_tables(spark, sf_dir, layout)
    newest = reconcile.last_writes(spark, layout).agg(F.max("last_write")).first()[0]
    after = lambda minutes: quality.freshness_status(
        reconcile.last_writes(spark, layout, F.lit(newest) + F.expr(f"INTERVAL {minutes} MINUTES"))
    )
    later = after(10).select(F.col("table_name").alias("t"), F.col("is_stale").alias("is_stale_later"))
    return after(1).join(later, F.col("table_name") == F.col("t")).select(
        "table_name", F.col("last_write").isNotNull().alias("has_files"), "is_stale", "is_stale_later"
    )


INSTALLATION_QUERIES = {
    f.__name__: f
    for f in (
        settled_bills, settled_zones, settled_checks, settled_runs, pending_from_folders, report_csv,
        merged_from_tables, freshness_from_files,
    )
}
