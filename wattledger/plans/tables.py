"""Settled and operational tables on plain Parquet, and the report export."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

AUDIT = (
    "run_id string, layer string, job_name string, sim_day date, status string, "
    "records_in bigint, records_out bigint, duration_s double, error string, "
    "recorded_at timestamp"
)


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def overwrite_days(
    rows: DataFrame, path: str, days: list[date], sort_by: tuple[str, ...] = ()
) -> None:
    """Replace whole days, so that running a day again corrects it.

    All days go out in one job: rows are rebalanced by day (large days are split, small
    ones do not become one file per task) and partitions are replaced dynamically. A
    requested day that has no rows any more is emptied as well.
    """
    spark = rows.sparkSession
    out = rows.filter(F.col("sim_day").isin(days)).hint("rebalance", "sim_day")
    if sort_by:
        out = out.sortWithinPartitions("sim_day", *sort_by)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("sim_day")
        .parquet(path)
    )
    # One row per requested day at most.
    produced = {r.sim_day for r in rows.select("sim_day").distinct().collect()}
    for day in days:
        if day not in produced:
            empty = spark.createDataFrame([], rows.drop("sim_day").schema)
            empty.write.mode("overwrite").parquet(f"{path}/sim_day={day.isoformat()}")


def audit_row(
    spark: SparkSession,
    run_id: str,
    job_name: str,
    status: str,
    sim_day: date | None = None,
    layer: str = "batch",
    records_in: int = 0,
    records_out: int = 0,
    duration_s: float | None = None,
    error: str | None = None,
) -> DataFrame:
    row = (
        run_id, layer, job_name, sim_day, status, records_in, records_out, duration_s,
        error, datetime.now(timezone.utc),
    )
    return spark.createDataFrame([row], AUDIT)


def refresh_dimension(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def publish_daily_files(tariffs: DataFrame, weather: DataFrame, root: str, day: date) -> None:
    """Write one day's files; the tariff directory's ``_SUCCESS`` comes last.

    Spark's committer writes the marker after all data files, and tariffs go out after
    weather, so a reader gated on the tariff marker sees both complete.
    """
    for name, rows in (("weather", weather), ("tariffs", tariffs)):
        rows.write.mode("overwrite").option("header", True).csv(
            f"{root.rstrip('/')}/{name}/sim_date={day.isoformat()}"
        )


def publish_days(
    tariffs: DataFrame, weather: DataFrame, root: str, days: list[date]
) -> None:
    """Write the files of many days in two jobs, both by ``sim_date``, then the markers.

    Only ``days`` are marked as complete, each after all files are there; days that were
    published before and are not among the rows stay as they are.
    """
    spark = tariffs.sparkSession
    for name, rows in (("weather", weather), ("tariffs", tariffs)):
        (
            rows.hint("rebalance", "sim_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("header", True)
            .partitionBy("sim_date")
            .csv(f"{root.rstrip('/')}/{name}")
        )
    for day in days:
        marker = spark._jvm.org.apache.hadoop.fs.Path(
            f"{root.rstrip('/')}/tariffs/sim_date={day.isoformat()}/_SUCCESS"
        )
        marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, True).close()


def export_report(report: DataFrame, path: str, days: list[date]) -> None:
    """Ranked bill lines as CSV per day, highest bill first within each file."""
    (
        report.filter(F.col("sim_day").isin(days))
        # The household breaks ties, so many equal amounts can be split as well.
        .repartitionByRange("sim_day", F.col("total_bill").desc(), "household_id")
        .sortWithinPartitions("sim_day", F.col("total_bill").desc(), "household_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("sim_day")
        .csv(path)
    )
