"""The settlement job end to end on files: publish, archive, settle, report, re-run."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattledger.operators import quality
from wattledger.plans import reconcile, tables
from wattledger.plans.reconcile import Layout
from wattledger.schemas import ARCHIVE
from wattledger.session import Scratch
from wattledger.sources import files, meter_tables as mt

DAYS = [date(2024, 1, d) for d in (1, 2, 3)]


@pytest.fixture(scope="module")
def layout(spark, tables_dir, tmp_path_factory):
    """Three published days, two of them archived, from the smallest tables."""
    lay = Layout(str(tmp_path_factory.mktemp("installation")))
    readings = mt.readings(spark, tables_dir).filter(F.col("sim_date").isin(DAYS))
    missing = [f for f in ARCHIVE.fields if f.name not in readings.columns]
    archive = readings.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    archive.select(*[F.col(f.name).cast(f.dataType) for f in ARCHIVE.fields]).write.partitionBy(
        "sim_date"
    ).parquet(lay.meter_readings)
    weather = mt.weather(spark, tables_dir).withColumn("temperature_c", F.lit(20.0))
    for day in DAYS:
        tables.publish_daily_files(
            mt.tariffs(spark, tables_dir).select(
                "household_id", "tariff_rate", "billing_tier", "subsidy_flag", "standing_charge",
                "export_rate",
            ),
            weather.filter(F.col("sim_date") == F.lit(day)).select(
                "grid_zone", F.lit(day.isoformat()).alias("forecast_date"), "cloud_cover_pct",
                "expected_solar_index", "temperature_c",
            ),
            lay.root, day,
        )
    tables.refresh_dimension(mt.active_households(spark, tables_dir), lay.dim_household)
    return lay


def bills(spark, layout):
    return spark.read.parquet(layout.batch_household_bill)


def test_days_are_settled_oldest_first_and_reruns_replace(spark, tables_dir, layout):
    pending = lambda: [
        r.sim_date for r in reconcile.find_pending_days(spark, layout).collect()
    ]
    assert pending() == DAYS[:2]  # the last published day is not over
    reconcile.settle_days(spark, layout, DAYS[0], run_id="run-1")
    assert pending() == DAYS[1:2]
    reconcile.settle_days(spark, layout, DAYS[0], DAYS[1], run_id="run-2")
    assert pending() == []

    # The same rows as the catalog query over the same days.
    columns = ["sim_day", "household_id", "total_bill", "reading_count", "rejected_reading_count"]
    priced = reconcile.priced_households(mt.readings(spark, tables_dir), mt.tariffs(spark, tables_dir))
    from wattledger.operators import billing

    want = billing.bill_table(priced).filter(F.col("sim_day").isin(DAYS[:2])).select(columns)
    got = bills(spark, layout).select(columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.batch_run_id for r in bills(spark, layout).select("batch_run_id").distinct().collect()} == {"run-2"}

    zone_rows = spark.read.parquet(layout.batch_zone_daily)
    assert zone_rows.count() == 10
    assert zone_rows.filter(F.col("forecast_solar_index").isNull()).count() == 0
    runs = quality.latest_runs(spark.read.parquet(layout.ops_pipeline_runs))
    assert {r.run_id: r.status for r in runs.collect()} == {"run-1": "SUCCESS", "run-2": "SUCCESS"}
    checks = spark.read.parquet(layout.ops_dq_metrics)
    assert checks.filter("run_id = 'run-2'").count() == 8


def test_a_day_without_readings_fails_and_writes_nothing(spark, layout):
    before = bills(spark, layout).count()
    with pytest.raises(ValueError, match="no valid readings"):
        reconcile.settle_days(spark, layout, date(2023, 12, 31), run_id="run-3")
    assert bills(spark, layout).count() == before
    runs = quality.latest_runs(spark.read.parquet(layout.ops_pipeline_runs))
    assert runs.filter("run_id = 'run-3'").first().status == "FAILED"


def test_report_is_ranked_csv_per_day(spark, layout):
    reconcile.publish_report(spark, layout, DAYS[0], DAYS[1])
    report = spark.read.option("header", True).csv(layout.reports)
    assert report.count() == bills(spark, layout).count()
    assert report.filter("bill_rank = 1").select("sim_day").distinct().count() == 2
    with pytest.raises(ValueError, match="no bills"):
        reconcile.publish_report(spark, layout, date(2023, 1, 1))


def test_emptied_day_is_replaced_too(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(DAYS[0], 1), (DAYS[1], 2)], "sim_day date, v int")
    tables.overwrite_days(rows, path, DAYS[:2])
    tables.overwrite_days(rows.filter("v = 2"), path, DAYS[:2])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2, DAYS[1])]


def test_archive_read_prunes_partitions(spark, layout):
    df = files.read_archive(spark, layout.meter_readings, DAYS[0], DAYS[0])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sim_date" in plan
    assert df.select("sim_date").distinct().count() == 1


def test_a_household_in_two_zones_is_refused(spark, tables_dir):
    moved = mt.readings(spark, tables_dir).withColumn(
        "grid_zone", F.when(F.col("voltage_suspect"), "ZONE-X").otherwise(F.col("grid_zone"))
    )
    from wattledger.operators import billing

    priced = reconcile.priced_households(moved, mt.tariffs(spark, tables_dir))
    with pytest.raises(ValueError, match=r"unique \(sim_day, household_id\)"):
        reconcile.require_constraints(billing.bill_table(priced))


def test_scratch_is_removed_after_the_job(spark):
    with Scratch(spark) as scratch:
        settled = scratch.settle(spark.range(10), "numbers")
        (path, *_) = settled.inputFiles()
        assert settled.count() == 10
    from pathlib import Path

    assert not Path(path.removeprefix("file://")).parent.exists()


def test_repeated_tariff_rows_are_refused(spark):
    twice = spark.createDataFrame([("a",), ("a",)], "household_id string")
    with pytest.raises(ValueError, match="more than one row"):
        reconcile.require_unique(twice, "household_id")


def test_csv_readers_cast_and_check_the_header(spark, tmp_path):
    day = tmp_path / "tariffs" / "sim_date=2024-01-01"
    day.mkdir(parents=True)
    header = "household_id,tariff_rate,billing_tier,subsidy_flag,standing_charge,export_rate\n"
    (day / "tariffs.csv").write_text(
        header + "h1,0.2,DOMESTIC_LOW,TRUE,0.1,0.09\nh2,cheap,DOMESTIC_STD,false,0.1,0.09\n"
    )
    rows = {r.household_id: r for r in files.read_tariffs(spark, str(tmp_path / "tariffs")).collect()}
    assert rows["h1"].subsidy_flag is True and rows["h1"].sim_date == date(2024, 1, 1)
    assert rows["h2"].tariff_rate is None and rows["h2"].subsidy_flag is False
    (day / "tariffs.csv").write_text("tariff_rate,household_id,a,b,c,d\n0.1,h1,x,x,1,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_tariffs(spark, str(tmp_path / "tariffs")).collect()


def test_partition_days_with_and_without_marker(spark, tmp_path):
    for i in range(3):
        d = tmp_path / f"sim_date={DAYS[0] + timedelta(days=i)}"
        d.mkdir()
        if i != 1:
            (d / "_SUCCESS").touch()
    (tmp_path / "sim_date=__HIVE_DEFAULT_PARTITION__").mkdir()
    got = lambda **k: sorted(
        r.sim_date.day for r in files.partition_days(spark, str(tmp_path), **k).collect()
    )
    assert got() == [1, 2, 3]
    assert got(marker="_SUCCESS") == [1, 3]
    assert files.partition_days(spark, f"{tmp_path}/nowhere").count() == 0


def test_audit_row_keeps_long_errors(spark):
    row = tables.audit_row(spark, "r", "j", "FAILED", DAYS[0], error="x" * 5000).first()
    assert len(row.error) == 5000 and isinstance(row.recorded_at, datetime)


def test_gate_has_a_row_for_every_day_asked_for(spark, layout):
    rows = {r.sim_day: r for r in reconcile.coverage(spark, layout, DAYS[0], DAYS[2]).collect()}
    assert sorted(rows) == DAYS
    assert rows[DAYS[0]].households_billed > 0 and rows[DAYS[2]].households_billed == 0
    assert (rows[DAYS[2]].coverage_pct, rows[DAYS[2]].passed) == (0, False)
    with pytest.raises(ValueError, match="2024-01-03: 0.0 % billed"):
        reconcile.require_coverage(spark, layout, DAYS[2])


def test_settle_next_without_a_pending_day(spark, layout):
    assert reconcile.settle_next(spark, layout) is None
