"""The settlement plan: clean, impute, price, roll up, check, store."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattledger.operators import billing, clean, days, quality, serving, zones
from wattledger.plans import commits, tables
from wattledger.schemas import BILL_COLUMNS, HOUSEHOLD_RUNNING_COLUMNS, LIMITS, Limits
from wattledger.session import Scratch, pin_utc, together
from wattledger.sources import files
from wattledger.streaming import changes, queries

JOB_NAME = "billing_reconciliation"

# What energy, medians and hourly load need of a de-duplicated reading.
FLAGGED_COLUMNS = (
    "sim_date", "event_time", "household_id", "grid_zone", "billable",
    "consumption_kwh", "solar_measured_kwh",
)


@dataclass(frozen=True)
class Layout:
    """Where the tables of one installation live: one folder per table."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    meter_readings = property(lambda self: self.table("meter_readings"))
    tariffs = property(lambda self: self.table("tariffs"))
    weather = property(lambda self: self.table("weather"))
    dim_household = property(lambda self: self.table("dim_household"))
    batch_household_bill = property(lambda self: self.table("batch_household_bill"))
    batch_zone_daily = property(lambda self: self.table("batch_zone_daily"))
    ops_pipeline_runs = property(lambda self: self.table("ops_pipeline_runs"))
    ops_dq_metrics = property(lambda self: self.table("ops_dq_metrics"))
    rt_zone_load = property(lambda self: self.table("rt_zone_load"))
    rt_household_running = property(lambda self: self.table("rt_household_running"))
    ops_commits = property(lambda self: self.table("ops_commits"))
    reports = property(lambda self: self.table("reports"))


def priced_households(
    readings: DataFrame, tariffs: DataFrame, limits: Limits = LIMITS
) -> DataFrame:
    """Unrounded bill lines per day and household."""
    return billing.price(billing.household_energy(clean.flag_clean(readings, limits)), tariffs)


def require_unique(df: DataFrame, *key: str) -> None:
    """A repeated tariff or forecast would multiply the rows it is joined to."""
    repeated = df.groupBy(*key).count().filter(F.col("count") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"more than one row for a key of ({', '.join(key)})")


def _priced(spark: SparkSession, scratch: Scratch, flagged: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Unrounded bill lines, stored; stored tariffs that repeat a household and day are refused.

    Most tariffs may belong to households without readings. The households with readings
    are stored, so the planner knows their size and, while it is small, sends them to the
    scan of the tariffs; only tariffs that price something are exchanged and sorted.
    """

    def energy_and_households() -> tuple[DataFrame, DataFrame]:
        energy = scratch.settle(billing.household_energy(flagged), "energy")
        return energy, scratch.settle(energy.select("household_id").distinct(), "households")

    (energy, known), _ = together(
        spark,
        energy_and_households,
        # The household first: rows spread and compare by it.
        lambda: require_unique(tariffs, "household_id", "sim_date"),
    )
    wanted = tariffs.join(known, "household_id", "left_semi")
    return scratch.settle(billing.price(energy, wanted), "priced")


def _days(first: date, last: date) -> list[date]:
    return [date.fromordinal(n) for n in range(first.toordinal(), last.toordinal() + 1)]


def require_constraints(bills: DataFrame) -> None:
    """The declared rules of the bill table: its key, hence one zone per household and
    day, and its mandatory columns."""
    broken = quality.constraint_violations(
        bills, not_null=tuple(BILL_COLUMNS), unique=("sim_day", "household_id")
    ).filter("violations > 0")
    found = broken.collect()  # one row per rule
    if found:
        raise ValueError("; ".join(f"{r.rule}: {r.violations} violations" for r in found))


def find_pending_days(spark: SparkSession, layout: Layout) -> DataFrame:
    """Complete, archived and not yet billed days, oldest first.

    Folder names tell what was published and archived, commits what was billed: a day
    counts as billed once it has a bill row. No reading and no bill is read.
    """
    return days.pending_days(
        files.partition_days(spark, layout.tariffs, marker="_SUCCESS"),
        files.partition_days(spark, layout.meter_readings),
        commits.billed_days(commits.commits(spark, layout.ops_commits)),
    )


def settled(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """Bills (``batch_household_bill``) or zone rows (``batch_zone_daily``) as committed."""
    return commits.committed(spark, layout.table(table), layout.ops_commits)


def running(spark: SparkSession, layout: Layout) -> DataFrame:
    """The live household totals: the newest change of each household and day."""
    root = layout.rt_household_running
    schema = spark.read.parquet(f"{root}/changes").drop("batch_id").schema
    log = changes.read_changes(spark, root, schema)
    return changes.newest(log, queries.HOUSEHOLD_KEY, ("last_seen",)).select(*HOUSEHOLD_RUNNING_COLUMNS)


def last_writes(spark: SparkSession, layout: Layout, now: Column | None = None) -> DataFrame:
    """Newest write and age of the live tables and the bills, from their files' times."""
    return quality.freshness(
        F.current_timestamp() if now is None else now,
        **{
            name: (files.write_times(spark, layout.table(name)), "last_write")
            for name in (*quality.LIVE_TABLES, "batch_household_bill")
        },
    )


def settled_checks(spark: SparkSession, layout: Layout) -> DataFrame:
    """The checks of the runs that count."""
    checks = spark.read.parquet(layout.ops_dq_metrics)
    return commits.committed_checks(checks, commits.commits(spark, layout.ops_commits))


def settle_days(
    spark: SparkSession,
    layout: Layout,
    first_day: date,
    last_day: date | None = None,
    run_id: str | None = None,
    limits: Limits = LIMITS,
    gate: Callable[[DataFrame], None] | None = None,
) -> str:
    """Settle one day or a range of days in one set of jobs and store the results.

    The de-duplicated rows are stored once and feed every later step. Bills, zone rows and
    checks become visible together, by the commit at the end (``commits``): a run that fails
    anywhere before leaves what readers see as it was. ``gate`` gets the bills before the
    commit and refuses them by raising. Running the same days again replaces them.
    """
    pin_utc(spark)
    last_day = last_day or first_day
    run_id = run_id or f"batch-{first_day.isoformat()}-{uuid.uuid4().hex[:8]}"
    started = time.monotonic()

    def audit(status: str, **counts) -> None:
        row = tables.audit_row(spark, run_id, JOB_NAME, status, first_day, **counts)
        tables.append_rows(row, layout.ops_pipeline_runs)

    def seconds() -> float:
        return round(time.monotonic() - started, 3)

    audit("RUNNING")
    try:
        read, written = _settle(spark, layout, first_day, last_day, run_id, limits, gate)
    except Exception as exc:
        audit("FAILED", duration_s=seconds(), error=str(exc))
        raise
    audit("SUCCESS", records_in=read, records_out=written, duration_s=seconds())
    return run_id


def _settle(spark, layout, first_day, last_day, run_id, limits, gate) -> tuple[int, int]:
    readings = files.read_archive(spark, layout.meter_readings, first_day, last_day)
    published = files.read_tariffs(spark, layout.tariffs, first_day, last_day)
    weather = files.read_weather(spark, layout.weather, first_day, last_day)
    dim = files.read_dim_household(spark, path=layout.dim_household)
    wanted, folder = _days(first_day, last_day), commits.new_folder(run_id)
    stamps = {"batch_run_id": F.lit(run_id), "computed_at": F.current_timestamp()}

    with Scratch(spark) as scratch:
        rows = clean.flag_clean(readings, limits).select(*FLAGGED_COLUMNS)
        # The text of the tariffs is parsed once, for the check of their key and for the prices.
        flagged, tariffs, _ = together(
            spark,
            lambda: scratch.settle(rows, "flagged"),
            lambda: scratch.settle(published, "tariffs"),
            lambda: require_unique(weather, "sim_date", "grid_zone"),
        )
        if flagged.filter("billable").isEmpty():
            raise ValueError(f"no valid readings from {first_day} to {last_day}; nothing written")
        # Read by the bill table, the zone rollup and the tariff check.
        priced = _priced(spark, scratch, flagged, tariffs)

        bills = billing.bill_table(priced)
        require_constraints(bills)
        in_days = F.col("sim_day").isin(wanted)
        commits.write_run(
            bills.withColumns(stamps).filter(in_days), layout.batch_household_bill, folder,
            sort_by=("grid_zone", "household_id"),
        )
        zone_rows = zones.zone_daily(flagged, priced, weather, dim).withColumns(stamps)
        commits.write_run(
            zone_rows.filter(in_days), layout.batch_zone_daily, folder, sort_by=("grid_zone",)
        )

        # The events were de-duplicated above; of the archive, only two counts are missing.
        stats = scratch.settle(clean.stats_of(flagged, clean.delivered(readings)), "stats")
        checks = quality.dq_rows(stats, billing.tariff_coverage(priced)).withColumns(
            {
                "run_id": F.lit(run_id),
                "job_name": F.lit(JOB_NAME),
                "stage": F.lit("batch"),
                "recorded_at": F.current_timestamp(),
            }
        )
        tables.append_rows(checks, layout.ops_dq_metrics)
        read = stats.agg(F.sum("records_read").alias("read")).first().read or 0
    written = {
        count: commits.staged(spark, layout.table(table), folder)
        for table, count in commits.COUNTED.items()
    }
    if gate:
        gate(written["bills"])
    commits.commit(spark, layout.ops_commits, run_id, folder, wanted, **written)
    commits.remove_superseded(
        spark, layout.ops_commits, [layout.table(t) for t in commits.COUNTED], wanted
    )
    return read, written["bills"].count()


def coverage(
    spark: SparkSession, layout: Layout, first_day: date, last_day: date | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """A gate row for each day asked for; a day without any bill fails at 0 %."""
    wanted = _days(first_day, last_day or first_day)
    asked = spark.createDataFrame([(d,) for d in wanted], "sim_day date")
    bills = settled(spark, layout, "batch_household_bill").filter(F.col("sim_day").isin(wanted))
    households = spark.read.parquet(layout.dim_household).count()
    return quality.coverage_gate(bills, households, limits, days=asked)


def coverage_at_least(
    spark: SparkSession, layout: Layout, days: list[date], limits: Limits = LIMITS
) -> Callable[[DataFrame], None]:
    """A gate for ``settle_days`` that holds back runs which bill too few households."""

    def gate(bills: DataFrame) -> None:
        asked = spark.createDataFrame([(d,) for d in days], "sim_day date")
        households = spark.read.parquet(layout.dim_household).count()
        rows = quality.coverage_gate(bills, households, limits, days=asked)
        if failed := rows.filter(~F.col("passed")).collect():  # one row per day
            raise ValueError("; ".join(f"{r.sim_day}: {r.coverage_pct} % billed" for r in failed))

    return gate


def require_coverage(
    spark: SparkSession, layout: Layout, first_day: date, last_day: date | None = None
) -> None:
    failed = coverage(spark, layout, first_day, last_day).filter(~F.col("passed")).collect()
    if failed:  # one row per day
        raise ValueError("; ".join(f"{r.sim_day}: {r.coverage_pct} % billed" for r in failed))


def settle_next(spark: SparkSession, layout: Layout, run_id: str | None = None) -> date | None:
    """Settle, gate and report the oldest pending day; None if there is none."""
    day = days.next_day(find_pending_days(spark, layout)).first()["sim_date"]
    if day is not None:
        settle_days(spark, layout, day, run_id=run_id)
        require_coverage(spark, layout, day)
        publish_report(spark, layout, day)
    return day


def publish_report(
    spark: SparkSession, layout: Layout, first_day: date, last_day: date | None = None
) -> None:
    """Export the ranked bills of settled days as CSV."""
    last_day = last_day or first_day
    wanted = _days(first_day, last_day)
    bills = settled(spark, layout, "batch_household_bill").filter(F.col("sim_day").isin(wanted))
    if bills.isEmpty():
        raise ValueError(f"no bills from {first_day} to {last_day} to report")
    tables.export_report(serving.billing_report(bills), layout.reports, wanted)
