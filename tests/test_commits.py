"""A run's tables become visible together, by its commit."""

from __future__ import annotations

import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from wattledger import session
from wattledger.plans import commits, installation, reconcile, tables
from wattledger.sources import files, meter_tables

FIRST, SECOND = date(2024, 1, 1), date(2024, 1, 2)


@pytest.fixture(scope="module")
def layout(spark, tables_dir):
    return installation.laid_out(spark, tables_dir)


def seen(spark, layout):
    """What readers of the settled tables get."""
    return {
        name: sorted(map(repr, reconcile.settled(spark, layout, name).drop("computed_at").collect()))
        for name in commits.COUNTED
    }


def test_a_failure_between_two_tables_is_invisible(spark, layout, monkeypatch):
    reconcile.settle_days(spark, layout, FIRST, SECOND, run_id="1")
    before = seen(spark, layout)
    assert all(before.values())
    other = installation.OTHER_LIMITS
    written = []
    plain = commits.write_run

    def failing(rows, path, folder, sort_by=()):
        if written:
            raise OSError("no space")
        plain(rows, path, folder, sort_by)
        written.append((path, folder))

    monkeypatch.setattr(commits, "write_run", failing)
    with pytest.raises(OSError, match="no space"):
        reconcile.settle_days(spark, layout, FIRST, SECOND, run_id="2", limits=other)
    monkeypatch.undo()
    assert written and commits.staged(spark, *written[0]).count() > 0
    assert seen(spark, layout) == before
    assert reconcile.settled_checks(spark, layout).filter("run_id = '2'").isEmpty()

    monkeypatch.setattr(tables, "append_rows", lambda rows, path: (_ for _ in ()).throw(OSError("checks")))
    with pytest.raises(OSError, match="checks"):  # of the audit, before anything is written
        reconcile.settle_days(spark, layout, FIRST, run_id="3", limits=other)
    monkeypatch.undo()
    assert seen(spark, layout) == before

    # The same run again: what it left behind stays apart, and it becomes visible at once.
    reconcile.settle_days(spark, layout, FIRST, SECOND, run_id="2", limits=other)
    after = seen(spark, layout)
    assert after["batch_household_bill"] != before["batch_household_bill"]
    assert after["batch_zone_daily"] != before["batch_zone_daily"]
    assert {r.run_id for r in reconcile.settled_checks(spark, layout).collect()} == {"2"}


def test_gate_sees_the_bills_and_holds_back(spark, layout):
    before = seen(spark, layout)
    counts = []

    def gate(bills):
        counts.append(bills.count())
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        reconcile.settle_days(spark, layout, FIRST, run_id="gated", gate=gate)
    assert counts[0] > 0 and seen(spark, layout) == before
    held = reconcile.coverage_at_least(spark, layout, [FIRST], installation.OTHER_LIMITS)
    with pytest.raises(ValueError, match="2024-01-01: .* % billed"):
        reconcile.settle_days(spark, layout, FIRST, run_id="gated", gate=held)


def rows(spark, *values):
    return spark.createDataFrame(values, "sim_day date, household_id string")


def test_newest_commit_wins_and_may_empty_a_day(spark, tmp_path):
    table, marks = f"{tmp_path}/batch_household_bill", f"{tmp_path}/commits"
    none = rows(spark).select("sim_day")

    def run(run_id, *values):
        folder = commits.new_folder(run_id)
        commits.write_run(rows(spark, *values), table, folder)
        written = commits.staged(spark, table, folder)
        commits.commit(spark, marks, run_id, folder, [FIRST, SECOND], bills=written, zones=none)

    visible = lambda: sorted(r.household_id for r in commits.committed(spark, table, marks).collect())
    assert commits.commits(spark, marks).isEmpty()
    commits.write_run(rows(spark, (FIRST, "x")), table, commits.new_folder("007"))
    assert visible() == []
    run("007", (FIRST, "a"), (SECOND, "b"))
    assert visible() == ["a", "b"]
    run("2024-01-01", (FIRST, "c"))
    assert visible() == ["c"]
    assert [r.sim_date for r in commits.billed_days(commits.commits(spark, marks)).collect()] == [FIRST]
    assert commits.remove_superseded(spark, marks, [table], [FIRST, SECOND]) == 2
    # What was never committed might belong to a run at work.
    assert visible() == ["c"] and spark.read.parquet(table).count() == 2
    # A run repeated with fewer days: what it left behind before doesn't come back.
    run("r", (FIRST, "d"), (SECOND, "e"))
    run("r", (FIRST, "f"))
    assert visible() == ["f"]


def test_readers_open_the_folders_of_the_newest_runs_only(spark, layout):
    commits.commits(spark, layout.ops_commits).select("run_id").distinct().count()
    bills = reconcile.settled(spark, layout, "batch_household_bill").filter(F.col("sim_day") == F.lit(FIRST))
    plan = bills._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "sim_day" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_statistics_need_no_second_deduplication(spark, tables_dir):
    """The same numbers as the one-pass statistics, from rows that are de-duplicated already."""
    from wattledger.operators import clean
    from wattledger.sources import meter_tables as mt

    readings = mt.readings(spark, tables_dir)
    got = clean.stats_of(clean.flag_clean(readings), clean.delivered(readings))
    want = clean.clean_stats(readings)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    empty = readings.limit(0)
    assert clean.stats_of(clean.flag_clean(empty), clean.delivered(empty)).isEmpty()


def test_write_times_come_from_files_alone(spark, tmp_path):
    from wattledger.sources import files

    assert files.write_times(spark, f"{tmp_path}/none").isEmpty()
    for part in (1, 2):
        spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/t/day={part}")
    times = files.write_times(spark, f"{tmp_path}/t")
    assert times.count() == 2 and times.filter("last_write IS NULL").isEmpty()
    plan = times._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1]


def test_freshness_of_an_installation(spark, tmp_path):
    layout = reconcile.Layout(str(tmp_path))
    spark.range(3).coalesce(1).write.parquet(layout.batch_household_bill)
    rows = {r.table_name: r for r in reconcile.last_writes(spark, layout).collect()}
    assert rows["rt_zone_load"].last_write is None and rows["rt_zone_load"].staleness_seconds is None
    assert rows["batch_household_bill"].last_write is not None


def test_tariffs_are_parsed_once_and_all_are_checked(spark, layout, monkeypatch):
    """Their text is read by one job; the check and the prices read what it stored."""
    plans, plain = {}, session.Scratch.settle

    def settle(self, df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return plain(self, df, label)

    monkeypatch.setattr(session.Scratch, "settle", settle)
    reconcile.settle_days(spark, layout, FIRST, run_id="parsed-once")
    assert [label for label, plan in plans.items() if "scan csv" in plan.lower()] == ["tariffs"]

    read = files.read_tariffs
    before = seen(spark, layout)

    def repeated(*args):
        extra = read(*args).limit(1).withColumn("household_id", F.lit("HH-without-readings"))
        return read(*args).union(extra).union(extra)

    monkeypatch.setattr(files, "read_tariffs", repeated)
    with pytest.raises(ValueError, match="more than one row"):
        reconcile.settle_days(spark, layout, FIRST, run_id="repeated")
    assert seen(spark, layout) == before


def test_few_splits_of_tariffs_are_spread_before_they_are_repeated(spark, tables_dir):
    tariffs = meter_tables.tariffs(spark, tables_dir)
    daily = installation.daily_tariffs(tariffs, [FIRST, SECOND])
    assert daily.rdd.getNumPartitions() > tariffs.rdd.getNumPartitions() == 1
    assert daily.count() == 2 * tariffs.count()


def test_jobs_run_together_and_the_first_failure_is_raised(spark):
    meet = threading.Barrier(2, timeout=60)
    assert session.together(spark, lambda: meet.wait() >= 0, lambda: meet.wait() >= 0) == [True, True]
    ended = []

    def failing(name):
        ended.append(name)
        raise ValueError(name)

    with pytest.raises(ValueError, match="first"):
        session.together(spark, lambda: failing("first"), lambda: failing("second"))
    assert sorted(ended) == ["first", "second"]
