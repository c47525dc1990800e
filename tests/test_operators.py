"""Ranking, alerts, quality and day discovery on small hand-made relations."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wattledger.functions.curves import demand_factor, solar_factor
from wattledger.operators import alerts, days, quality, serving, zones
from wattledger.operators.ranking import rank_by_amount

D = Decimal


def test_rank_equals_brute_force_with_a_hot_amount(spark):
    rng = random.Random(7)
    rows = [("a", f"h{i}", D("5.0000")) for i in range(1500)]  # a third ties
    rows += [("a", f"k{i}", D(rng.randrange(-3_000_000, 900_000_000)) / 10_000) for i in range(3000)]
    rows += [("b", f"m{i}", D(rng.randrange(0, 200)) / 100) for i in range(500)]
    rows += [("b", "none", None)]
    df = spark.createDataFrame(rows, "g string, h string, v decimal(12,4)").repartition(5)
    got = {(r.g, r.h): r.r for r in rank_by_amount(df, "g", "v", "r").collect()}
    assert len(got) == len(rows)
    for g in ("a", "b"):
        values = sorted((v for x, _, v in rows if x == g and v is not None), reverse=True)
        first = {}
        for i, v in enumerate(values, start=1):
            first.setdefault(v, i)
        for x, h, v in rows:
            if x == g and v is not None:
                assert got[(g, h)] == first[v]
    assert got[("b", "none")] is None


def zone_rows(spark, rows):
    return spark.createDataFrame(
        [(z, datetime(2024, 1, 1, h), D(c), D(p), m) for z, h, c, p, m in rows],
        "grid_zone string, window_start timestamp, total_consumption_kwh decimal(18,5), "
        "renewable_pct decimal(6,2), active_meters bigint",
    ).withColumn("sim_day", F.to_date("window_start"))


def test_zone_rules_and_texts(spark):
    rows = zone_rows(
        spark,
        [("N", 0, "45.00001", "15.00", 1), ("S", 0, "45", "14.99", 1), ("E", 0, "0", "0", 1),
         ("W", 0, "100.25", "2.35", 2)],
    )
    got = {(r.alert_type, r.entity_id): r for r in alerts.zone_alerts(rows).collect()}
    assert set(got) == {
        ("ZONE_OVERLOAD", "N"), ("LOW_RENEWABLE_CONTRIBUTION", "S"), ("ZONE_OVERLOAD", "W"),
        ("LOW_RENEWABLE_CONTRIBUTION", "W"),
    }
    assert got[("ZONE_OVERLOAD", "W")].message == "Zone W load 100.3 kWh exceeds 45 kWh in one window"
    low = got[("LOW_RENEWABLE_CONTRIBUTION", "S")]
    assert low.message == "Zone S renewable contribution 15.0% is below the 15% floor"
    assert (low.severity, low.metric_value, low.threshold) == ("WARNING", D("14.99"), D(15))


def test_spike_rule(spark):
    running = spark.createDataFrame(
        [("h1", date(2024, 1, 1), D("8.0"), 2, datetime(2024, 1, 1, 5)),
         ("h2", date(2024, 1, 1), D("8.00001"), 2, datetime(2024, 1, 1, 5)),
         ("h3", date(2024, 1, 1), D("0"), 0, datetime(2024, 1, 1, 5))],
        "household_id string, sim_day date, consumption_kwh decimal(14,5), reading_count bigint, "
        "last_seen timestamp",
    )
    (row,) = alerts.spike_alerts(running).collect()
    assert row.entity_id == "h2"
    assert row.message == "Household h2 averaging 4.00 kWh per reading, well above baseline"


def test_silent_zone_fires_for_absent_windows_and_zero_meters(spark):
    load = zone_rows(spark, [("N", 0, "1", "50", 1), ("N", 2, "1", "50", 1), ("S", 1, "1", "50", 0)])
    dim = spark.createDataFrame([("N",), ("S",), ("E",)], "grid_zone string")
    got = {(r.entity_id, r.window_start.hour) for r in alerts.silent_zone_alerts(load, dim).collect()}
    assert got == {("N", 1), ("S", 0), ("S", 1), ("S", 2), ("E", 0), ("E", 1), ("E", 2)}


def test_peak_hour_tie_goes_to_the_earlier_hour(spark):
    hourly = spark.createDataFrame(
        [("N", 9, D(5)), ("N", 7, D(5)), ("N", 3, D(1))],
        "grid_zone string, hour int, hour_load_kwh decimal(18,5)",
    ).withColumn("sim_date", F.lit("2024-01-01").cast("date"))
    assert zones.peak_hour(hourly).first().peak_hour == 7


def test_solar_curve(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (6.0, 0.0), (12.0, 0.0), (12.0, 100.0), (12.0, 300.0), (12.0, -5.0), (18.0, 0.0)],
        "h double, c double",
    )
    got = [r[0] for r in df.select(solar_factor(F.col("h"), F.col("c"))).collect()]
    assert got == [0.0, 0.0, 1.0, 0.25, 0.25, 1.0, 0.0]
    peak = df.select(demand_factor(F.lit(7.0))).first()[0]
    assert peak == pytest.approx(1.15)


def day_rows(spark, *numbers):
    return spark.createDataFrame(
        [(date(2024, 1, n),) for n in numbers], "sim_date date"
    )


def test_pending_days(spark):
    published, archived, billed = (
        day_rows(spark, 1, 2, 3, 5, 6), day_rows(spark, 1, 2, 5, 6), day_rows(spark, 1),
    )
    got = [r.sim_date.day for r in days.pending_days(published, archived, billed).collect()]
    assert got == [2, 5]  # 3 has no successor, 6 neither, 1 is done
    assert days.next_day(days.pending_days(published, archived, billed)).first().sim_date.day == 2


def test_freshness_with_an_empty_table(spark):
    now = F.lit("2024-01-01 00:03:01").cast("timestamp")
    fresh = spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp")
    status = quality.freshness_status(
        quality.freshness(
            now, rt_zone_load=(fresh, "t"), rt_household_running=(fresh.limit(0), "t"),
            batch_household_bill=(fresh, "t"),
        )
    )
    got = {r.table_name: (r.staleness_seconds, r.is_stale) for r in status.collect()}
    assert got == {
        "rt_zone_load": (D("181.0"), True), "rt_household_running": (None, True),
        "batch_household_bill": (D("181.0"), False),
    }


def test_backlog_counts_the_day_in_flight(spark):
    start = date(2024, 1, 1)
    running = spark.createDataFrame(
        [(start + timedelta(days=i % 6),) for i in range(30)], "sim_day date"
    )
    bills = spark.createDataFrame([(start,)], "sim_day date")
    runs = spark.createDataFrame(
        [("r1", "FAILED", datetime(2024, 1, 1, 11, 50)), ("r2", "FAILED", datetime(2024, 1, 1, 10)),
         ("r3", "SUCCESS", datetime(2024, 1, 1, 11, 55))],
        "run_id string, status string, started_at timestamp",
    )
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    r = quality.backlog_status(running, bills, runs, now).first()
    assert (r.stream_days, r.batch_days, r.backlog_days, r.recent_failed_runs) == (6, 1, 4, 1)
    assert r.is_alert is True
    r = quality.backlog_status(running.limit(0), bills, runs, now).first()
    assert (r.backlog_days, r.is_alert) == (0, False)


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (1, "z"), (None, None), (None, "b")], "k int, v string")
    got = {
        r.rule: r.violations
        for r in quality.constraint_violations(
            df, not_null=("k",), allowed={"v": ("a", "b")}, unique=("k",)
        ).collect()
    }
    assert got == {"k is not null": 2, "v in allowed values": 1, "unique (k)": 1}


def test_coverage_gate(spark):
    bills = spark.createDataFrame(
        [(date(2024, 1, 1), D(1), D(2))] * 4 + [(date(2024, 1, 2), D(1), D(2))] * 3,
        "sim_day date, total_bill decimal(12,4), gross_consumption_kwh decimal(14,5)",
    )
    got = {r.sim_day.day: (r.coverage_pct, r.passed) for r in quality.coverage_gate(bills, 5).collect()}
    assert got == {1: (D("80.0"), True), 2: (D("60.0"), False)}


def test_limits_are_checked(spark):
    df = zone_rows(spark, [("N", 0, "1", "50", 1)])
    with pytest.raises(ValueError):
        serving.zone_history(df, "N", windows=0)
    with pytest.raises(ValueError):
        serving.zone_history(df, "N", windows=501)


def test_latest_run_state(spark):
    t = datetime(2024, 1, 1)
    audit = spark.createDataFrame(
        [("r", "RUNNING", t), ("r", "FAILED", t), ("s", "RUNNING", t),
         ("s", "SUCCESS", t + timedelta(seconds=1))],
        "run_id string, status string, recorded_at timestamp",
    )
    got = {r.run_id: r.status for r in quality.latest_runs(audit).collect()}
    assert got == {"r": "FAILED", "s": "SUCCESS"}
