"""No valid value is lost to a narrow type, a sketch or a broken clock."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wattledger.operators import alerts, billing, clean, live, parse
from wattledger.schemas import MESSAGE, Limits
from wattledger.session import scratch_path

AT = datetime(2024, 1, 1, 12)


def parsed(spark, readings, limits=Limits()):
    rows = []
    for i, (kwh, solar, *at) in enumerate(readings):
        when = at[0] if at else AT
        payload = {
            "event_id": f"e{i}", "meter_id": f"m{i}", "household_id": "h", "grid_zone": "Z",
            "power_consumption_kwh": kwh, "solar_generation_kwh": solar, "voltage": 230.0,
            "timestamp": when.isoformat(), "ingest_ts": 0.0,
        }
        rows.append((0, i, AT, json.dumps(payload)))
    return parse.parse_messages(spark.createDataFrame(rows, MESSAGE), limits=limits)


def test_a_high_limit_bills_high_readings(spark):
    limits = Limits(max_plausible_kwh=5000.0)
    readings = parsed(spark, [(10.0, 0.0), (1500.0, 0.0), (10.0, 0.0), (5001.0, 0.0)], limits)
    energy = billing.household_energy(clean.flag_clean(readings, limits)).first()
    assert (energy.gross_consumption_kwh, energy.reading_count) == (Decimal("1520.00000"), 3)
    assert live.zone_load(readings, limits=limits).first().total_consumption_kwh == Decimal("1520.00000")


@pytest.mark.parametrize("limit", [0.5, 12.0, 999.0, 1e9, float("inf")])
def test_the_type_of_a_reading_holds_its_limit(spark, limit):
    kind = Limits(max_plausible_kwh=limit).reading_energy
    largest = min(limit, 1e9)
    assert spark.range(1).select(F.lit(largest).cast(kind)).first()[0] == Decimal(str(largest))


def test_impossible_solar_values_are_counted(spark):
    solar = [0.5, None, 2e9, -2e9, float("nan"), float("inf"), 999999999.0]
    readings = parsed(spark, [(1.0, 0.0)] * len(solar)).withColumn(
        "solar_generation_kwh",
        F.element_at(F.array(*[F.lit(x).cast("double") for x in solar]), F.col("kafka_offset").cast("int") + 1),
    )
    counts = parse.solar_range_counts(readings).first()
    assert (counts.solar_readings, counts.solar_out_of_range) == (6, 4)
    again = parse.validate_readings(readings).orderBy("kafka_offset").collect()
    assert [r.solar_missing for r in again] == [False, True, True, True, True, True, False]
    assert [r.solar_kwh == 0 for r in again] == [r.solar_missing for r in again]


def test_medians_are_exact_above_ten_thousand_readings(spark):
    n = 30_001
    rows = spark.range(n).select(
        F.lit("2024-01-01").cast("date").alias("sim_date"), F.lit("h").alias("household_id"),
        F.lit("Z").alias("grid_zone"),
        F.pmod(F.col("id") * 7919, F.lit(n)).cast("decimal(14,5)").alias("solar_measured_kwh"),
    )
    assert clean.household_solar_median(rows).first().median_solar_kwh == Decimal(n // 2)
    even = rows.filter("solar_measured_kwh < 4")
    assert clean.household_solar_median(even).first().median_solar_kwh == 1


def test_broken_clocks_raise_no_silent_zones(spark):
    hours = [datetime(2024, 1, 1, h) for h in (10, 10, 11, 13)]
    odd = [datetime(1970, 1, 1, 5), datetime(9999, 12, 31, 22)]
    zones = spark.createDataFrame([("Z",), ("Y",)], "grid_zone string")

    def raised(times):
        load = live.zone_load(parsed(spark, [(1.0, 0.0, at) for at in times]))
        return {(r.entity_id, r.window_start) for r in alerts.silent_zone_alerts(load, zones).collect()}

    want = {("Z", datetime(2024, 1, 1, 12))} | {("Y", datetime(2024, 1, 1, h)) for h in range(10, 14)}
    assert raised(hours) == raised(hours + odd) == want


def silent(spark, readings, **more):
    zones = spark.createDataFrame([("Z",), ("Y",)], "grid_zone string")
    found = alerts.silent_zone_alerts(live.zone_load(readings), zones, **more)
    return sorted((r.entity_id, r.window_start) for r in found.collect())


@pytest.mark.parametrize("middle", [[], [datetime(2024, 1, 2, 5)]], ids=["empty", "one meter"])
def test_silent_days_between_others_raise_alerts(spark, middle):
    times = [datetime(2024, 1, d, h) for d, h in ((1, 22), (1, 22), (4, 1), (4, 1))] + middle
    first, last = times[0], times[2]
    windows = [first + timedelta(hours=h) for h in range(int((last - first).total_seconds()) // 3600 + 1)]
    want = sorted([("Y", w) for w in windows] + [("Z", w) for w in windows if w not in times])
    readings = parsed(spark, [(1.0, 0.0, at) for at in times])
    assert silent(spark, readings) == want
    assert silent(spark, readings, days=live.meter_days(live.live_readings(readings))) == want


def test_one_meter_vouches_for_no_day_however_often_it_reports(spark):
    times = [datetime(2024, 1, 1, h) for h in (10, 10, 12)]
    odd = [datetime(1970, 1, 1, h) for h in (3, 4, 5)]
    readings = parsed(spark, [(1.0, 0.0, at) for at in times + odd]).withColumn(
        "meter_id", F.when(F.year("event_time") == 1970, "broken").otherwise(F.col("meter_id"))
    )
    days = live.meter_days(live.live_readings(readings))
    assert silent(spark, readings, days=days) == [
        ("Y", datetime(2024, 1, 1, 10)), ("Y", datetime(2024, 1, 1, 11)),
        ("Y", datetime(2024, 1, 1, 12)), ("Z", datetime(2024, 1, 1, 11)),
    ]
    alone = readings.filter("meter_id = 'broken'")
    days = live.meter_days(live.live_readings(alone))
    assert silent(spark, alone, days=days) == [("Y", at) for at in odd]


def test_silent_windows_of_many_blocks(spark, monkeypatch):
    times = [datetime(2024, 1, d, 0) for d in (1, 1, 9, 9)]
    readings = parsed(spark, [(1.0, 0.0, at) for at in times])
    whole = silent(spark, readings)
    monkeypatch.setattr(alerts, "BLOCK", 5)
    assert silent(spark, readings) == whole and len(whole) == 193 + 191


def test_scratch_needs_a_shared_folder_off_local_masters(spark, monkeypatch):
    assert scratch_path(spark, "x")
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_path(Session(), "x")
