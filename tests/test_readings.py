"""Decoding, the reject cascade, de-duplication and cleaning statistics on edge rows."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from wattledger.operators import clean, live, parse
from wattledger.schemas import MESSAGE

AT = datetime(2024, 1, 1, 12)
GOOD = {
    "event_id": "e1", "meter_id": "m1", "household_id": "h1", "grid_zone": "Z1",
    "power_consumption_kwh": 1.5, "solar_generation_kwh": 0.5, "voltage": 230.0,
    "timestamp": "2024-01-01T12:00:00", "sim_day": "2024-01-01", "ingest_ts": 1704110400.0,
    "quality_flags": ["LATE"], "producer_run_id": "r",
}


def messages(spark, payloads):
    rows = [(i % 3, i, AT, p if isinstance(p, str) or p is None else json.dumps(p))
            for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, MESSAGE)


def verdicts(spark, payloads):
    parsed = parse.parse_messages(messages(spark, payloads)).orderBy("kafka_offset").collect()
    return [r.reject_reason for r in parsed], parsed


def test_cascade_reports_the_first_broken_rule(spark):
    without = lambda *keys: {k: v for k, v in GOOD.items() if k not in keys}
    cases = [
        (GOOD, None),
        ("not json", "UNPARSEABLE"),
        ("", "UNPARSEABLE"),
        (None, "UNPARSEABLE"),
        (without("event_id", "timestamp"), "UNPARSEABLE"),
        (without("timestamp", "household_id"), "MISSING_EVENT_TIME"),
        ({**GOOD, "timestamp": "yesterday"}, "MISSING_EVENT_TIME"),
        (without("household_id", "power_consumption_kwh"), "MISSING_HOUSEHOLD"),
        (without("power_consumption_kwh"), "MISSING_CONSUMPTION"),
        ({**GOOD, "power_consumption_kwh": "much"}, "MISSING_CONSUMPTION"),
        ({**GOOD, "power_consumption_kwh": -0.1}, "NEGATIVE_CONSUMPTION"),
        ({**GOOD, "power_consumption_kwh": 12.0}, None),
        ({**GOOD, "power_consumption_kwh": 12.00001}, "IMPLAUSIBLE_CONSUMPTION"),
        ({**GOOD, "power_consumption_kwh": 1e300}, "IMPLAUSIBLE_CONSUMPTION"),
        (json.dumps({**GOOD, "power_consumption_kwh": float("nan")}), "IMPLAUSIBLE_CONSUMPTION"),
    ]
    got, _ = verdicts(spark, [c for c, _ in cases])
    assert got == [w for _, w in cases]


def test_flags_and_null_safe_values(spark):
    _, rows = verdicts(
        spark,
        [GOOD, {**GOOD, "voltage": None, "solar_generation_kwh": None}, {**GOOD, "voltage": 199.9},
         {**GOOD, "voltage": 255.0}, "not json"],
    )
    assert [r.voltage_suspect for r in rows] == [False, True, True, False, True]
    assert [r.solar_missing for r in rows] == [False, True, False, False, True]
    assert rows[0].solar_kwh == Decimal("0.5") and rows[1].solar_kwh == 0
    assert rows[4].consumption_kwh == 0 and rows[4].payload == "not json"


def test_ingest_lag_uses_the_given_clock(spark):
    now = F.lit("2024-01-01 12:00:30").cast("timestamp")
    assert parse.parse_messages(messages(spark, [GOOD]), now).first().ingest_lag_s == 30.0


def test_dead_letter_json_leaves_out_nulls(spark):
    parsed = parse.parse_messages(messages(spark, ["not json", GOOD]))
    (row,) = parse.dead_letter_messages(parsed).collect()
    assert row.key is None
    assert json.loads(row.value) == {
        "reject_reason": "UNPARSEABLE", "payload": "not json", "kafka_partition": 0,
        "kafka_offset": 0,
    }


def raw(spark, rows):
    """(event_id, household, kwh, solar, hour, offset)"""
    return spark.createDataFrame(
        [(e, h, k, s, datetime(2024, 1, 1, hr) if hr is not None else None, o)
         for e, h, k, s, hr, o in rows],
        "event_id string, household_id string, power_consumption_kwh double, "
        "solar_generation_kwh double, event_time timestamp, kafka_offset bigint",
    ).withColumns(
        {
            "grid_zone": F.lit("Z"), "kafka_partition": F.lit(0),
            "sim_date": F.to_date("event_time"),
        }
    )


def test_first_delivery_decides_and_is_judged_after_dedup(spark):
    rows = [
        ("a", "h", 99.0, None, 1, 1), ("a", "h", 1.0, None, 1, 2),  # first copy is refused
        ("b", "h", 2.0, None, 1, 4), ("b", "h", 3.0, None, 1, 3),  # offset 3 came first
        (None, "h", 1.0, None, 1, 5), (None, "h", 1.0, None, 1, 6),
        ("c", "h", float("nan"), None, 1, 7), ("d", None, 1.0, None, 1, 8),
        ("e", "h", 1.0, None, None, 9),
    ]
    data = raw(spark, rows)
    cleaned = clean.clean(data).collect()
    assert [(r.event_id, r.consumption_kwh) for r in cleaned] == [("b", Decimal(3))]
    stats = {r.sim_date: r for r in clean.clean_stats(data).collect()}
    day = next(r for d, r in stats.items() if d is not None)
    assert (day.records_read, day.duplicates_removed, day.rejected, day.records_valid) == (8, 2, 5, 1)
    assert stats[None].rejected == 1
    for r in stats.values():
        assert r.records_read == r.duplicates_removed + r.rejected + r.records_valid


def test_a_third_of_all_rows_being_one_event_is_thinned_before_the_shuffle(spark):
    hot = [("hot", "h", 1.0, 1.0, 1, i) for i in range(2000)]
    rest = [(f"e{i}", f"h{i % 7}", 1.0, 2.0, 2, 5000 + i) for i in range(4000)]
    data = raw(spark, hot + rest).repartition(6)
    cleaned = clean.deduplicate(data)
    assert cleaned.count() == 4001
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    stats = clean.clean_stats(data).first()
    assert (stats.records_read, stats.duplicates_removed) == (6000, 1999)


def test_imputation_matches_brute_force(spark):
    rows, offset = [], 0
    for h in range(5):
        for i in range(9 + h):
            solar = None if i % 3 == 0 else float((i * 7 + h) % 5)
            rows.append((f"{h}-{i}", f"h{h}", 1.0, solar, i % 24, offset := offset + 1))
    rows.append(("x", "gaps only", 1.0, None, 1, offset + 1))
    got = {r.event_id: r.solar_kwh for r in clean.impute_solar(clean.clean(raw(spark, rows))).collect()}
    by_house = {}
    for e, h, _, s, *_ in rows:
        by_house.setdefault(h, []).append(s)
    for e, h, _, s, *_ in rows:
        known = sorted(v for v in by_house[h] if v is not None)
        want = s if s is not None else (known[(len(known) - 1) // 2] if known else 0)
        assert got[e] == Decimal(str(want)), e


def test_scaled_view_equals_exact_view_without_duplicates(spark):
    parsed = parse.parse_messages(
        messages(spark, [{**GOOD, "event_id": f"e{i}", "power_consumption_kwh": i / 7} for i in range(40)])
    )
    exact = live.zone_load(parsed).first()
    scaled = live.duplicate_scaled_zone_load(parsed).first()
    assert exact.total_consumption_kwh == scaled.total_consumption_kwh
    assert scaled.duplicates == 0


def test_reject_counts(spark):
    parsed = parse.parse_messages(messages(spark, [GOOD, GOOD, "x"]))
    got = Counter({r.reject_reason: r.readings for r in parse.reject_counts(parsed).collect()})
    assert got == {None: 2, "UNPARSEABLE": 1}
