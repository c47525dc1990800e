"""DuckDB SQL that computes each catalog query on its own from the raw tables.

Percentages and means that are rounded use integer arithmetic on scaled decimals, so
half-way cases are decided exactly and not by binary noise.
"""

from __future__ import annotations

NOW = "TIMESTAMP '2024-01-30 22:30:00'"
CLEAR_SKY = "7.639437268410976::DOUBLE"  # 24 / pi


def scaled(x: str) -> str:
    return f"CAST(({x}) * 100000 AS HUGEINT)"


def half_up(num: str, den: str, factor: int) -> str:
    """round(num * factor / den), for non-negative integers."""
    return f"((2 * {factor} * ({num}) + ({den})) // (2 * ({den})))"


def percent(part: str, whole: str) -> str:
    num, den = scaled(part), scaled(whole)
    return f"CASE WHEN ({whole}) > 0 THEN {half_up(num, den, 10000)} / 100.0::DOUBLE ELSE 0.0::DOUBLE END"


def pad(prefix: str, n: str) -> str:
    s = f"CAST({n} AS VARCHAR)"
    return f"'{prefix}' || lpad({s}, CAST(greatest(length({s}), 5) AS INTEGER), '0')"


def zone(n: str) -> str:
    return (
        f"CASE {n} % 5 WHEN 0 THEN 'ZONE-NORTH' WHEN 1 THEN 'ZONE-SOUTH' WHEN 2 THEN 'ZONE-EAST' "
        "WHEN 3 THEN 'ZONE-WEST' ELSE 'ZONE-CENTRAL' END"
    )


def dbl(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in cols)


BASE = f"""
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type = 'error' AS err
  FROM events),
delivered AS (
  SELECT *, 0 AS copy FROM ev UNION ALL SELECT *, 1 AS copy FROM ev WHERE event_id % 50 = 0),
raw AS (
  SELECT
    CASE WHEN NOT (err AND k BETWEEN 30 AND 34) THEN CAST(event_id AS VARCHAR) END AS event_id,
    {pad('MTR-', 'user_id')} AS meter_id,
    CASE WHEN NOT (err AND k BETWEEN 20 AND 24) THEN {pad('HH-', 'user_id')} END AS household_id,
    {zone('user_id')} AS grid_zone,
    CASE WHEN err AND k < 10 THEN NULL
         WHEN err AND k BETWEEN 10 AND 19 THEN CAST(-value / 10 AS DECIMAL(14,5))
         ELSE CAST(value / 10 AS DECIMAL(14,5)) END AS kwh,
    CASE WHEN k >= 5 THEN CAST(k * CAST(0.04 AS DECIMAL(3,2)) AS DECIMAL(14,5)) END AS solar,
    CASE WHEN k <> 99 THEN CAST(230 + (k - 50) * CAST(0.7 AS DECIMAL(2,1)) AS DECIMAL(7,2)) END AS voltage,
    CASE WHEN NOT (err AND k BETWEEN 25 AND 29) THEN ts END AS event_time,
    CAST(user_id % 6 AS INTEGER) AS kafka_partition,
    event_id * 2 + copy AS kafka_offset
  FROM delivered),
rd AS (
  SELECT *, CAST(event_time AS DATE) AS sim_date,
    CASE WHEN event_id IS NULL THEN 'UNPARSEABLE'
         WHEN event_time IS NULL THEN 'MISSING_EVENT_TIME'
         WHEN household_id IS NULL THEN 'MISSING_HOUSEHOLD'
         WHEN kwh IS NULL THEN 'MISSING_CONSUMPTION'
         WHEN kwh < 0 THEN 'NEGATIVE_CONSUMPTION'
         WHEN kwh > 12 THEN 'IMPLAUSIBLE_CONSUMPTION' END AS reject_reason,
    (voltage IS NULL OR voltage < 200 OR voltage > 255) AS voltage_suspect,
    (household_id IS NOT NULL AND event_time IS NOT NULL AND kwh IS NOT NULL
     AND kwh >= 0 AND kwh <= 12) AS ok
  FROM raw),
dd AS (
  SELECT * FROM rd WHERE event_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY sim_date, event_id ORDER BY kafka_offset, kafka_partition) = 1),
cleaned AS (SELECT * FROM dd WHERE ok),
stats AS (
  SELECT a.sim_date, a.n AS records_read, a.ided - COALESCE(d.n, 0) AS duplicates_removed,
         a.n - a.ided + COALESCE(d.bad, 0) AS rejected, COALESCE(d.good, 0) AS records_valid
  FROM (SELECT sim_date, count(*) AS n, count(event_id) AS ided FROM rd GROUP BY 1) a
  LEFT JOIN (SELECT sim_date, count(*) AS n, count(*) FILTER (ok) AS good,
                    count(*) FILTER (NOT ok) AS bad FROM dd GROUP BY 1) d
    ON a.sim_date IS NOT DISTINCT FROM d.sim_date),
med AS (
  SELECT sim_date, household_id, quantile_disc(solar, 0.5) AS med FROM cleaned GROUP BY 1, 2),
imputed AS (
  SELECT c.*, COALESCE(c.solar, m.med, CAST(0 AS DECIMAL(14,5))) AS filled
  FROM cleaned c LEFT JOIN med m USING (sim_date, household_id)),
refused AS (
  SELECT sim_date, household_id, grid_zone, count(*) AS n FROM dd WHERE NOT ok GROUP BY 1, 2, 3),
sums AS (
  SELECT sim_date, household_id, grid_zone, CAST(sum(kwh) AS DECIMAL(14,5)) AS gross,
         CAST(sum(filled) AS DECIMAL(14,5)) AS solar, count(*) AS readings
  FROM imputed GROUP BY 1, 2, 3),
energy AS (
  SELECT s.*, COALESCE(r.n, 0) AS rejected, least(gross, solar) AS self,
         CAST(greatest(gross - solar, 0) AS DECIMAL(14,5)) AS net,
         CAST(greatest(solar - gross, 0) AS DECIMAL(14,5)) AS exported,
         {percent('least(gross, solar)', 'gross')} AS self_pct
  FROM sums s LEFT JOIN refused r USING (sim_date, household_id, grid_zone)),
tar AS (
  SELECT {pad('HH-', 'c_custkey')} AS household_id, c_custkey % 4 AS tier_no,
         c_custkey % 4 = 0 AND c_custkey % 10 < 7 AS subsidy_flag
  FROM customer WHERE c_acctbal >= -500),
tier(tier_no, billing_tier, rate, standing, cap1, cap2, m2, m3) AS (
  SELECT a::BIGINT, b::VARCHAR, c::DECIMAL(10,4), d::DECIMAL(12,4), e::DECIMAL(6,1), f::DECIMAL(6,1),
         g::DECIMAL(4,2), h::DECIMAL(4,2)
  FROM (VALUES (0, 'DOMESTIC_LOW', 0.14, 0.10, 6, 8, 1.25, 1.60),
               (1, 'DOMESTIC_STD', 0.21, 0.18, 10, 12, 1.30, 1.70),
               (2, 'DOMESTIC_HIGH', 0.28, 0.25, 14, 16, 1.35, 1.80),
               (3, 'COMMERCIAL', 0.33, 0.60, 30, 40, 1.15, 1.30)) v(a, b, c, d, e, f, g, h)),
tariff AS (
  SELECT t.household_id, t.subsidy_flag, x.*,
         CAST(rate * CAST(0.45 AS DECIMAL(3,2)) AS DECIMAL(10,4)) AS export_rate
  FROM tar t JOIN tier x USING (tier_no)),
units AS (
  SELECT e.*, t.billing_tier, t.subsidy_flag, t.rate, t.standing, t.export_rate,
    CASE WHEN t.rate IS NULL THEN NULL ELSE CAST(
      CASE WHEN net <= cap1 THEN CAST(net AS DECIMAL(16,7))
           WHEN net <= cap1 + cap2 THEN cap1 + (net - cap1) * m2
           ELSE cap1 + cap2 * m2 + (net - cap1 - cap2) * m3 END AS DECIMAL(16,7)) END AS units
  FROM energy e LEFT JOIN tariff t USING (household_id)),
charged AS (
  SELECT *, rate * units AS charge, export_rate * exported AS credit,
    CASE WHEN subsidy_flag THEN rate * units * CAST(0.20 AS DECIMAL(3,2))
         ELSE CAST(0 AS DECIMAL(3,2)) END AS subsidy FROM units),
priced AS (SELECT *, charge - credit + standing - subsidy AS total FROM charged),
bill AS (
  SELECT sim_date AS sim_day, household_id, grid_zone, billing_tier, subsidy_flag,
    gross AS gross_consumption_kwh, solar AS solar_generation_kwh, self AS self_consumed_kwh,
    net AS net_import_kwh, exported AS exported_kwh, rate AS tariff_rate, export_rate,
    CAST(charge AS DECIMAL(12,4)) AS energy_charge, CAST(credit AS DECIMAL(12,4)) AS export_credit,
    standing AS standing_charge, CAST(subsidy AS DECIMAL(12,4)) AS subsidy_amount,
    CAST(total AS DECIMAL(12,4)) AS total_bill, self_pct AS self_sufficiency_pct,
    readings AS reading_count, rejected AS rejected_reading_count,
    CAST(sim_date AS TIMESTAMP) + INTERVAL 30 HOUR AS computed_at
  FROM priced WHERE total IS NOT NULL),
settled AS (SELECT * FROM bill WHERE sim_day < DATE '2024-01-20'),
hourly AS (
  SELECT sim_date, grid_zone, CAST(hour(event_time) AS INTEGER) AS hour, sum(kwh) AS load
  FROM cleaned GROUP BY 1, 2, 3),
peak AS (
  SELECT sim_date, grid_zone, hour AS peak_hour, load AS peak_load FROM hourly
  QUALIFY row_number() OVER (PARTITION BY sim_date, grid_zone ORDER BY load DESC, hour) = 1),
dim AS (
  SELECT c_custkey, {pad('HH-', 'c_custkey')} AS household_id, {pad('MTR-', 'c_custkey')} AS meter_id,
    {zone('c_custkey')} AS grid_zone,
    CAST(CAST(0.25 AS DECIMAL(3,2)) + (c_custkey % 9) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(8,3)) AS base_load_kw,
    CAST((c_custkey % 10) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(8,2)) AS solar_capacity_kw,
    CASE c_custkey % 4 WHEN 0 THEN 'DOMESTIC_LOW' WHEN 1 THEN 'DOMESTIC_STD'
         WHEN 2 THEN 'DOMESTIC_HIGH' ELSE 'COMMERCIAL' END AS billing_tier
  FROM customer),
active AS (SELECT * FROM dim WHERE c_custkey IN (SELECT user_id FROM events)),
cap AS (SELECT grid_zone, sum(solar_capacity_kw) AS capacity FROM active GROUP BY 1),
weather AS (
  SELECT sim_date, {zone('zone_no')} AS grid_zone, cloud,
         CAST(1 - 0.75 * cloud / 100 AS DECIMAL(8,4)) AS expected_index
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS sim_date, user_id % 5 AS zone_no,
          (user_id % 5 * 7 + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 13) % 80 + 5 AS cloud
        FROM events)),
ztot AS (
  SELECT sim_date, grid_zone, count(DISTINCT household_id) AS households, count(total) AS households_priced,
         sum(gross) AS cons, sum(solar) AS solar, sum(net) AS net, sum(total) AS revenue
  FROM priced GROUP BY 1, 2),
zd0 AS (
  SELECT z.*, p.peak_hour, p.peak_load, w.expected_index,
    CASE WHEN CAST(c.capacity AS DOUBLE) * {CLEAR_SKY} > 0
         THEN CAST(z.solar AS DOUBLE) / (CAST(c.capacity AS DOUBLE) * {CLEAR_SKY}) END AS actual
  FROM ztot z LEFT JOIN peak p USING (sim_date, grid_zone) LEFT JOIN cap c USING (grid_zone)
  LEFT JOIN weather w USING (sim_date, grid_zone)),
zd AS (
  SELECT sim_date AS sim_day, grid_zone, households, households_priced,
    CAST(cons AS DOUBLE) AS total_consumption_kwh, CAST(solar AS DOUBLE) AS total_solar_kwh,
    CAST(net AS DOUBLE) AS net_import_kwh, {percent('solar', 'cons')} AS renewable_contribution_pct,
    peak_hour, CAST(peak_load AS DOUBLE) AS peak_load_kwh,
    CAST(expected_index AS DOUBLE) AS forecast_solar_index, round(actual, 4) AS actual_solar_index,
    CASE WHEN actual > 0 THEN round((CAST(expected_index AS DOUBLE) - actual) / actual * 100.0, 2) END
      AS solar_forecast_error_pct,
    CAST(CAST(COALESCE(revenue, 0) AS DECIMAL(14,4)) AS DOUBLE) AS total_revenue
  FROM zd0),
lv AS (
  SELECT *, COALESCE(solar, CAST(0 AS DECIMAL(14,5))) AS solar0 FROM rd WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY sim_date, event_id ORDER BY kafka_offset, kafka_partition) = 1),
zw AS (
  SELECT grid_zone, date_trunc('hour', event_time) AS ws, sum(kwh) AS cons, sum(solar0) AS solar,
    count(DISTINCT meter_id) AS meters, count(*) AS n,
    CAST(sum(voltage) FILTER (NOT voltage_suspect) * 100 AS HUGEINT) AS vsum,
    count(*) FILTER (NOT voltage_suspect) AS vn
  FROM lv GROUP BY 1, 2),
zl AS (
  SELECT grid_zone, ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, CAST(ws AS DATE) AS sim_day,
    cons AS total_consumption_kwh, solar AS total_solar_kwh, greatest(cons - solar, 0) AS net_import_kwh,
    least({percent('solar', 'cons')}, 999.99::DOUBLE) AS renewable_pct, meters AS active_meters,
    CASE WHEN vn > 0 THEN {half_up('vsum', 'vn', 1)} / 100.0::DOUBLE END AS avg_voltage, n AS reading_count
  FROM zw),
hr AS (
  SELECT household_id, sim_date AS sim_day, grid_zone, sum(kwh) AS consumption_kwh, sum(solar0) AS solar_kwh,
    greatest(sum(kwh) - sum(solar0), 0) AS net_import_kwh, count(*) AS reading_count,
    max(event_time) AS last_seen
  FROM lv GROUP BY 1, 2, 3),
merged AS (
  SELECT sim_day, household_id, grid_zone, gross_consumption_kwh AS consumption_kwh,
    solar_generation_kwh AS solar_kwh, net_import_kwh, CAST(total_bill AS DOUBLE) AS total_bill,
    reading_count, 'batch' AS source, TRUE AS is_final, computed_at AS as_of FROM settled
  UNION ALL
  SELECT sim_day, household_id, grid_zone, consumption_kwh, solar_kwh, net_import_kwh, NULL,
    reading_count, 'speed', FALSE, last_seen FROM hr r
  WHERE NOT EXISTS (SELECT 1 FROM settled b WHERE b.sim_day = r.sim_day AND b.household_id = r.household_id)),
low AS (
  SELECT 'LOW_RENEWABLE_CONTRIBUTION' AS alert_type, 'WARNING' AS severity, 'zone' AS entity_type,
    grid_zone AS entity_id, sim_day, window_start, renewable_pct AS metric_value, 15.0::DOUBLE AS threshold,
    'Zone ' || grid_zone || ' renewable contribution '
      || CAST(CAST(CAST(renewable_pct AS DECIMAL(6,2)) AS DECIMAL(6,1)) AS VARCHAR)
      || '% is below the 15% floor' AS message
  FROM zl WHERE total_consumption_kwh > 0 AND renewable_pct < 15.0),
over AS (
  SELECT 'ZONE_OVERLOAD' AS alert_type, 'CRITICAL' AS severity, 'zone' AS entity_type,
    grid_zone AS entity_id, sim_day, window_start,
    CAST(CAST(total_consumption_kwh AS DECIMAL(14,2)) AS DOUBLE) AS metric_value, 30.0::DOUBLE AS threshold,
    'Zone ' || grid_zone || ' load ' || CAST(CAST(total_consumption_kwh AS DECIMAL(14,1)) AS VARCHAR)
      || ' kWh exceeds 30 kWh in one window' AS message
  FROM zl WHERE total_consumption_kwh > 30),
spike AS (
  SELECT 'CONSUMPTION_SPIKE' AS alert_type, 'WARNING' AS severity, 'household' AS entity_type,
    household_id AS entity_id, sim_day, last_seen AS window_start,
    {half_up(scaled('consumption_kwh'), '10 * reading_count', 1)} / 10000.0::DOUBLE AS metric_value,
    4.0::DOUBLE AS threshold,
    'Household ' || household_id || ' averaging '
      || CAST(CAST({half_up(scaled('consumption_kwh'), '1000 * reading_count', 1)} / 100.0 AS DECIMAL(14,2)) AS VARCHAR)
      || ' kWh per reading, well above baseline' AS message
  FROM hr WHERE {scaled('consumption_kwh')} > 400000 * reading_count),
span AS (SELECT min(window_start) AS a, max(window_start) AS b FROM zl),
silent AS (
  SELECT 'ZONE_SILENT' AS alert_type, 'CRITICAL' AS severity, 'zone' AS entity_type, z.grid_zone AS entity_id,
    CAST(z.ws AS DATE) AS sim_day, z.ws AS window_start, 0.0::DOUBLE AS metric_value, 1.0::DOUBLE AS threshold,
    'Zone ' || z.grid_zone || ' reported no active meters in this window' AS message
  FROM (SELECT grid_zone, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ws
        FROM (SELECT DISTINCT grid_zone FROM dim), span) z
  WHERE NOT EXISTS (SELECT 1 FROM zl WHERE zl.grid_zone = z.grid_zone AND zl.window_start = z.ws)),
alerts AS (
  SELECT * FROM low UNION ALL SELECT * FROM over UNION ALL SELECT * FROM spike UNION ALL SELECT * FROM silent),
alert_log AS (SELECT *, window_start + INTERVAL 1 HOUR AS created_at FROM alerts),
cover AS (
  SELECT sim_date, count(*) AS household_days, count(*) FILTER (rate IS NULL) AS missing_tariff,
    count(*) FILTER (rate IS NOT NULL AND total IS NULL) AS unknown_tier
  FROM priced GROUP BY 1),
dq0 AS (
  SELECT s.*, COALESCE(household_days, 0) AS hd, COALESCE(missing_tariff, 0) AS mt, COALESCE(unknown_tier, 0) AS ut
  FROM stats s LEFT JOIN cover c USING (sim_date) WHERE s.sim_date IS NOT NULL),
dq1 AS (
  SELECT sim_date, 'deduplication' AS check_name, records_read - duplicates_removed AS passed, duplicates_removed AS failed FROM dq0
  UNION ALL SELECT sim_date, 'plausibility', records_valid, rejected FROM dq0
  UNION ALL SELECT sim_date, 'tariff_coverage', hd - mt, mt FROM dq0
  UNION ALL SELECT sim_date, 'known_tier', hd - mt - ut, ut FROM dq0),
dq AS (
  SELECT sim_date AS sim_day, check_name, CAST(passed AS BIGINT) AS passed, CAST(failed AS BIGINT) AS failed,
    CASE WHEN passed + failed > 0 THEN {half_up('passed', 'passed + failed', 10000)} / 10000.0::DOUBLE END AS ratio,
    'batch-' || CAST(sim_date AS VARCHAR) AS run_id,
    CAST(sim_date AS TIMESTAMP) + INTERVAL 30 HOUR AS recorded_at
  FROM dq1),
runs AS (
  SELECT 'batch-' || CAST(sim_date AS VARCHAR) AS run_id, 'batch' AS layer, 'billing_reconciliation' AS job_name,
    sim_date AS sim_day, CASE WHEN rejected * 6 > records_read THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CAST(records_read AS BIGINT) AS records_in, CAST(records_valid AS BIGINT) AS records_out,
    CAST(sim_date AS TIMESTAMP) + INTERVAL 30 HOUR AS started_at
  FROM stats WHERE sim_date IS NOT NULL),
published AS (
  SELECT DISTINCT CAST(ts AS DATE) AS sim_date FROM events
  WHERE date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) % 11 <> 10),
complete AS (
  SELECT sim_date FROM published p
  WHERE EXISTS (SELECT 1 FROM published q WHERE q.sim_date = p.sim_date + 1)),
pending AS (
  SELECT sim_date FROM complete INTERSECT SELECT sim_date FROM rd WHERE event_time IS NOT NULL
  EXCEPT SELECT sim_day FROM settled)
"""

ENERGY_COLS = dbl("gross_consumption_kwh", "solar_generation_kwh", "self_consumed_kwh", "net_import_kwh", "exported_kwh")
BILL_OUT = (
    "sim_day, household_id, grid_zone, billing_tier, subsidy_flag, " + ENERGY_COLS + ", "
    + dbl("tariff_rate", "export_rate", "energy_charge", "export_credit", "standing_charge", "subsidy_amount", "total_bill")
    + ", self_sufficiency_pct, reading_count, rejected_reading_count"
)
REPORT_OUT = (
    "sim_day, grid_zone, household_id, billing_tier, subsidy_flag, "
    + dbl("gross_consumption_kwh", "solar_generation_kwh", "net_import_kwh", "exported_kwh")
    + ", self_sufficiency_pct, "
    + dbl("tariff_rate", "energy_charge", "export_credit", "subsidy_amount", "standing_charge", "total_bill")
    + ", bill_rank"
)
RANKED = "(SELECT *, rank() OVER (PARTITION BY sim_day ORDER BY total_bill DESC) AS bill_rank FROM bill)"
ZL_OUT = (
    "grid_zone, window_start, window_end, sim_day, "
    + dbl("total_consumption_kwh", "total_solar_kwh", "net_import_kwh")
    + ", renewable_pct, active_meters, avg_voltage, reading_count"
)
HR_OUT = "household_id, sim_day, grid_zone, " + dbl("consumption_kwh", "solar_kwh", "net_import_kwh") + ", reading_count, last_seen"
MERGED_OUT = (
    "sim_day, household_id, grid_zone, " + dbl("consumption_kwh", "solar_kwh", "net_import_kwh")
    + ", total_bill, reading_count, source, is_final, as_of"
)
ALERT_OUT = "alert_type, severity, entity_type, entity_id, sim_day, window_start, metric_value, threshold, message"
LATEST = "(SELECT * FROM zl {where} QUALIFY row_number() OVER (PARTITION BY grid_zone ORDER BY window_start DESC) = 1)"


def solar_factor(hour: str, cloud: str) -> str:
    shape = f"sin(pi() * (({hour} - 6.0::DOUBLE) / 12.0::DOUBLE)) * (1.0::DOUBLE - 0.75::DOUBLE * CAST({cloud} AS DOUBLE) / 100.0::DOUBLE)"
    return (
        f"CASE WHEN {hour} > 6 AND {hour} < 18 THEN "
        f"CAST(CAST(CAST({shape} AS DECIMAL(12,8)) AS DECIMAL(12,4)) AS DOUBLE) ELSE 0.0::DOUBLE END"
    )


def demand_factor(hour: str) -> str:
    a, b = f"({hour} - 7.0::DOUBLE)", f"({hour} - 19.5::DOUBLE)"
    shape = (
        f"0.55::DOUBLE + 0.6::DOUBLE * exp(-({a} * {a}) / 2.0::DOUBLE)"
        f" + 0.84::DOUBLE * exp(-({b} * {b}) / 3.0::DOUBLE)"
    )
    return f"CAST(CAST(CAST({shape} AS DECIMAL(12,8)) AS DECIMAL(12,4)) AS DOUBLE)"


STREAM_LATENESS = "INTERVAL 15 MINUTE"
# What a piece-wise replay keeps: a late event comes one piece later and counts if the
# watermark of the pieces before has not passed the end of its window.
LATE = f"""
arrived AS (
  SELECT *, least(p + CASE WHEN CAST(event_id AS BIGINT) % 5 = 3 THEN 1 ELSE 0 END, 2) AS piece,
    date_trunc('hour', event_time) + INTERVAL 1 HOUR AS closes
  FROM (SELECT *, CASE WHEN event_time < TIMESTAMP '2024-01-10 12:00:00' THEN 0
                       WHEN event_time < TIMESTAMP '2024-01-20 12:00:00' THEN 1 ELSE 2 END AS p FROM lv)),
marks AS (
  SELECT n, (SELECT max(event_time) FROM arrived WHERE piece < n) - {STREAM_LATENESS} AS mark
  FROM (SELECT unnest([0, 1, 2]) AS n)),
lv AS (SELECT a.* FROM arrived a JOIN marks ON n = piece WHERE mark IS NULL OR closes > mark)"""


def late_base() -> str:
    """The base relations with the windows taken of the kept readings."""
    before, zone_windows, after = BASE.partition("\nzw AS (")
    return before + LATE.replace("lv AS (SELECT a", "kept AS (SELECT a") + "," + zone_windows + after.replace(
        "FROM lv GROUP BY 1, 2),\nzl", "FROM kept GROUP BY 1, 2),\nzl", 1
    )


SETTLED_SPAN = "sim_day < DATE '2024-01-20'"

BODIES = {
    "stream_zone_silent": f"""
        SELECT {ALERT_OUT} FROM silent s
        WHERE s.window_start + INTERVAL 1 HOUR <= (SELECT max(event_time) FROM lv) - {STREAM_LATENESS}""",
    "stream_late_readings": f"SELECT {ZL_OUT.replace('active_meters, ', '')} FROM zl",
    "settled_bills": f"SELECT {BILL_OUT}, 'settle-1' AS batch_run_id FROM settled",
    "settled_zones": f"SELECT *, 'settle-1' AS batch_run_id FROM zd WHERE {SETTLED_SPAN}",
    "settled_checks": f"""
        SELECT sim_day, check_name, passed, failed, ratio, 'settle-1' AS run_id,
          'billing_reconciliation' AS job_name, 'batch' AS stage FROM dq WHERE {SETTLED_SPAN}""",
    "settled_runs": """
        SELECT 'settle-1' AS run_id, 'batch' AS layer, 'billing_reconciliation' AS job_name,
          (SELECT min(sim_date) FROM rd) AS sim_day, 'SUCCESS' AS status,
          (SELECT CAST(sum(records_read) AS BIGINT) FROM stats WHERE sim_date < DATE '2024-01-20') AS records_in,
          (SELECT count(*) FROM settled) AS records_out, FALSE AS has_error
        UNION ALL
        SELECT 'settle-2', 'batch', 'billing_reconciliation', (SELECT min(sim_date) FROM rd), 'FAILED',
          CAST(0 AS BIGINT), CAST(0 AS BIGINT), TRUE""",
    "pending_from_folders": "SELECT sim_date FROM pending",
    "merged_from_tables": f"SELECT {MERGED_OUT.removesuffix(', as_of')} FROM merged",
    "freshness_from_files": """
        SELECT t AS table_name, TRUE AS has_files, FALSE AS is_stale, t <> 'batch_household_bill' AS is_stale_later
        FROM (SELECT unnest(['rt_zone_load', 'rt_household_running', 'batch_household_bill']) AS t)""",
    "report_csv": f"SELECT {REPORT_OUT} FROM {RANKED} r WHERE r.{SETTLED_SPAN}",
    "stream_zone_window": f"SELECT {ZL_OUT.replace('active_meters, ', '')} FROM zl",
    "stream_zone_alerts": f"""
        SELECT {ALERT_OUT} FROM low UNION ALL
        SELECT 'ZONE_OVERLOAD', 'CRITICAL', 'zone', grid_zone, sim_day, window_start,
          CAST(CAST(total_consumption_kwh AS DECIMAL(14,2)) AS DOUBLE), 45.0::DOUBLE,
          'Zone ' || grid_zone || ' load ' || CAST(CAST(total_consumption_kwh AS DECIMAL(14,1)) AS VARCHAR)
            || ' kWh exceeds 45 kWh in one window' FROM zl WHERE total_consumption_kwh > 45""",
    "stream_household_day": f"SELECT {HR_OUT} FROM hr",
    "stream_upsert_restarted": f"SELECT {HR_OUT} FROM hr",
    "stream_archive": """
        SELECT CASE WHEN event_id IS NOT NULL THEN sim_date END AS sim_date, reject_reason, count(*) AS readings,
          count(*) FILTER (reject_reason IS NOT NULL) AS payloads_kept, max(kafka_offset) AS last_offset
        FROM rd GROUP BY 1, 2""",
    "stream_dead_letters": """
        SELECT CASE WHEN event_id IS NOT NULL THEN household_id END AS key, event_id,
          CASE WHEN event_id IS NOT NULL THEN household_id END AS household_id, reject_reason, kafka_offset
        FROM rd WHERE reject_reason IS NOT NULL""",
    "household_bill": f"SELECT {BILL_OUT} FROM bill",
    "readings_parsed": """
        SELECT kafka_partition, kafka_offset, event_id,
          CASE WHEN p THEN meter_id END AS meter_id, CASE WHEN p THEN household_id END AS household_id,
          CASE WHEN p THEN grid_zone END AS grid_zone,
          CASE WHEN reject_reason IS NULL THEN CAST(kwh AS DOUBLE) ELSE 0.0::DOUBLE END AS consumption_kwh,
          CASE WHEN p THEN COALESCE(CAST(solar AS DOUBLE), 0.0::DOUBLE) ELSE 0.0::DOUBLE END AS solar_kwh,
          CASE WHEN p THEN CAST(voltage AS DOUBLE) END AS voltage,
          CASE WHEN p THEN event_time END AS event_time, CASE WHEN p THEN sim_date END AS sim_date,
          reject_reason, reject_reason IS NULL AS is_valid,
          CASE WHEN p THEN voltage_suspect ELSE TRUE END AS voltage_suspect,
          CASE WHEN p THEN solar IS NULL ELSE TRUE END AS solar_missing,
          CASE WHEN p THEN 1706745600 - epoch_us(event_time) / 1000000::DOUBLE END AS ingest_lag_s
        FROM (SELECT *, event_id IS NOT NULL AS p FROM rd)""",
    "reading_validation": """
        SELECT reject_reason, count(*) AS readings, count(*) FILTER (voltage_suspect) AS voltage_suspects,
          count(*) FILTER (solar IS NULL) AS solar_missing FROM rd GROUP BY 1""",
    "dead_letter": """
        SELECT event_id, CASE WHEN event_id IS NOT NULL THEN household_id END AS household_id,
          CASE WHEN event_id IS NOT NULL THEN grid_zone END AS grid_zone, reject_reason,
          kafka_partition, kafka_offset
        FROM rd WHERE reject_reason IS NOT NULL""",
    "readings_deduplicated": """
        SELECT event_id, sim_date, household_id, kafka_partition, kafka_offset, reject_reason FROM dd""",
    "clean_stats": "SELECT sim_date, records_read, duplicates_removed, rejected, records_valid FROM stats",
    "dq_metrics": "SELECT sim_day, check_name, passed, failed, ratio, run_id, recorded_at FROM dq",
    "solar_imputed": f"""
        SELECT event_id, sim_date, household_id, CAST(kwh AS DOUBLE) AS consumption_kwh,
          CAST(solar AS DOUBLE) AS solar_measured_kwh, CAST(filled AS DOUBLE) AS solar_kwh FROM imputed""",
    "household_energy": """
        SELECT sim_date, household_id, grid_zone, CAST(gross AS DOUBLE) AS gross_consumption_kwh,
          CAST(solar AS DOUBLE) AS solar_generation_kwh, readings AS reading_count,
          rejected AS rejected_reading_count, CAST(self AS DOUBLE) AS self_consumed_kwh,
          CAST(net AS DOUBLE) AS net_import_kwh, CAST(exported AS DOUBLE) AS exported_kwh,
          self_pct AS self_sufficiency_pct FROM energy""",
    "unpriced_households": """
        SELECT sim_date, household_id, grid_zone, CAST(gross AS DOUBLE) AS gross_consumption_kwh,
          CAST(net AS DOUBLE) AS net_import_kwh FROM priced WHERE total IS NULL""",
    "tariff_coverage": "SELECT * FROM cover",
    "hourly_zone_load": "SELECT sim_date, grid_zone, hour, CAST(load AS DOUBLE) AS hour_load_kwh FROM hourly",
    "zone_peak_hour": "SELECT sim_date, grid_zone, peak_hour, CAST(peak_load AS DOUBLE) AS peak_load_kwh FROM peak",
    "clear_sky_potential": f"""
        SELECT grid_zone, CAST(sum(solar_capacity_kw) AS DOUBLE) AS zone_capacity_kw,
          CAST(sum(solar_capacity_kw) AS DOUBLE) * {CLEAR_SKY} AS clear_sky_kwh FROM dim GROUP BY 1""",
    "zone_daily": "SELECT * FROM zd",
    "zones_of_day": "SELECT * FROM zd WHERE sim_day = DATE '2024-01-15'",
    "solar_forecast_error": """
        SELECT sim_day, grid_zone, forecast_solar_index, actual_solar_index, solar_forecast_error_pct
        FROM zd""",
    "live_zone_window_approx": "SELECT grid_zone, window_start, active_meters, TRUE AS within_bound FROM zl",
    "solar_out_of_range": """
        SELECT sim_date, count(solar) AS solar_readings,
          count(*) FILTER (solar * 1000 >= 1 AND kafka_offset % 97 = 0) AS solar_out_of_range
        FROM rd GROUP BY 1""",
    "live_zone_window": f"SELECT {ZL_OUT} FROM zl",
    "live_household_day": f"SELECT {HR_OUT} FROM hr",
    "duplicate_scaled_zone_window": f"""
        SELECT grid_zone, ws AS window_start, ws + INTERVAL 1 HOUR AS window_end,
          {half_up(scaled('c') + ' * d', 'n', 1)} / 100000.0::DOUBLE AS total_consumption_kwh,
          {half_up(scaled('s') + ' * d', 'n', 1)} / 100000.0::DOUBLE AS total_solar_kwh,
          {half_up(scaled('greatest(c - s, 0)') + ' * d', 'n', 1)} / 100000.0::DOUBLE AS net_import_kwh,
          {percent('s', 'c')} AS renewable_pct, d AS reading_count, n - d AS duplicates
        FROM (SELECT grid_zone, date_trunc('hour', event_time) AS ws, sum(kwh) AS c,
                sum(COALESCE(solar, CAST(0 AS DECIMAL(14,5)))) AS s, count(*) AS n,
                count(DISTINCT event_id) AS d
              FROM rd WHERE reject_reason IS NULL GROUP BY 1, 2)""",
    "alerts_low_renewable": f"SELECT {ALERT_OUT} FROM low",
    "alerts_overload": f"SELECT {ALERT_OUT} FROM over",
    "alerts_spike": f"SELECT {ALERT_OUT} FROM spike",
    "alerts_zone_silent": f"SELECT {ALERT_OUT} FROM silent",
    "alerts_all": f"SELECT {ALERT_OUT} FROM alerts",
    "alert_summary": f"""
        SELECT alert_type, severity, count(*) AS alerts FROM alert_log
        WHERE created_at > {NOW} - INTERVAL 360 MINUTE GROUP BY 1, 2""",
    "alerts_recent": f"""
        SELECT {ALERT_OUT}, created_at FROM alert_log WHERE severity = 'CRITICAL'
        ORDER BY created_at DESC, alert_type, entity_id LIMIT 50""",
    "household_daily_merged": f"SELECT {MERGED_OUT} FROM merged",
    "merged_source_counts": "SELECT source, count(*) AS rows FROM merged GROUP BY 1",
    "merged_households_top": f"""
        SELECT {MERGED_OUT} FROM merged m WHERE grid_zone = 'ZONE-EAST'
        ORDER BY m.sim_day DESC, m.consumption_kwh DESC, m.household_id LIMIT 200""",
    "household_history": f"""
        SELECT d.household_id, d.meter_id, d.grid_zone, {dbl('d.base_load_kw', 'd.solar_capacity_kw')},
          d.billing_tier, h.sim_day, {dbl('h.consumption_kwh', 'h.solar_kwh', 'h.net_import_kwh')},
          h.total_bill, h.reading_count, h.source, h.is_final, h.as_of
        FROM dim d LEFT JOIN (SELECT * FROM merged WHERE household_id = 'HH-00007'
                              ORDER BY sim_day DESC LIMIT 14) h USING (household_id)
        WHERE d.household_id = 'HH-00007'""",
    "zone_latest": f"SELECT {ZL_OUT} FROM {LATEST.format(where='')}",
    "zone_latest_completed": f"SELECT {ZL_OUT} FROM {LATEST.format(where=f'WHERE window_end <= {NOW}')}",
    "grid_total": f"""
        SELECT CAST(sum(total_consumption_kwh) AS DOUBLE) AS load_kwh, CAST(sum(total_solar_kwh) AS DOUBLE) AS solar_kwh,
          CAST(sum(active_meters) AS BIGINT) AS active_meters, count(*) AS zones_reporting, max(window_end) AS as_of,
          {percent('sum(total_solar_kwh)', 'sum(total_consumption_kwh)')} AS renewable_pct
        FROM {LATEST.format(where='')}""",
    "zone_history": f"SELECT {ZL_OUT} FROM zl WHERE grid_zone = 'ZONE-EAST' ORDER BY window_start DESC LIMIT 48",
    "billing_report_ranked": f"SELECT {REPORT_OUT} FROM {RANKED}",
    "billing_top": f"""
        SELECT {REPORT_OUT} FROM {RANKED} r WHERE sim_day = DATE '2024-01-15'
        ORDER BY r.total_bill DESC, household_id LIMIT 50""",
    "report_kpis": f"""
        SELECT sim_day, count(*) AS households_billed, CAST(sum(gross_consumption_kwh) AS DOUBLE) AS consumption_kwh,
          CAST(sum(solar_generation_kwh) AS DOUBLE) AS solar_kwh, CAST(sum(total_bill) AS DOUBLE) AS revenue,
          {percent('sum(solar_generation_kwh)', 'sum(gross_consumption_kwh)')} AS renewable_pct
        FROM bill GROUP BY 1""",
    "complete_days": "SELECT sim_date FROM complete",
    "pending_days": "SELECT sim_date FROM pending",
    "next_pending_day": "SELECT min(sim_date) AS sim_date FROM pending",
    "coverage_gate": f"""
        SELECT *, coverage_pct >= 80 AS passed FROM (
          SELECT sim_day, n AS households_billed, revenue, consumption_kwh,
            (SELECT count(*) FROM active) AS expected_households,
            {half_up('n', '(SELECT count(*) FROM active)', 1000)} / 10.0::DOUBLE AS coverage_pct
          FROM (
            SELECT a.sim_day, count(b.household_id) AS n, COALESCE(CAST(sum(total_bill) AS DOUBLE), 0) AS revenue,
              COALESCE(CAST(sum(gross_consumption_kwh) AS DOUBLE), 0) AS consumption_kwh
            FROM (SELECT sim_date AS sim_day FROM published UNION SELECT sim_date + 1 FROM published) a
            LEFT JOIN bill b ON b.sim_day = a.sim_day GROUP BY 1))""",
    "freshness_status": f"""
        SELECT *, table_name <> 'batch_household_bill' AND (staleness_seconds IS NULL OR staleness_seconds > 180) AS is_stale
        FROM (SELECT table_name, last_write,
                CASE WHEN us < 0 THEN -((-us + 50000) // 100000) ELSE (us + 50000) // 100000 END / 10.0::DOUBLE AS staleness_seconds
              FROM (SELECT table_name, last_write, epoch_us({NOW}) - epoch_us(last_write) AS us FROM (
                SELECT 'rt_zone_load' AS table_name, max(window_end) AS last_write FROM zl
                UNION ALL SELECT 'rt_household_running', max(last_seen) FROM hr
                UNION ALL SELECT 'batch_household_bill', max(computed_at) FROM settled)))""",
    "backlog_status": """
        SELECT *, backlog_days > 3 OR recent_failed_runs >= 3 AS is_alert FROM (
          SELECT stream_days, batch_days, recent_failed_runs, greatest(stream_days - batch_days - 1, 0) AS backlog_days
          FROM (SELECT (SELECT count(DISTINCT sim_day) FROM hr) AS stream_days,
                       (SELECT count(DISTINCT sim_day) FROM settled) AS batch_days,
                       (SELECT count(*) FROM runs WHERE status = 'FAILED'
                          AND started_at > TIMESTAMP '2024-01-20' - INTERVAL 15 MINUTE) AS recent_failed_runs))""",
    "quality_status": f"""
        SELECT check_name, CAST(p AS BIGINT) AS passed, CAST(f AS BIGINT) AS failed,
          CASE WHEN p + f > 0 THEN {half_up('f', 'p + f', 10000)} / 10000.0::DOUBLE ELSE 0.0::DOUBLE END AS reject_ratio,
          CASE WHEN p + f > 0 THEN 4 * f > p + f ELSE FALSE END AS is_breach
        FROM (SELECT check_name, sum(passed) AS p, sum(failed) AS f FROM dq
              WHERE recorded_at > {NOW} - INTERVAL 7 DAY GROUP BY 1)""",
    "latest_dq_checks": """
        SELECT sim_day, check_name, run_id || '-2' AS run_id, passed + failed AS passed, CAST(0 AS BIGINT) AS failed FROM dq""",
    "recent_runs": "SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 25",
    "recent_checks": """
        SELECT sim_day, check_name, passed, failed, ratio, run_id, recorded_at FROM dq
        ORDER BY recorded_at DESC, check_name LIMIT 50""",
    "constraint_violations": """
        SELECT 'event_id is not null' AS rule, count(*) FILTER (event_id IS NULL) AS violations FROM rd
        UNION ALL SELECT 'household_id is not null', count(*) FILTER (household_id IS NULL) FROM rd
        UNION ALL SELECT 'grid_zone is not null', count(*) FILTER (grid_zone IS NULL) FROM rd
        UNION ALL SELECT 'power_consumption_kwh is not null', count(*) FILTER (kwh IS NULL) FROM rd
        UNION ALL SELECT 'severity in allowed values', count(*) FILTER (reject_reason IS NOT NULL) FROM rd
        UNION ALL SELECT 'unique (event_id)', count(*) FROM (
          SELECT event_id FROM rd WHERE event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""",
    "run_constraints": """
        SELECT rule, CAST(0 AS BIGINT) AS violations FROM (
          SELECT unnest(['run_id is not null', 'job_name is not null', 'started_at is not null',
            'layer in allowed values', 'status in allowed values', 'unique (run_id)']) AS rule)""",
    "zone_conflicts": """
        SELECT sim_date, household_id, count(*) AS zones FROM (
          SELECT DISTINCT sim_date, household_id,
            CASE WHEN voltage_suspect THEN 'ZONE-NORTH' ELSE grid_zone END AS grid_zone FROM cleaned)
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "expected_solar_by_hour": f"""
        SELECT m.sim_date, m.grid_zone, m.hour, m.measured_kwh, m.readings, f AS solar_factor,
          CAST(c.capacity AS DOUBLE) * f AS expected_kwh
        FROM (SELECT m.*, {solar_factor('m.hour', 'w.cloud')} AS f FROM (
                SELECT sim_date, grid_zone, CAST(hour(event_time) AS INTEGER) AS hour,
                  CAST(COALESCE(sum(solar), 0) AS DOUBLE) AS measured_kwh, count(solar) AS readings
                FROM cleaned GROUP BY 1, 2, 3) m JOIN weather w USING (sim_date, grid_zone)) m
        JOIN cap c USING (grid_zone)""",
    "expected_demand_deviation": f"""
        SELECT sim_date, household_id, hour, m AS measured_kwh, CAST(base_load_kw AS DOUBLE) * f AS expected_kwh,
          m - CAST(base_load_kw AS DOUBLE) * f AS deviation_kwh
        FROM (SELECT h.*, {demand_factor('h.hour')} AS f FROM (
                SELECT sim_date, household_id, CAST(hour(event_time) AS INTEGER) AS hour, CAST(sum(kwh) AS DOUBLE) AS m
                FROM cleaned GROUP BY 1, 2, 3) h) JOIN dim USING (household_id)""",
}


def oracle_sql() -> dict[str, str]:
    own = {"stream_late_readings": late_base()}
    return {name: f"WITH {own.get(name, BASE)} {body}" for name, body in BODIES.items()}
