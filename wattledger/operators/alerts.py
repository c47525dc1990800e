"""Threshold rules over the live tables, all producing the same nine columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wattledger.operators.live import WINDOW
from wattledger.schemas import ALERT_COLUMNS, LIMITS, Limits

METRIC = "decimal(22,4)"
# Windows spelled out from one row.
BLOCK = 4096


def _digits(value: Column, places: int) -> Column:
    return value.cast(f"decimal(22,{places})").cast("string")


def _alert(kind, severity, entity_type, entity, at, metric, threshold, message) -> Column:
    return F.struct(
        F.lit(kind).alias("alert_type"),
        F.lit(severity).alias("severity"),
        F.lit(entity_type).alias("entity_type"),
        entity.alias("entity_id"),
        F.col("sim_day"),
        at.alias("window_start"),
        metric.cast(METRIC).alias("metric_value"),
        F.lit(threshold).cast(METRIC).alias("threshold"),
        message.alias("message"),
    )


# The message texts below are fixed values.


def _low_renewable(limits: Limits) -> tuple[Column, Column]:
    pct, zone, floor = F.col("renewable_pct"), F.col("grid_zone"), limits.renewable_low_pct
    broken = (F.col("total_consumption_kwh") > 0) & (pct < F.lit(floor).cast(METRIC))
    text = F.concat(
        F.lit("Zone "), zone, F.lit(" renewable contribution "), _digits(pct, 1),
        F.lit(f"% is below the {floor:.0f}% floor"),
    )
    return broken, _alert(
        "LOW_RENEWABLE_CONTRIBUTION", "WARNING", "zone", zone, F.col("window_start"), pct, floor,
        text,
    )


def _overload(limits: Limits) -> tuple[Column, Column]:
    load, zone, limit = F.col("total_consumption_kwh"), F.col("grid_zone"), limits.zone_overload_kwh
    text = F.concat(
        F.lit("Zone "), zone, F.lit(" load "), _digits(load, 1),
        F.lit(f" kWh exceeds {limit:.0f} kWh in one window"),
    )
    return load > F.lit(limit).cast(METRIC), _alert(
        "ZONE_OVERLOAD", "CRITICAL", "zone", zone, F.col("window_start"),
        load.cast("decimal(22,2)"), limit, text,
    )


def _raise(rows: DataFrame, rules: list[tuple[Column, Column]]) -> DataFrame:
    """All rules in one pass over the rows."""
    hits = F.array_compact(F.array(*[F.when(broken, alert) for broken, alert in rules]))
    return rows.select(F.inline(hits)).select(*ALERT_COLUMNS)


def zone_alerts(zone_load: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    return _raise(zone_load, [_low_renewable(limits), _overload(limits)])


def low_renewable_alerts(zone_load: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    return _raise(zone_load, [_low_renewable(limits)])


def overload_alerts(zone_load: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    return _raise(zone_load, [_overload(limits)])


def spike_alerts(running: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Households whose mean reading is too high to be a customer's behaviour."""
    limit = limits.max_plausible_kwh / limits.spike_factor
    mean = F.col("consumption_kwh") / F.col("reading_count").cast("decimal(18,0)")
    rows = running.filter(F.col("reading_count") > 0).withColumn("mean_kwh", mean)
    text = F.concat(
        F.lit("Household "), F.col("household_id"), F.lit(" averaging "),
        _digits(F.col("mean_kwh"), 2), F.lit(" kWh per reading, well above baseline"),
    )
    return _raise(
        rows,
        [
            (
                F.col("mean_kwh") > F.lit(limit).cast("decimal(14,10)"),
                _alert(
                    "CONSUMPTION_SPIKE", "WARNING", "household", F.col("household_id"),
                    F.col("last_seen"), F.col("mean_kwh"), limit, text,
                ),
            )
        ],
    )


def _load_days(zone_load: DataFrame) -> DataFrame:
    """``live.meter_days`` as far as counts per window tell: a meter counts in each window."""
    return zone_load.groupBy(F.to_date("window_start").alias("day")).agg(
        F.min("window_start").alias("first"),
        F.max("window_start").alias("last"),
        (F.sum("active_meters") >= 2).alias("vouched"),
    )


def silent_between(
    ends: DataFrame, zone_load: DataFrame, zones: DataFrame, width: str = WINDOW
) -> DataFrame:
    """Alerts of the windows from ``first`` to ``last`` (one row, null for none) in which a
    zone is absent.

    A zone without readings has no row to test, so the expected windows are spelled out
    (zones of the dimension times windows, whatever the number of readings) and the
    present ones removed. Windows are spelled out by blocks on many tasks.
    """
    step = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {width}"))
    names = zones.agg(F.collect_set("grid_zone")).scalar()
    spans = ends.filter(F.col("first").isNotNull()).select(
        F.unix_micros("first").alias("first"), step.alias("step"),
        F.expr("unix_micros(last) - unix_micros(first)").alias("reach"),
    ).withColumn("most", F.expr("reach div step"))
    # A count of partitions of its own, else blocks of few bytes end in one task.
    tasks = int(zone_load.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = spans.withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"most div {BLOCK}")))
    ).repartition(tasks, "block")
    begin = F.col("block") * BLOCK
    expected = blocks.withColumn(
        "at", F.explode(F.sequence(begin, F.least(begin + (BLOCK - 1), "most")))
    ).select(
        F.timestamp_micros(F.col("first") + F.col("at") * F.col("step")).alias("window_start"),
        F.explode(names).alias("grid_zone"),
    )
    absent = expected.join(
        zone_load.filter(F.col("active_meters") > 0).select("grid_zone", "window_start"),
        ["grid_zone", "window_start"],
        "left_anti",
    ).withColumn("sim_day", F.to_date("window_start"))
    text = F.concat(
        F.lit("Zone "), F.col("grid_zone"), F.lit(" reported no active meters in this window")
    )
    return _raise(
        absent,
        [
            (
                F.lit(True),
                _alert(
                    "ZONE_SILENT", "CRITICAL", "zone", F.col("grid_zone"), F.col("window_start"),
                    F.lit(0), 1, text,
                ),
            )
        ],
    )


def silent_zone_alerts(
    zone_load: DataFrame, zones: DataFrame, width: str = WINDOW, days: DataFrame | None = None
) -> DataFrame:
    """Windows in which a zone is absent, from the first to the last that counts.

    ``days`` are the ``live.meter_days``. Days on which two meters
    report set the first and the last window, so a meter whose clock is off by decades
    does not; between them every window is expected, also on days without readings. If no
    day has two meters, all days count.
    """
    ends = (_load_days(zone_load) if days is None else days).agg(
        *[
            F.coalesce(end(F.when(F.col("vouched"), F.col(c))), end(c)).alias(c)
            for c, end in (("first", F.min), ("last", F.max))
        ]
    )
    return silent_between(ends, zone_load, zones, width)


def all_alerts(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
