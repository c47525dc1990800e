"""Data-quality rows, constraints and the health verdicts built on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattledger.schemas import LIMITS, TOTAL_ENERGY, Limits

RATIO = "decimal(6,4)"


def dq_rows(stats: DataFrame, coverage: DataFrame) -> DataFrame:
    """Named checks per day from the cleaning statistics and the tariff coverage."""
    billed = F.coalesce("household_days", F.lit(0))
    missing = F.coalesce("missing_tariff", F.lit(0))
    unknown = F.coalesce("unknown_tier", F.lit(0))

    def check(name: str, passed: Column, failed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            passed.cast("bigint").alias("passed"),
            failed.cast("bigint").alias("failed"),
        )

    read, removed = F.col("records_read"), F.col("duplicates_removed")
    checks = F.array(
        check("deduplication", read - removed, removed),
        check("plausibility", F.col("records_valid"), F.col("rejected")),
        check("tariff_coverage", billed - missing, missing),
        check("known_tier", billed - missing - unknown, unknown),
    )
    total = (F.col("passed") + F.col("failed")).cast("decimal(18,0)")
    return (
        stats.join(coverage, "sim_date", "left")
        .select(F.col("sim_date").alias("sim_day"), F.inline(checks))
        .withColumn(
            "ratio",
            F.when(total > 0, (F.col("passed").cast("decimal(18,0)") / total).cast(RATIO)),
        )
    )


def latest_checks(checks: DataFrame) -> DataFrame:
    """The newest result of each check of each day."""
    newest = Window.partitionBy("sim_day", "check_name").orderBy(
        F.col("recorded_at").desc(), F.col("run_id").desc()
    )
    return (
        checks.withColumn("place", F.row_number().over(newest))
        .filter(F.col("place") == 1)
        .drop("place")
    )


def coverage_gate(
    bills: DataFrame, expected: int | Column, limits: Limits = LIMITS, days: DataFrame | None = None
) -> DataFrame:
    """Per day: share of the expected households that were billed, and the verdict.

    With ``days`` (sim_day) each of them has a row: a day without a bill fails at 0 %.
    """
    expected = F.lit(expected) if isinstance(expected, int) else expected
    billed = F.col("households_billed")
    pct = (billed.cast("decimal(14,0)") * 100) / F.col("expected_households").cast("decimal(14,0)")
    sums = bills.groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("households_billed"),
        F.sum("total_bill").alias("revenue"),
        F.sum("gross_consumption_kwh").cast(TOTAL_ENERGY).alias("consumption_kwh"),
    )
    if days is not None:
        zero = F.lit(0)
        sums = days.join(sums, "sim_day", "left").select(
            "sim_day",
            *[F.coalesce(c, zero.cast(t)).alias(c) for c, t in sums.dtypes if c != "sim_day"],
        )
    return (
        sums.withColumn("expected_households", expected.cast("bigint"))
        .withColumn(
            "coverage_pct",
            F.when(F.col("expected_households") > 0, pct.cast("decimal(12,1)")).otherwise(
                F.lit(0).cast("decimal(12,1)")
            ),
        )
        .withColumn("passed", F.col("coverage_pct") >= F.lit(limits.min_coverage_pct))
    )


def freshness(now: Column, **tables: tuple[DataFrame, str]) -> DataFrame:
    """Newest write per table and its age in seconds; one row even for an empty table."""
    rows = [
        df.agg(F.max(column).alias("last_write")).select(
            F.lit(name).alias("table_name"), "last_write"
        )
        for name, (df, column) in tables.items()
    ]
    age = F.unix_micros(now) - F.unix_micros("last_write")
    return reduce(DataFrame.unionByName, rows).withColumn(
        "staleness_seconds", (age.cast("decimal(20,0)") / 1_000_000).cast("decimal(12,1)")
    )


# Settled tables are expected to age between runs, so only these two are gated.
LIVE_TABLES = ("rt_zone_load", "rt_household_running")


def freshness_status(fresh: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    age = F.col("staleness_seconds")
    stale = F.col("table_name").isin(*LIVE_TABLES) & (
        age.isNull() | (age > limits.freshness_budget_seconds)
    )
    return fresh.withColumn("is_stale", stale)


def backlog_status(
    running: DataFrame, bills: DataFrame, runs: DataFrame, now: Column, limits: Limits = LIMITS
) -> DataFrame:
    """Days seen live but not settled (one is always in flight) and recent failures."""
    failed_since = now - F.expr("INTERVAL 15 MINUTES")
    days = [
        running.select(F.lit("stream").alias("kind"), F.col("sim_day").cast("string").alias("item")),
        bills.select(F.lit("batch").alias("kind"), F.col("sim_day").cast("string").alias("item")),
        runs.filter((F.col("status") == "FAILED") & (F.col("started_at") > failed_since)).select(
            F.lit("failed").alias("kind"), F.col("run_id").alias("item")
        ),
    ]
    distinct = reduce(DataFrame.unionByName, days).distinct()
    backlog = F.col("stream_days") - F.col("batch_days") - 1
    return (
        distinct.agg(
            F.count_if(F.col("kind") == "stream").alias("stream_days"),
            F.count_if(F.col("kind") == "batch").alias("batch_days"),
            F.count_if(F.col("kind") == "failed").alias("recent_failed_runs"),
        )
        .withColumn("backlog_days", F.greatest(backlog, F.lit(0)))
        .withColumn(
            "is_alert",
            (F.col("backlog_days") > limits.max_backlog_days)
            | (F.col("recent_failed_runs") >= limits.max_failed_runs),
        )
    )


def quality_status(
    checks: DataFrame, now: Column, minutes: int = 30, limits: Limits = LIMITS
) -> DataFrame:
    """Reject ratio per check over the last minutes."""
    total = (F.col("passed") + F.col("failed")).cast("decimal(18,0)")
    ratio = F.col("failed").cast("decimal(18,0)") / total
    return (
        checks.filter(F.col("recorded_at") > now - F.expr(f"INTERVAL {minutes} MINUTES"))
        .groupBy("check_name")
        .agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
        .withColumn(
            "reject_ratio",
            F.when(total > 0, ratio.cast(RATIO)).otherwise(F.lit(0).cast(RATIO)),
        )
        .withColumn("is_breach", F.when(total > 0, ratio > F.lit(limits.max_reject_ratio)).otherwise(False))
    )


def constraint_violations(
    df: DataFrame,
    not_null: tuple[str, ...] = (),
    allowed: dict[str, tuple[str, ...]] | None = None,
    unique: tuple[str, ...] = (),
) -> DataFrame:
    """Violations per declared rule: one pass for the row rules, one for the key."""
    rules = {f"{c} is not null": F.col(c).isNull() for c in not_null}
    for c, values in (allowed or {}).items():
        rules[f"{c} in allowed values"] = F.col(c).isNotNull() & ~F.col(c).isin(*values)
    parts = []
    if rules:
        counted = df.agg(*[F.count_if(broken).alias(f"r{i}") for i, broken in enumerate(rules.values())])
        pairs = F.array(
            *[
                F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
                for i, name in enumerate(rules)
            ]
        )
        parts.append(counted.select(F.inline(pairs)))
    if unique:
        keyed = df.dropna(subset=list(unique))  # as in SQL, a null is never a duplicate
        repeated = keyed.groupBy(*unique).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            repeated.agg(F.count_if(F.col("n") > 1).alias("violations")).select(
                F.lit(f"unique ({', '.join(unique)})").alias("rule"), "violations"
            )
        )
    if not parts:
        raise ValueError("no rule given")
    return reduce(DataFrame.unionByName, parts)


def zone_conflicts(cleaned: DataFrame) -> DataFrame:
    """Household-days reporting from more than one zone; the bill key allows only one."""
    return (
        cleaned.groupBy("sim_date", "household_id")
        .agg(F.count_distinct("grid_zone").alias("zones"))
        .filter(F.col("zones") > 1)
    )


def latest_runs(audit: DataFrame) -> DataFrame:
    """Current state of each run from its appended audit rows."""
    newest = Window.partitionBy("run_id").orderBy(
        F.col("recorded_at").desc(), (F.col("status") == "RUNNING")
    )
    return (
        audit.withColumn("place", F.row_number().over(newest))
        .filter(F.col("place") == 1)
        .drop("place")
    )
