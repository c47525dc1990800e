"""Validity rules for one reading."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wattledger.schemas import LIMITS, Limits


def reject_reason(limits: Limits = LIMITS) -> Column:
    """The first rule a reading breaks, or null.

    Runs on the decoded values, before any narrowing cast: NaN compares above every
    number in Spark, so it is reported as implausible.
    """
    kwh = F.col("power_consumption_kwh")
    rules = [  # The codes are fixed values.
        ("UNPARSEABLE", F.col("event_id").isNull()),
        ("MISSING_EVENT_TIME", F.col("event_time").isNull()),
        ("MISSING_HOUSEHOLD", F.col("household_id").isNull()),
        ("MISSING_CONSUMPTION", kwh.isNull()),
        ("NEGATIVE_CONSUMPTION", kwh < 0),
        ("IMPLAUSIBLE_CONSUMPTION", kwh > F.lit(limits.max_plausible_kwh)),
    ]
    return F.coalesce(*[F.when(broken, F.lit(reason)) for reason, broken in rules])


def voltage_suspect(limits: Limits = LIMITS) -> Column:
    """Power-quality flag; it never rejects the energy reading."""
    v = F.col("voltage")
    return v.isNull() | ~v.between(F.lit(limits.min_voltage), F.lit(limits.max_voltage))


def billable(limits: Limits = LIMITS) -> Column:
    """The exact rule of the settled bill, applied whatever the stream decided."""
    return (
        F.col("household_id").isNotNull()
        & F.col("event_time").isNotNull()
        & F.coalesce(
            F.col("power_consumption_kwh").between(F.lit(0), F.lit(limits.max_plausible_kwh)),
            F.lit(False),
        )
    )
