"""Which day is to be settled next."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def complete_days(published: DataFrame) -> DataFrame:
    """A day is over only once the next day has been published too."""
    following = published.select(F.date_sub("sim_date", 1).alias("sim_date"))
    return published.join(following, "sim_date", "left_semi").select("sim_date")


def pending_days(published: DataFrame, archived: DataFrame, billed: DataFrame) -> DataFrame:
    """Complete days with raw data and no bill yet, oldest first.

    Each input is a relation of days; distinct days are few whatever the data size.
    """
    return (
        complete_days(published)
        .intersect(archived.select("sim_date"))
        .subtract(billed.select("sim_date"))
        .orderBy("sim_date")
    )


def next_day(pending: DataFrame) -> DataFrame:
    return pending.agg(F.min("sim_date").alias("sim_date"))
