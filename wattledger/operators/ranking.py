"""Exact RANK() over large groups: sorted ranges, and their offsets.

A plain ``rank()`` sorts a whole group in one task. Here rows are sorted over many tasks by
group and amount, ranked within each range, and raised by the number of rows in the ranges
before. A range is known by one row per group in it: how many rows it has, and its first
and last amount with their ranks. Those rows are few, one per range and group, so what
moves between tasks besides the rows themselves doesn't grow with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window, functions as F

from wattledger.session import settle

def _ranges(rows: DataFrame, group: str, amount: str, part: str) -> DataFrame:
    """The rows with the number of their range, ascending by group and descending by amount.

    Equal amounts fall into as many ranges as they fill, by a random number that only
    decides which of them.
    """
    salt = f"{part}_salt"
    dealt = rows.withColumn(salt, F.rand(1)).repartitionByRange(F.col(group), F.col(amount).desc(), salt)
    return dealt.withColumn(part, F.spark_partition_id()).drop(salt)


def _raised(edges: DataFrame) -> DataFrame:
    """Per range and group: the rows before it (``before``) and the rank at which its first
    amount begins (``lead``), maybe in an earlier range."""
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    known = edges.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ends = F.array(
        F.struct(F.col("first").alias("value"), (F.col("before") + 1).alias("at")),
        F.struct(F.col("last").alias("value"), (F.col("before") + F.col("last_rank")).alias("at")),
    )
    begins = known.select(F.col("g").alias("of"), F.inline(ends)).groupBy("of", "value").agg(F.min("at").alias("lead"))
    same = F.col("g").eqNullSafe(F.col("of")) & (F.col("first") == F.col("value"))
    return known.join(begins, same).select("part", "g", "first", "before", "lead")


def rank_by_amount(rows: DataFrame, group: str, amount: str, rank: str) -> DataFrame:
    """``RANK() OVER (PARTITION BY group ORDER BY amount DESC)``; null for a null amount.

    The rank is one plus the number of rows of the group with a greater amount. Rows are
    exchanged twice, whatever their amounts: once into sorted ranges, which are stored, and
    once into the groups of each range. No task has more than a range, also if most amounts
    of a group are equal.
    """
    part = f"range_{uuid.uuid4().hex[:8]}"
    ranges = settle(_ranges(rows, group, amount, part), "ranges")
    within = Window.partitionBy(part, group).orderBy(F.col(amount).desc_nulls_last())
    ranked = ranges.withColumn(rank, F.rank().over(within))
    known = F.col(amount).isNotNull()
    edges = ranked.filter(known).groupBy(F.col(part).alias("part"), F.col(group).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.max(amount).alias("first"), F.min(amount).alias("last"),
        F.max(rank).alias("last_rank"),
    )
    raised = settle(_raised(settle(edges, "range-edges")), "range-offsets")
    offsets = raised.select(*[F.col(c).alias(f"{part}_{c}") for c in raised.columns])
    of = lambda name: F.col(f"{part}_{name}")
    total = F.when(F.col(amount) == of("first"), of("lead")).otherwise(of("before") + F.col(rank))
    joined = ranked.join(
        offsets, (F.col(part) == of("part")) & F.col(group).eqNullSafe(of("g")), "left"
    )
    return joined.withColumn(rank, F.when(known, total)).select(*rows.columns, rank)
