"""Ranks by ranges and offsets: ties over many ranges, plans, days by themselves."""

from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal as D

from pyspark.sql import functions as F

from wattledger.operators import ranking
from wattledger.operators.ranking import rank_by_amount


def brute(rows):
    out = Counter()
    for g, v in rows:
        ahead = sum(1 for h, w in rows if h == g and w is not None and v is not None and w > v)
        out[g, v, None if v is None else ahead + 1] += 1
    return out


def ranked(spark, rows, partitions=7):
    df = spark.createDataFrame(rows, "g string, v decimal(14,4)").repartition(partitions)
    return Counter((r.g, r.v, r.r) for r in rank_by_amount(df, "g", "v", "r").collect())


def test_half_of_a_day_equal_over_many_ranges(spark):
    rng = random.Random(3)
    rows = [("a", D("5.0000"))] * 800 + [("a", D(rng.randrange(0, 100_000)) / 10_000) for _ in range(700)]
    rows += [("b", D("1.0000"))] * 300 + [("c", None)] * 20 + [(None, D("2.5000"))] * 5 + [("d", D("-1.0000"))]
    rows += [("a", None)] * 10
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g string, v decimal(14,4)")
        spread = ranking._ranges(df, "g", "v", "part").filter("g = 'a' and v = 5")
        assert spread.select("part").distinct().count() >= 3
        assert ranked(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_small_and_empty_groups(spark):
    assert ranked(spark, []) == Counter()
    for rows in ([("a", None)], [("a", D("1.0000"))], [(None, None), ("a", D("0.0000")), ("a", D("0.0000"))]):
        assert ranked(spark, rows) == brute(rows)


def test_rows_are_exchanged_twice(spark):
    """One exchange into ranges before the store, one into their groups after it."""
    df = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").cast("decimal(14,4)").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = rank_by_amount(df, "g", "v", "r")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") <= 2
    assert plan.count("Exchange rangepartitioning") == 0


def test_extra_columns_and_clashing_names_stay(spark):
    df = spark.createDataFrame([("a", D("1.0"), 7, "x")], "g string, v decimal(14,4), part int, before string")
    (row,) = rank_by_amount(df, "g", "v", "r").collect()
    assert row.asDict() == {"g": "a", "v": D("1.0000"), "part": 7, "before": "x", "r": 1}
