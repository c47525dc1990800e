"""Physical plans: pruning, pre-aggregation, no Python and no cross joins."""

from __future__ import annotations

import pytest

from wattledger.plans.catalog import BATCH_QUERIES
from wattledger.session import pin_utc


def plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def of(spark, tables_dir, name) -> str:
    return plan(BATCH_QUERIES[name](pin_utc(spark), tables_dir))


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_python_and_no_cross_join(spark, tables_dir, name):
    text = BATCH_QUERIES[name](pin_utc(spark), tables_dir)._jdf.queryExecution().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in text


def test_bill_deduplicates_once(spark, tables_dir):
    text = of(spark, tables_dir, "household_bill")
    assert "ReusedExchange" in text
    assert text.count("events.parquet") == 1


def test_scan_reads_only_used_columns(spark, tables_dir):
    text = of(spark, tables_dir, "clear_sky_potential")
    assert "ReadSchema: struct<c_custkey:bigint>" in text


@pytest.mark.parametrize(
    "name", ["readings_deduplicated", "zone_latest", "zone_peak_hour", "household_bill"]
)
def test_first_row_per_key_is_limited_before_the_shuffle(spark, tables_dir, name):
    assert of(spark, tables_dir, name).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["zone_history", "alerts_recent", "merged_households_top"])
def test_top_rows_use_bounded_sort(spark, tables_dir, name):
    assert "TakeOrderedAndProject" in of(spark, tables_dir, name)


def test_merged_view_uses_an_anti_join(spark, tables_dir):
    assert "LeftAnti" in of(spark, tables_dir, "household_daily_merged")


def test_filter_on_the_merged_view_reaches_both_branches(spark, tables_dir):
    text = of(spark, tables_dir, "household_history")
    assert text.count("= HH-00007") >= 2
