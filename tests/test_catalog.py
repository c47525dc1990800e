"""Every query of the catalog against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

# The smallest tables hold no zone window above the overload limit.
MAY_BE_EMPTY = {"alerts_overload"}
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(tables_dir):
    return connect(tables_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables_dir, duck, name):
    df = QUERIES[name](spark, tables_dir)
    if name not in SQL:
        assert df.count() > 0
        return
    difference, rows = compare(df, duck, SQL[name])
    assert difference is None
    assert rows > 0 or name in MAY_BE_EMPTY


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_is_the_bill(spark):
    df = entry.entry(spark)
    assert "total_bill" in df.columns
    assert df.count() > 0
