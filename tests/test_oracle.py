"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check import difference, duckdb_on


@pytest.fixture(scope="module")
def connection(small):
    return duckdb_on(small)


def test_every_query_has_sql():
    """The text subpackage has queries that no SQL can express; all others have their SQL."""
    extra = set(entry.registry.queries()) | {"pipeline"} if entry.HAS_LLM else set()
    assert set(entry.queries()) - extra == set(entry.oracle_sql()) - extra
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_equals_sql(spark, connection, small, name):
    assert difference(spark, connection, name, small) is None


def test_entry_has_a_row_per_order(spark):
    df = entry.entry(spark)
    assert df.columns == ["orderid", "order_date", "total_clv", "clv_segment"]
    assert df.count() > 0
