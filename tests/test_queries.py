"""Every core query with SQL against DuckDB, every other one for a stable schema, on the smallest tables."""

import pytest

from foliate.plans import registry

from .helpers import from_spark, from_sql


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, small, name):
    assert from_spark(registry.QUERIES[name](spark, small)) == from_sql(registry.SQL[name], small)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, small, name):
    df = registry.QUERIES[name](spark, small)
    assert len(set(df.columns)) == len(df.columns)
    df.count()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
