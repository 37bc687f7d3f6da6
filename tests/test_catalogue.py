"""Each query of the engine's own operators against its SQL."""

import pytest
from oracle import differences

from folioforge.plans import catalogue_documents  # noqa: F401  # it adds its queries
from folioforge.plans.catalogue import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert differences(spark, sf_dir, QUERIES[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 1
    assert set(e.oracle_sql()) <= set(e.queries())
