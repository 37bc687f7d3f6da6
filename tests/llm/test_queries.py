"""The registered queries: against their SQL, and that all run."""

import pytest
from oracle import differences

from folioforge.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert differences(spark, sf_dir, QUERIES[name], ORACLE_SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
