"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
import workload.queries
from tests import compare
from tests.conftest import SMALL

OWN = set(workload.queries.QUERIES)      # the text operators have tests of their own
QUERIES = {k: v for k, v in entry_point.queries().items() if k in OWN}
ORACLE = {k: v for k, v in entry_point.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SMALL), con, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) == OWN


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
