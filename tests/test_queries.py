import pytest
from compare import TESTDATA, compare, connect

import __spark_entry__ as entry
from footfall.plans import oracle, registry

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES, SQL = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR, QUERIES[name], SQL[name]) is None


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
