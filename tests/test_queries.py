import pytest

import __spark_entry__ as entry
from tests.compare import compare, database

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


# The corpus operators have tests of their own.
NAMES = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_every_query_has_sql():
    assert set(NAMES) == set(entry.oracle_sql()) - set(entry.LLM_SQL)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["o_orderkey", "o_orderdate", "o_totalprice"]
    assert df.count() > 0
