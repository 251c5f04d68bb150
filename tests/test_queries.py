import pytest

import __spark_entry__ as driver
from tests.oracle import both, connect, normal

QUERIES = driver.queries()
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, connection, sf_dir, name):
    mine, theirs = both(spark, connection, sf_dir, QUERIES[name], ORACLES[name])
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert len(mine) > 0
    assert normal(mine) == normal(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    result = driver.entry(spark)
    assert result.count() > 0
    assert "distance_from_customer_address" in result.columns
