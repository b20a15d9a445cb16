import pytest
from compare import compare, connect
from conftest import SF

import __spark_entry__ as driver


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, tables, name):
    result = driver.queries()[name](spark, SF)
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        compare(result, sql, tables)


def test_entry(spark, tables):
    compare(driver.entry(spark), driver.oracle_sql()["exact_dedup"], tables)
