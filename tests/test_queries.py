"""Every registered query that has SQL gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import differences, duck

CHECKS = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return duck(folder)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_rows_as_sql(spark, folder, connection, name):
    got = entry.queries()[name](spark, folder).toPandas()
    want = connection.execute(CHECKS[name]).df()
    assert differences(got, want) is None


def test_entry(spark):
    result = entry.entry(spark)
    assert len(result.columns) == 27
    assert result.count() > 0
