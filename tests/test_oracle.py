"""Every registered query that has SQL against it, on the smallest data set."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import differences, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, connection, name):
    _, problem = differences(queries()[name], oracle_sql()[name], spark, connection, FOLDER)
    assert not problem


def test_entry(spark):
    assert entry(spark).count() > 0
