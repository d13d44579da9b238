"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

NAMES = list(entry.QUERIES)


@pytest.fixture(scope="module")
def db(data):
    return connect(data)


def test_every_query_has_its_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, data, db, name):
    assert differences(entry.queries()[name](spark, data), db, entry.oracle_sql()[name]) is None
