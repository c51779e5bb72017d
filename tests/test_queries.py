"""Every registered query against its SQL on the smallest scale."""

import pytest
from compare import connect, difference
from conftest import TESTDATA

import __spark_entry__ as entry
from docvault.plans import catalog, oracles

QUERIES, SQL = catalog.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(str(TESTDATA))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() == 200


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    ours = QUERIES[name](spark, str(TESTDATA)).toPandas()
    assert difference(ours, db.sql(SQL[name]).df()) is None
