"""Every query with SQL gives the rows of its SQL, with the same names and kinds of types."""

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, db, name):
    assert oracle.differences(QUERIES[name], SQL[name], spark, db, FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, name):
    assert not QUERIES[name](spark, FOLDER).isEmpty()


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    found = {row.equivalent for row in entry.entry(spark).collect()}
    assert {True, False} <= found
