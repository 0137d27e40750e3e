"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.check import difference, duck

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "term", "tfidf"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert difference(got, con.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_runs(spark, name):
    assert len(entry.queries()[name](spark, SF).toPandas()) > 0
