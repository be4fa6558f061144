"""Every query against its SQL over the smallest tables."""

import pytest

import __spark_entry__ as entry
import oracle

PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(PATH)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    result = entry.queries()[name](spark, PATH)
    assert oracle.spark_rows(result) == oracle.sql_rows(connection, entry.oracle_sql()[name])


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_approximate_traffic_is_near_the_exact_one(spark):
    queries = entry.queries()
    near = queries["website_traffic"](spark, PATH).first()[0]
    exact = queries["website_traffic_exact"](spark, PATH).first()[0]
    assert abs(near - exact) <= 0.15 * exact
