"""Every registered query against its SQL on the smallest tables."""

import re

import pytest
from compare import connect, difference

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert difference(con, entry.oracle_sql()[name], entry.queries()[name](spark, SF)) is None


def test_every_query_of_the_mart_has_sql():
    """The optional ones, named apart, have tests of their own where SQL cannot state the result."""
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert all(re.fullmatch(r"op\d+_.*|pipeline", name) for name in without)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["customer_name", "month", "total_spent"]


def test_known_sizes(spark):
    """Sizes worked out independently for the smallest tables."""
    q = entry.queries()
    assert q["dim_customer"](spark, SF).count() == 133
    assert q["dim_merchant"](spark, SF).count() == 10
    assert q["dim_date"](spark, SF).count() == 2289
    fact = q["fact_transactions"](spark, SF)
    assert fact.count() == 6000
    assert fact.where("customer_id is null").count() == 663
