"""Every registered query equals its SQL."""

import compare
import pytest

import __spark_entry__ as contract
from shelfmark.plans.oracles import SQL
from shelfmark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, sf, duck, name):
    got = compare.from_spark(contract.queries()[name](spark, sf))
    want = compare.from_duckdb(duck, contract.oracle_sql()[name])
    assert compare.difference(got, want) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 200
