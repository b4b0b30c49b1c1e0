"""Every registered query against its SQL oracle on the small tables."""

import pytest

import __spark_entry__ as contract
from sedimenta.plans.oracles import ORACLES
from sedimenta.plans.queries import QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    same_columns, actual, expected = compare(df, duck, contract.oracle_sql()[name])
    assert same_columns
    assert len(actual) == len(expected)
    assert actual == expected
    assert actual
