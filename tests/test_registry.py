"""Every named query gives the rows of its plain SQL."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert contract.QUERIES.keys() == contract.ORACLE.keys()


@pytest.mark.parametrize("name", sorted(contract.ORACLE))
def test_query_matches_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert differences(frame, contract.oracle_sql()[name], duck) == []


def test_entry(spark):
    assert contract.entry(spark).count() == 391
