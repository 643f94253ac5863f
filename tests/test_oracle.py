"""Every registered query that has a SQL twin agrees with it; the rest give rows."""

import pytest

import __spark_entry__ as contract
from tests import oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_agrees_with_sql(spark, con, name):
    assert oracle.difference(spark, con, SF_DIR, name) is None


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["id", "json", "tokens"]
