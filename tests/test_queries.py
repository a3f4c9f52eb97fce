"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.compare import compare
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(name, spark, con):
    assert compare(contract.queries()[name](spark, SMALL), con, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize(
    "name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_runs(name, spark):
    assert contract.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
