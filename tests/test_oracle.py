"""Every query with a SQL counterpart agrees with it exactly."""

import pytest

import __spark_entry__ as entry
from testbed.compare import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_agrees_with_sql(spark, duck, name):
    assert differences(spark, duck, name, SF) is None


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
