"""Every query with check SQL gives the rows DuckDB gives on the same files."""

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, sf_dir, duck, name):
    found = differences(duck, contract.oracle_sql()[name], contract.queries()[name](spark, sf_dir))
    assert not found, "\n".join(found)
