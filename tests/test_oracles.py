"""Every registered query with an oracle agrees with DuckDB on the smallest tables."""

import pytest
from oracle import connect, differences

from tickloom.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_registry_is_consistent():
    import __spark_entry__ as contract

    assert set(ORACLES) <= set(QUERIES)
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    problems = [p for p in differences(QUERIES[name](spark, SF), duck, ORACLES[name]) if p != "oracle returned no rows"]
    assert not problems


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).limit(1).count() == 1
