"""Every contract query against its oracle, on the smallest tables."""

import os

import pytest
from oracle import connect, difference

import __spark_entry__ as contract
from shelfwatch.contract import market, relational, replies, runs, snapshots, upkeep

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


LIBRARY = {**snapshots.QUERIES, **replies.QUERIES, **relational.QUERIES, **runs.QUERIES, **market.QUERIES, **upkeep.QUERIES}


@pytest.mark.parametrize("name", sorted(LIBRARY))
def test_query_matches_oracle(spark, con, name):
    assert difference(contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["timestamp", "timestamp_to", "user_id", "event_type", "kind", "quantity"]
    assert frame.count() > 0
