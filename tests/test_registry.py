"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tapeflow.plans.registry import REGISTRY
from tests.oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"

# At this scale the last five minutes hold no event of that type.
MAY_BE_EMPTY = {"panel_up", "panel_messages"}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    problem = compare(spark, con, name, queries()[name], oracle_sql()[name], SMALL)
    assert problem is None or (problem == "empty result" and name in MAY_BE_EMPTY)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["time", "trade_id", "price", "quantity", "notional"]
    assert 0 < df.count() <= 100
