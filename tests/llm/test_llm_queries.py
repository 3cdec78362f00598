"""Registered queries against their SQL, and their shape."""

import check
import pytest

import __spark_entry__ as entry
from rowrelay.llm.oracle import all_oracles
from rowrelay.llm.queries import all_queries

QUERIES, SQL = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    return check.connect("/root/testdata/sf0.001")


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_values(spark, duck, small, name):
    assert check.compare(QUERIES[name](spark, small), duck, SQL[name]) == ""
