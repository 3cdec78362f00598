"""Every registered query: values against its SQL, and the shape of its plan."""

import check
import pytest

import __spark_entry__ as entry
from rowrelay.plans.oracle import all_oracles
from rowrelay.plans.queries import all_queries

QUERIES, SQL = all_queries(), all_oracles()
STREAMS = {"stream_route", "stream_resume", "job_initial", "job_latest", "job_timestamp", "job_latest_offsets", "job_counters", "partition_order", "waves_order"}


@pytest.fixture(scope="module")
def duck():
    return check.connect("/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_values(spark, duck, small, name):
    assert check.compare(QUERIES[name](spark, small), duck, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_plan(spark, small, name):
    """No cross join, no Python in the path, no whole-table task."""
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in plan
    if name != "log_end":
        assert "SinglePartition" not in plan


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["topic", "partition", "op", "records"]
    assert {tuple(r) for r in frame.collect() if r.topic == "mysqlbinlog_ddl"} == {("mysqlbinlog_ddl", 0, None, 25)}


def test_published_counts(spark):
    """Routing and replay of the log at the larger scale, as published with the fixtures."""
    folder = "/root/testdata/sf0.01"
    counts = {tuple(r)[:3]: r.records for r in QUERIES["routed_counts"](spark, folder).collect()}
    order, customer = "mysqlbinlog_test_tb_order", "mysqlbinlog_crm_tb_customer"
    wanted = {(customer, p, "c"): 375 for p in range(4)}
    wanted |= {(order, p, "c"): 3750 for p in range(4)} | {(order, p, "u"): 1250 for p in range(4)}
    wanted |= {(order, 0, "d"): 3000, ("mysqlbinlog_ddl", 0, None): 25}
    assert counts == wanted
    state = QUERIES["replay_state"](spark, folder).selectExpr("count(*) AS n", "sum(CAST(price AS DECIMAL(14,2))) AS s")
    assert tuple(map(str, state.first())) == ("13500", "3024318619.01")
