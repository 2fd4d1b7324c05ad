"""Every registered query against its SQL on DuckDB, on the smallest data set."""

import pytest

from __spark_entry__ import entry
from check import compare, connect
from logflow.plans import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

# One row per log, a report over everything, or a prefix sum over slice totals.
WHOLE_TABLE_RESULT = {
    "topic_reset",
    "delivery_mode",
    "filter_type_report",
    "decode_policies",
    "stream_progress",
    "partition_round_robin",
    "running_batch_aggregates",
    "lag_trend",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name not in WHOLE_TABLE_RESULT:
        assert "SinglePartition" not in plan
    got = df.toPandas()
    assert compare(got, duck.execute(ORACLES[name]).df()) == "ok"


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0
