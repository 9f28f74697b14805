"""Every registered query against its SQL on the smallest data, and shapes of the plans that matter at scale."""

import os

import compare
import pytest

import __spark_entry__ as contract
from tidemark.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare.differences(spark, con, name, QUERIES[name], ORACLES[name], FOLDER) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert "ytd_revenue" in df.columns and df.count() > 0


def plan(spark, name):
    return contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["gold_customer_360", "mart_customer_360", "gold_hourly_traffic", "join_inner", "dedup_latest", "top1_per_group"]
)
def test_no_single_task_exchange(spark, name):
    assert "SinglePartition" not in plan(spark, name)


def test_no_query_uses_python_workers_or_cartesian_products(spark):
    for name in ("gold_customer_360", "mart_product_performance", "fact_orders", "silver_reviews", "dim_date", "run_metrics"):
        text = plan(spark, name)
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_the_columns_asked_for(spark):
    text = plan(spark, "scan_parquet")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text
