"""Plan shape checks: pushdown, pruning, partial aggregation, no all-pairs joins."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from basketry.operators import aggregates as A
from basketry.sources.tables import order_lines, transactions


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_no_cartesian_or_nested_loop_join(spark, sf_small, name):
    plan = _plan(E.queries()[name](spark, sf_small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_canonical_view_joins_only_what_is_needed(spark, sf_small):
    plan = _plan(transactions(spark, sf_small, ["customer_id", "total_sales"]))
    assert "orders.parquet" in plan and "lineitem.parquet" in plan
    assert "part.parquet" not in plan and "customer.parquet" not in plan
    plan2 = _plan(transactions(spark, sf_small, ["product_id", "quantity"]))
    assert "orders.parquet" not in plan2


def test_filters_and_columns_reach_the_scan(spark, sf_small):
    df = transactions(spark, sf_small, ["product_id", "quantity"]).where(F.col("quantity") > 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,10.0)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def test_rfm_aggregates_map_side_before_shuffle(spark, sf_small):
    # with a given date the query is lazy; without, the same aggregation is written once first
    df = A.rfm(order_lines(spark, sf_small), amount="order_sales", line_count="n_lines",
               as_of=F.lit("2001-08-01").cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.find("Exchange")
    assert "partial_" in plan
    # the order-level partial aggregation sits below (after) the first exchange in the tree text
    assert plan.find("partial_count", first_exchange) > first_exchange


def test_rfm_query_does_not_read_the_facts_again(spark, sf_small):
    plan = E.queries()["rfm_churn"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "ExistingRDD" in plan


def test_periods_come_from_one_pass(spark, sf_small):
    for name in ("sales_by_period", "sales_by_month_and_week"):
        plan = E.queries()[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lineitem.parquet") == 1
