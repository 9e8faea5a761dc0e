"""Queries over line items read them a bounded number of times: what comes back hangs on written rows."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Small tables of our own: an order twice, lines without an order, null customers and dates."""
    at = tmp_path_factory.mktemp("star")
    day = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    orders = [(i, i % 7 + 1, "1-URGENT" if i % 3 else "5-LOW", "O", day[i * 7 % 40]) for i in range(60)]
    orders += [orders[5], (60, None, "2-HIGH", "F", day[3]), (61, 2, None, "F", None)]
    lines = [(i % 64, i % 4 + 1, i % 9 + 1, i % 5 + 1, float(i % 11), 100.0 + i * 7 % 300, (i % 10) / 100, "N", day[i % 40])
             for i in range(400)] + [(3, 1, 2, 1, None, 50.0, 0.0, "N", day[0]), (None, 1, 1, 1, 2.0, 9.0, 0.0, "N", day[0])]
    frames = {
        "lineitem": (lines, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, "
                            "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string, "
                           "o_orderdate timestamp"),
        "customer": ([(i, f"C{i}", 900.0 * i, "AUTO" if i % 2 else "HOME", i % 3) for i in range(1, 8)],
                     "c_custkey long, c_name string, c_acctbal double, c_mktsegment string, c_nationkey long"),
        "part": ([(i, f"P{i}", f"T{i % 3}", "B", 1, 10.0) for i in range(1, 9)],
                 "p_partkey long, p_name string, p_type string, p_brand string, p_size int, p_retailprice double"),
        "nation": ([(i, f"N{i}", i % 2) for i in range(3)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": ([(i, f"R{i}") for i in range(2)], "r_regionkey long, r_name string")}
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return str(at)


def plan(df) -> str:
    return df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("name", ["clv_top_customers", "daily_fourier_forecast", "basic_feature_table",
                                  "advanced_feature_table"])
def test_lines_are_read_before_the_answer(spark, star, name):
    df = E.queries()[name](spark, star)
    assert "l_orderkey" not in plan(df)
    assert df.count() > 0


def test_order_totals_give_the_lines_means(spark, star):
    from basketry.operators import aggregates as A
    from basketry.sources.tables import order_totals, transactions
    tx = transactions(spark, star, ["transaction_id", "customer_id", "transaction_date", "quantity", "unit_price",
                                    "total_sales"])
    per_order = order_totals(spark, star, {"spent": "quantity * unit_price", "total_sales": "total_sales"},
                             ["customer_id", "transaction_date"])
    for want, got in ((A.customer_metrics(tx), A.customer_metrics(per_order, line_count="n_lines", spent="spent")),
                      (A.customer_lifetime_value(tx), A.customer_lifetime_value(per_order, line_count="n_lines"))):
        want, got = (f.toPandas().sort_values("customer_id").reset_index(drop=True) for f in (want, got))
        pd.testing.assert_frame_equal(want, got, check_dtype=False)


def test_rows_read_on_by_their_own_bound(spark):
    """One far row in a block does not make the block's other rows read distant blocks."""
    import numpy as np
    from basketry.models import neighbours as N
    x = np.array([[0.0, 0.0], [0.1, 0.0], [9.0, 0.0]])
    rid = np.array([7, 8, 9])

    class Boxes:
        value = (np.array([0, 1]), np.array([2, 2]), np.array([[0.0, 0.0], [10.0, 0.0]]), np.array([[1.0, 0.0], [11.0, 0.0]]))
    block = pd.DataFrame([{"q_block": 0, "q_lo": x.min(0).tobytes(), "q_hi": x.max(0).tobytes(), "q_rid": rid.tobytes(),
                           "q_vec": x.tobytes(), "found_rid": [9, 8, 7], "found_edge": [8.0, 0.5, 0.5]}])
    out = pd.concat(N._further_pairs(Boxes, 2, 2)([block]))
    assert [list(np.frombuffer(b, np.int64)) for b in out["q_rid"]] == [[9]]


def same_rows(a, b, by):
    a, b = (f.toPandas().sort_values(by).reset_index(drop=True) for f in (a, b))
    pd.testing.assert_frame_equal(a, b[list(a.columns)], check_dtype=False)


@pytest.mark.parametrize("name", ["basic_feature_table", "advanced_feature_table"])
def test_features_come_without_joins_of_lines(spark, star, name):
    df = E.queries()[name](spark, star)
    assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_customer_values_of_dealt_lines(spark, star):
    """Windows over rows that are dealt by customer give what the joins give, without a customer or a date too."""
    from basketry.operators import aggregates as A
    from basketry.operators import windows as Wn
    from basketry.sources.tables import transactions
    line = ["transaction_id", "line_number", "product_id", "supplier_id", "quantity", "extended_price"]
    tx = transactions(spark, star, line + ["customer_id", "transaction_date", "total_sales", "product_category"])
    assert tx.where("customer_id IS NULL").count() > 0
    assert tx.where("customer_id IS NOT NULL AND transaction_date IS NULL").count() > 0
    dealt, by = Wn.laid_out(tx, "customer_id")
    joined = A.category_variety(Wn.days_between_purchases(tx, order=line))
    joined = joined.join(A.customer_lifetime_value(tx), "customer_id", "left")
    windows = A.category_variety(Wn.days_between_purchases(dealt, order=line, by=by), by=by)
    windows = A.customer_lifetime_value(windows, by=by).drop(Wn.SPREAD)
    assert dict(joined.dtypes) == dict(windows.dtypes)
    assert joined.where("days_between_purchases > 0").count() > 0
    same_rows(joined, windows, [*line, "customer_id", "transaction_date", "days_between_purchases"])


def test_stats_of_dealt_lines(spark, star):
    """Customer and product stats of dealt rows are those that an aggregation joins to the rows."""
    from basketry.operators import aggregates as A
    from basketry.operators import windows as Wn
    from basketry.sources.tables import line_prices, transactions
    line = ["transaction_id", "line_number", "customer_id", "transaction_date", "quantity", "extended_price", "discount"]
    raw = transactions(spark, star, line + ["product_id"]).withColumn(
        "product_id", F.when(F.col("product_id") != 8, F.col("product_id")))
    given = transactions(spark, star, ["customer_id", "quantity", "unit_price", "discount_applied", "total_sales"])
    tx = raw.withColumns(line_prices())
    same_rows(given, tx.select(given.columns), given.columns)
    for key, stats in (("product_id", A.product_feature_stats), ("customer_id", A.customer_feature_stats)):
        dealt, by = Wn.laid_out(raw, key)
        assert tx.where(F.col(key).isNull()).count() > 1
        joined, more = tx.join(stats(tx), key, "left"), {"counted": tx} if key == "product_id" else {}
        windows = stats(dealt.withColumns(line_prices()), by=by, **more).drop(Wn.SPREAD)
        assert dict(joined.dtypes) == dict(windows.dtypes)
        same_rows(joined, windows, [*line, "product_id"])
