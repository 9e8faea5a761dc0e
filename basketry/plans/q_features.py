"""Row-level feature queries: ratios, interactions, log transforms, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import scalar as X
from ..sources.tables import events, money_sum, transactions, tx_sql
from .registry import R, query, rounded

_COLS = ["transaction_id", "line_number", "product_id", "quantity", "unit_price",
         "discount_applied", "total_sales"]
_TX = tx_sql(_COLS)


@query("ratio_and_interaction_features", f"""WITH tx AS ({_TX})
SELECT transaction_id, line_number, product_id,
  {R("coalesce(CAST(total_sales AS DOUBLE), 0.0) / (coalesce(CAST(quantity AS DOUBLE), 0.0) + 1e-8)")} AS total_sales_to_quantity_ratio,
  {R("coalesce(CAST(discount_applied AS DOUBLE), 0.0) / (coalesce(CAST(unit_price AS DOUBLE), 0.0) + 1e-8)", 6)} AS discount_applied_to_unit_price_ratio,
  {R("quantity * unit_price")} AS quantity_x_unit_price,
  {R("quantity * discount_applied")} AS quantity_x_discount_applied,
  {R("unit_price * discount_applied")} AS unit_price_x_discount_applied,
  {R("ln(1 + total_sales)", 6)} AS log_total_sales
FROM tx""", covers=("F10", "F11", "F12", "J13", "E29"))
def q_ratio_and_interaction_features(spark, sf_dir):
    tx = transactions(spark, sf_dir, _COLS)
    feats = {**X.ratio_features([("total_sales", "quantity"), ("discount_applied", "unit_price")]),
             **X.pairwise_products(["quantity", "unit_price", "discount_applied"]),
             "log_total_sales": X.log1p("total_sales")}
    out = tx.withColumns(feats).select("transaction_id", "line_number", "product_id", *feats)
    return rounded(out, {"total_sales_to_quantity_ratio": 4,
                         "discount_applied_to_unit_price_ratio": 6, "quantity_x_unit_price": 4,
                         "quantity_x_discount_applied": 4, "unit_price_x_discount_applied": 4,
                         "log_total_sales": 6})


_TX_SPC = tx_sql(["market_segment", "customer_id", "total_sales"])


@query("sales_per_customer_by_segment", f"""WITH tx AS ({_TX_SPC}),
g AS (SELECT market_segment, sum(total_sales) AS s, count(DISTINCT customer_id) AS c FROM tx
      WHERE market_segment IS NOT NULL GROUP BY 1)
SELECT lower(replace(market_segment, ' ', '_')) AS segment_key, {R("s / c")} AS sales_per_customer,
       {R("ln(1 + s / c)", 6)} AS log_sales_per_customer
FROM g""", covers=("F12", "F16"))
def q_sales_per_customer_by_segment(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["market_segment", "customer_id", "total_sales"])
    g = (tx.where(F.col("market_segment").isNotNull()).groupBy("market_segment")
           .agg(F.sum("total_sales").alias("s"), F.count_distinct("customer_id").alias("c")))
    out = g.select(X.snake_case("market_segment").alias("segment_key"),
                   X.per_unit("s", "c").alias("sales_per_customer"))
    out = out.withColumn("log_sales_per_customer", X.log1p("sales_per_customer"))
    return rounded(out, {"sales_per_customer": 4, "log_sales_per_customer": 6})


@query("event_hour_cyclic", f"""SELECT event_id, {R("sin(2 * pi() * hour(ts) / 24)", 6)} + 0.0 AS hour_sin,
       {R("cos(2 * pi() * hour(ts) / 24)", 6)} + 0.0 AS hour_cos FROM events""", covers=("F4",))
def q_event_hour_cyclic(spark, sf_dir):
    out = events(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in C.cyclic_hour("ts").items()])
    out = rounded(out, {"hour_sin": 6, "hour_cos": 6})
    return out.withColumns({c: F.col(c) + 0.0 for c in ("hour_sin", "hour_cos")})  # no -0.0


_TX_RS = tx_sql(["product_category", "customer_id", "transaction_date", "total_sales"])


@query("category_customer_counts", f"""WITH tx AS ({_TX_RS})
SELECT product_category, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers,
       CAST(count(*) AS BIGINT) AS lines, {R("CAST(sum(CAST(total_sales AS DECIMAL(18,4))) AS DOUBLE)")} AS sales
FROM tx WHERE product_category IS NOT NULL GROUP BY 1""", covers=("A13", "A23"))
def q_category_customer_counts(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["product_category", "customer_id", "transaction_date",
                                      "total_sales"])
    out = (tx.where(F.col("product_category").isNotNull()).groupBy("product_category")
             .agg(F.count_distinct("customer_id").alias("customers"),
                  F.count(F.lit(1)).alias("lines"), money_sum("total_sales").alias("sales")))
    return rounded(out, {"sales": 4})

