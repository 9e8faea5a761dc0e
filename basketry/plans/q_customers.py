"""Customer questions: RFM and churn, customer metrics, lifetime value."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import windows as Wn
from ..sources.tables import customers, order_lines, transactions, tx_sql
from .registry import query, rounded

_TX_RFM = tx_sql(["transaction_id", "customer_id", "transaction_date", "total_sales"])

RFM_CTE = f"""
tx AS ({_TX_RFM}),
m AS (SELECT max(transaction_date) AS d FROM tx),
rfm AS (
SELECT customer_id,
       max(transaction_date) AS last_purchase,
       min(transaction_date) AS first_purchase,
       CAST(count(transaction_id) AS BIGINT) AS frequency,
       CAST(sum(CAST(total_sales AS DECIMAL(18,4))) AS DOUBLE) AS monetary,
       CAST(date_diff('day', max(transaction_date), (SELECT d FROM m)) AS INTEGER) AS recency,
       CAST(date_diff('day', min(transaction_date), (SELECT d FROM m)) AS INTEGER) AS tenure,
       CASE WHEN date_diff('day', max(transaction_date), (SELECT d FROM m)) > 90 THEN 1 ELSE 0 END AS churn
FROM tx WHERE customer_id IS NOT NULL
GROUP BY customer_id)
"""


def rfm_frame(spark, sf_dir, churn_days=90):
    """RFM over order-grain facts (lines pre-aggregated per order)."""
    orders = order_lines(spark, sf_dir)
    return A.rfm(orders, amount="order_sales", line_count="n_lines", churn_days=churn_days)


@query("rfm_churn", f"""WITH {RFM_CTE}
SELECT customer_id, last_purchase, first_purchase, frequency, ROUND((monetary) + sign(monetary) * least(abs(monetary) * 1e-11, 1e-7), 4) AS monetary,
       recency, tenure, churn FROM rfm""", covers=("A1", "P17", "J3", "F6"))
def q_rfm_churn(spark, sf_dir):
    return rounded(rfm_frame(spark, sf_dir), {"monetary": 4})


@query("customers_with_last_purchase", f"""WITH {RFM_CTE}
SELECT c.c_custkey AS customer_id, c.c_mktsegment AS market_segment, rfm.last_purchase, rfm.recency
FROM customer c LEFT JOIN rfm ON rfm.customer_id = c.c_custkey""", covers=("J1", "J2"))
def q_customers_with_last_purchase(spark, sf_dir):
    """Every customer, also those who never bought."""
    c = customers(spark, sf_dir, with_geo=False).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("market_segment"))
    r = rfm_frame(spark, sf_dir).select("customer_id", "last_purchase", "recency")
    return c.join(r, "customer_id", "left")


@query("churn_class_share", f"""WITH {RFM_CTE}
SELECT churn, CAST(count(*) AS BIGINT) AS count,
       ROUND((count(*) / sum(count(*)) OVER ()) + sign(count(*) / sum(count(*)) OVER ()) * least(abs(count(*) / sum(count(*)) OVER ()) * 1e-11, 1e-7), 6) AS share
FROM rfm GROUP BY churn""", covers=("A24",))
def q_churn_class_share(spark, sf_dir):
    return rounded(A.class_share(rfm_frame(spark, sf_dir), "churn"), {"share": 6})


@query("tenure_churn_counts", f"""WITH {RFM_CTE}
SELECT CAST(floor(tenure / 365) AS INTEGER) AS tenure_years, churn, CAST(count(*) AS BIGINT) AS count
FROM rfm GROUP BY 1, 2""", covers=("A26",))
def q_tenure_churn_counts(spark, sf_dir):
    r = rfm_frame(spark, sf_dir).withColumn(
        "tenure_years", F.floor(F.col("tenure") / 365).cast("int"))
    return A.cross_counts(r, "tenure_years", "churn")


_TX_CM = tx_sql(["transaction_id", "customer_id", "transaction_date", "quantity", "unit_price"])


@query("customer_metrics", f"""WITH tx AS ({_TX_CM}),
m AS (SELECT max(transaction_date) AS d FROM tx),
cm AS (SELECT customer_id, count(transaction_id) AS transactions_count,
              avg(quantity * unit_price) AS average_spent,
              date_diff('day', min(transaction_date), (SELECT d FROM m)) AS days_since_first_purchase,
              date_diff('day', max(transaction_date), (SELECT d FROM m)) AS days_since_last_purchase
       FROM tx WHERE customer_id IS NOT NULL GROUP BY customer_id)
SELECT c.c_custkey AS customer_id, c.c_mktsegment AS market_segment,
       CAST(cm.transactions_count AS BIGINT) AS transactions_count,
       ROUND((cm.average_spent) + sign(cm.average_spent) * least(abs(cm.average_spent) * 1e-11, 1e-7), 4) AS average_spent,
       CAST(cm.days_since_first_purchase AS INTEGER) AS days_since_first_purchase,
       CAST(cm.days_since_last_purchase AS INTEGER) AS days_since_last_purchase
FROM customer c LEFT JOIN cm ON c.c_custkey = cm.customer_id""", covers=("A2", "J1"))
def q_customer_metrics(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_id", "customer_id", "transaction_date",
                                      "quantity", "unit_price"])
    cm = A.customer_metrics(tx)
    cust = customers(spark, sf_dir, with_geo=False).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("market_segment"))
    return rounded(cust.join(cm, "customer_id", "left"), {"average_spent": 4})


_TX_A7 = tx_sql(["customer_id", "total_sales", "quantity", "discount_applied", "transaction_date"])


@query("customer_feature_stats", f"""WITH tx AS ({_TX_A7})
SELECT customer_id,
  ROUND((sum(total_sales)) + sign(sum(total_sales)) * least(abs(sum(total_sales)) * 1e-11, 1e-7), 4) AS customer_total_sales_sum,
  ROUND((avg(total_sales)) + sign(avg(total_sales)) * least(abs(avg(total_sales)) * 1e-11, 1e-7), 4) AS customer_total_sales_mean,
  ROUND((stddev_samp(total_sales)) + sign(stddev_samp(total_sales)) * least(abs(stddev_samp(total_sales)) * 1e-11, 1e-7), 4) AS customer_total_sales_std,
  CAST(count(total_sales) AS BIGINT) AS customer_total_sales_count,
  ROUND((sum(quantity)) + sign(sum(quantity)) * least(abs(sum(quantity)) * 1e-11, 1e-7), 4) AS customer_quantity_sum,
  ROUND((avg(quantity)) + sign(avg(quantity)) * least(abs(avg(quantity)) * 1e-11, 1e-7), 4) AS customer_quantity_mean,
  ROUND((avg(discount_applied)) + sign(avg(discount_applied)) * least(abs(avg(discount_applied)) * 1e-11, 1e-7), 4) AS customer_discount_applied_mean,
  ROUND((max(discount_applied)) + sign(max(discount_applied)) * least(abs(max(discount_applied)) * 1e-11, 1e-7), 4) AS customer_discount_applied_max,
  min(transaction_date) AS customer_transaction_date_min,
  max(transaction_date) AS customer_transaction_date_max,
  CAST(date_diff('day', min(transaction_date), max(transaction_date)) AS INTEGER) AS customer_lifetime_days,
  ROUND((count(total_sales) / (date_diff('day', min(transaction_date), max(transaction_date)) + 1)) + sign(count(total_sales) / (date_diff('day', min(transaction_date), max(transaction_date)) + 1)) * least(abs(count(total_sales) / (date_diff('day', min(transaction_date), max(transaction_date)) + 1)) * 1e-11, 1e-7), 6)
    AS customer_purchase_frequency
FROM tx WHERE customer_id IS NOT NULL GROUP BY customer_id""", covers=("A7",))
def q_customer_feature_stats(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["customer_id", "total_sales", "quantity",
                                      "discount_applied", "transaction_date"])
    out = A.customer_feature_stats(tx)
    r4 = [c for c in out.columns if c.endswith(("_sum", "_mean", "_std", "_max"))
          and "date" not in c]
    return rounded(out, {**{c: 4 for c in r4}, "customer_purchase_frequency": 6})


_TX_CLV = tx_sql(["customer_id", "total_sales", "transaction_id", "transaction_date"])
CLV_CTE = f"""tx AS ({_TX_CLV}),
clv AS (SELECT customer_id, avg(total_sales) AS avg_order_value,
        CAST(count(transaction_id) AS BIGINT) AS purchase_frequency,
        CAST(date_diff('day', min(transaction_date), max(transaction_date)) AS INTEGER) AS lifespan_days
        FROM tx WHERE customer_id IS NOT NULL GROUP BY customer_id)"""


@query("customer_lifetime_value", f"""WITH {CLV_CTE}
SELECT customer_id, ROUND((avg_order_value) + sign(avg_order_value) * least(abs(avg_order_value) * 1e-11, 1e-7), 4) AS avg_order_value, purchase_frequency, lifespan_days,
       ROUND((avg_order_value * purchase_frequency * (lifespan_days / 365.0)) + sign(avg_order_value * purchase_frequency * (lifespan_days / 365.0)) * least(abs(avg_order_value * purchase_frequency * (lifespan_days / 365.0)) * 1e-11, 1e-7), 4) AS customer_lifetime_value
FROM clv""", covers=("A9",))
def q_clv(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["customer_id", "total_sales", "transaction_id",
                                      "transaction_date"])
    return rounded(A.customer_lifetime_value(tx),
                   {"avg_order_value": 4, "customer_lifetime_value": 4})


@query("avg_sales_by_clv", f"""WITH {CLV_CTE},
v AS (SELECT customer_id,
        ROUND((avg_order_value * purchase_frequency * (lifespan_days / 365.0)) + sign(avg_order_value * purchase_frequency * (lifespan_days / 365.0)) * least(abs(avg_order_value * purchase_frequency * (lifespan_days / 365.0)) * 1e-11, 1e-7), 4) AS customer_lifetime_value
      FROM clv)
SELECT v.customer_lifetime_value, ROUND((avg(tx.total_sales)) + sign(avg(tx.total_sales)) * least(abs(avg(tx.total_sales)) * 1e-11, 1e-7), 4) AS average_sales
FROM v JOIN tx ON v.customer_id = tx.customer_id
GROUP BY v.customer_lifetime_value""", covers=("A25", "J4"))
def q_avg_sales_by_clv(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["customer_id", "total_sales", "transaction_id",
                                      "transaction_date"])
    clv = rounded(A.customer_lifetime_value(tx), {"customer_lifetime_value": 4}).select(
        "customer_id", "customer_lifetime_value")
    joined = clv.join(tx, "customer_id", "inner")
    return rounded(A.avg_by_value(joined, "customer_lifetime_value", "total_sales",
                                  "average_sales"), {"average_sales": 4})


_TX_VAR = tx_sql(["customer_id", "transaction_id", "line_number", "product_category", "quantity"])


@query("category_variety", f"""WITH tx AS ({_TX_VAR}),
v AS (SELECT customer_id, CAST(count(DISTINCT product_category) AS BIGINT) AS product_variety
      FROM tx WHERE customer_id IS NOT NULL AND product_category IS NOT NULL GROUP BY customer_id)
SELECT tx.customer_id, tx.transaction_id, tx.line_number, tx.quantity, v.product_variety,
       ROUND((tx.quantity * coalesce(v.product_variety, 0)) + sign(tx.quantity * coalesce(v.product_variety, 0)) * least(abs(tx.quantity * coalesce(v.product_variety, 0)) * 1e-11, 1e-7), 4) AS average_basket_size
FROM tx LEFT JOIN v ON tx.customer_id = v.customer_id""", covers=("A12", "J5", "W9"))
def q_category_variety(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["customer_id", "transaction_id", "line_number",
                                      "product_category", "quantity"])
    out = A.category_variety(tx).drop("product_category")
    return rounded(out, {"average_basket_size": 4})


_TX_GAP = tx_sql(["customer_id", "transaction_date", "transaction_id", "line_number",
                  "product_id", "supplier_id", "quantity", "extended_price"])


@query("days_between_purchases", f"""WITH tx AS ({_TX_GAP}),
r AS (SELECT *, row_number() OVER (PARTITION BY customer_id, transaction_date
        ORDER BY transaction_id, line_number, product_id, supplier_id, quantity, extended_price) AS rn
      FROM tx WHERE customer_id IS NOT NULL AND transaction_date IS NOT NULL),
d AS (SELECT customer_id, transaction_date,
        date_diff('day', lag(transaction_date) OVER (PARTITION BY customer_id ORDER BY transaction_date),
                  transaction_date) AS gap
      FROM (SELECT DISTINCT customer_id, transaction_date FROM r))
SELECT r.customer_id, r.transaction_date, r.transaction_id, r.line_number, r.product_id,
       CAST(CASE WHEN r.rn = 1 THEN coalesce(d.gap, 0) ELSE 0 END AS INTEGER) AS days_between_purchases
FROM r JOIN d ON r.customer_id = d.customer_id AND r.transaction_date = d.transaction_date""",
       covers=("W8", "T1"))
def q_days_between_purchases(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["customer_id", "transaction_date", "transaction_id",
                                      "line_number", "product_id", "supplier_id", "quantity",
                                      "extended_price"])
    out = Wn.days_between_purchases(
        tx, order=["transaction_id", "line_number", "product_id", "supplier_id", "quantity",
                   "extended_price"])
    return out.select("customer_id", "transaction_date", "transaction_id", "line_number",
                      "product_id", "days_between_purchases")
