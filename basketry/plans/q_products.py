"""Product and category questions: metrics, promotion inputs, demand, top-n."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import windows as Wn
from ..sources.tables import part_lines, transactions, tx_sql
from .registry import R, query, rounded

_TX_P = tx_sql(["product_id", "quantity", "unit_price"])


@query("product_metrics", f"""WITH tx AS ({_TX_P})
SELECT product_id, ROUND((sum(quantity)) + sign(sum(quantity)) * least(abs(sum(quantity)) * 1e-11, 1e-7), 4) AS total_quantity_sold,
       ROUND((sum(quantity * unit_price)) + sign(sum(quantity * unit_price)) * least(abs(sum(quantity * unit_price)) * 1e-11, 1e-7), 4) AS total_revenue, ROUND((avg(unit_price)) + sign(avg(unit_price)) * least(abs(avg(unit_price)) * 1e-11, 1e-7), 4) AS avg_price
FROM tx WHERE product_id IS NOT NULL GROUP BY product_id""", covers=("A5",))
def q_product_metrics(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["product_id", "quantity", "unit_price"])
    return rounded(A.product_metrics(tx), {"total_quantity_sold": 4, "total_revenue": 4,
                                           "avg_price": 4})


_TX_PROMO = tx_sql(["transaction_id", "product_id", "total_sales", "quantity", "discount_applied"])
PROMO_CTE = f"""tx AS ({_TX_PROMO}),
items AS (SELECT transaction_id, sum(quantity) AS avg_items_per_transaction FROM tx
          WHERE transaction_id IS NOT NULL GROUP BY transaction_id),
pm AS (SELECT product_id, sum(total_sales) AS total_sales, sum(quantity) AS total_quantity,
              avg(discount_applied) AS avg_discount, avg(i.avg_items_per_transaction) AS avg_items_per_txn
       FROM tx LEFT JOIN items i ON tx.transaction_id = i.transaction_id
       WHERE product_id IS NOT NULL GROUP BY product_id)"""


def promo_frame(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_id", "product_id", "total_sales",
                                      "quantity", "discount_applied"])
    return A.product_promo_metrics(A.items_per_transaction(tx))


@query("product_promo_metrics", f"""WITH {PROMO_CTE}
SELECT product_id, ROUND((total_sales) + sign(total_sales) * least(abs(total_sales) * 1e-11, 1e-7), 4) AS total_sales, ROUND((total_quantity) + sign(total_quantity) * least(abs(total_quantity) * 1e-11, 1e-7), 4) AS total_quantity,
       ROUND((avg_discount) + sign(avg_discount) * least(abs(avg_discount) * 1e-11, 1e-7), 4) AS avg_discount, ROUND((avg_items_per_txn) + sign(avg_items_per_txn) * least(abs(avg_items_per_txn) * 1e-11, 1e-7), 4) AS avg_items_per_txn
FROM pm WHERE total_sales IS NOT NULL AND total_quantity IS NOT NULL
  AND avg_discount IS NOT NULL AND avg_items_per_txn IS NOT NULL""", covers=("A6", "P9"))
def q_product_promo_metrics(spark, sf_dir):
    return rounded(promo_frame(spark, sf_dir), {"total_sales": 4, "total_quantity": 4,
                                                "avg_discount": 4, "avg_items_per_txn": 4})


_TX_A8 = tx_sql(["product_id", "total_sales", "quantity", "unit_price", "discount_applied"])


@query("product_feature_stats", f"""WITH tx AS ({_TX_A8}),
g AS (SELECT product_id, sum(total_sales) AS s, avg(total_sales) AS m, count(total_sales) AS n,
             sum(quantity) AS qs, avg(quantity) AS qm, avg(unit_price) AS pm, stddev_samp(unit_price) AS ps,
             avg(discount_applied) AS dm, count(discount_applied) AS dn
      FROM tx WHERE product_id IS NOT NULL GROUP BY product_id)
SELECT product_id, ROUND((s) + sign(s) * least(abs(s) * 1e-11, 1e-7), 4) AS product_total_sales_sum, ROUND((m) + sign(m) * least(abs(m) * 1e-11, 1e-7), 4) AS product_total_sales_mean,
       CAST(n AS BIGINT) AS product_total_sales_count, ROUND((qs) + sign(qs) * least(abs(qs) * 1e-11, 1e-7), 4) AS product_quantity_sum,
       ROUND((qm) + sign(qm) * least(abs(qm) * 1e-11, 1e-7), 4) AS product_quantity_mean, ROUND((pm) + sign(pm) * least(abs(pm) * 1e-11, 1e-7), 4) AS product_unit_price_mean,
       ROUND((ps) + sign(ps) * least(abs(ps) * 1e-11, 1e-7), 4) AS product_unit_price_std, ROUND((dm) + sign(dm) * least(abs(dm) * 1e-11, 1e-7), 4) AS product_discount_applied_mean,
       CAST(dn AS BIGINT) AS product_discount_applied_count,
       ROUND((n / (SELECT max(n) FROM g)) + sign(n / (SELECT max(n) FROM g)) * least(abs(n / (SELECT max(n) FROM g)) * 1e-11, 1e-7), 6) AS product_popularity_score,
       ROUND((dn / n) + sign(dn / n) * least(abs(dn / n) * 1e-11, 1e-7), 6) AS product_discount_frequency
FROM g""", covers=("A8", "W13"))
def q_product_feature_stats(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["product_id", "total_sales", "quantity", "unit_price",
                                      "discount_applied"])
    out = A.product_feature_stats(tx)
    r4 = [c for c in out.columns if c.endswith(("_sum", "_mean", "_std"))]
    return rounded(out, {**{c: 4 for c in r4}, "product_popularity_score": 6,
                         "product_discount_frequency": 6})


_TX_CAT = tx_sql(["product_category", "total_sales"])


@query("sales_by_category", f"""WITH tx AS ({_TX_CAT})
SELECT product_category, ROUND((CAST(sum(CAST(total_sales AS DECIMAL(18,4))) AS DOUBLE)) + sign(CAST(sum(CAST(total_sales AS DECIMAL(18,4))) AS DOUBLE)) * least(abs(CAST(sum(CAST(total_sales AS DECIMAL(18,4))) AS DOUBLE)) * 1e-11, 1e-7), 4) AS sales FROM tx
WHERE product_category IS NOT NULL GROUP BY product_category""", covers=("A23", "T1"))
def q_sales_by_category(spark, sf_dir):
    # product-grain facts (one row per part) carry the additive sum to the category
    return rounded(A.sales_by_category(part_lines(spark, sf_dir), sales="sales"), {"sales": 4})


_TX_TOP = tx_sql(["product_id", "transaction_date", "total_sales"])
TOP_CTE = f"""tx AS ({_TX_TOP}),
top AS (SELECT product_id FROM tx WHERE product_id IS NOT NULL GROUP BY product_id
        ORDER BY sum(total_sales) DESC, product_id LIMIT 10)"""


@query("top_products", f"""WITH tx AS ({_TX_TOP})
SELECT product_id, ROUND((sum(total_sales)) + sign(sum(total_sales)) * least(abs(sum(total_sales)) * 1e-11, 1e-7), 4) AS sales FROM tx WHERE product_id IS NOT NULL
GROUP BY product_id ORDER BY sum(total_sales) DESC, product_id LIMIT 10""", covers=("T3", "T2"))
def q_top_products(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["product_id", "total_sales"])
    g = tx.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.sum("total_sales").alias("sales"))
    return rounded(g.orderBy(F.desc("sales"), "product_id").limit(10), {"sales": 4})


@query("top_products_by_month", f"""WITH {TOP_CTE}
SELECT product_id, CAST(month(transaction_date) AS INTEGER) AS month, ROUND((sum(total_sales)) + sign(sum(total_sales)) * least(abs(sum(total_sales)) * 1e-11, 1e-7), 4) AS sales
FROM tx WHERE product_id IN (SELECT product_id FROM top) AND transaction_date IS NOT NULL
GROUP BY 1, 2""", covers=("A41", "J10"))
def q_top_products_by_month(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["product_id", "transaction_date", "total_sales"])
    return rounded(A.top_products_by_month(tx, n=10), {"sales": 4})


_TX_CH_P = tx_sql(["channel", "product_id", "total_sales"])


@query("top_products_per_channel", f"""WITH tx AS ({_TX_CH_P}),
g AS (SELECT channel, product_id, sum(total_sales) AS sales FROM tx
      WHERE channel IS NOT NULL AND product_id IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY sales DESC, product_id) AS rank FROM g)
SELECT channel, product_id, ROUND((sales) + sign(sales) * least(abs(sales) * 1e-11, 1e-7), 4) AS sales, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""",
       covers=("W11",))
def q_top_products_per_channel(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["channel", "product_id", "total_sales"])
    g = (tx.where(F.col("channel").isNotNull() & F.col("product_id").isNotNull())
           .groupBy("channel", "product_id").agg(F.sum("total_sales").alias("sales")))
    return rounded(Wn.top_n_per_group(g, "channel", "sales", 5, tiebreak=["product_id"]),
                   {"sales": 4})


_TX_DEM = tx_sql(["transaction_date", "total_sales", "discount_applied", "unit_price"])


@query("product_demand_by_month", f"""WITH tx AS ({_TX_DEM}),
m AS (SELECT date_trunc('month', transaction_date)::DATE AS month, sum(total_sales) AS sales,
             avg(discount_applied) AS avg_discount, avg(unit_price) AS avg_price
      FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1)
SELECT month, ROUND((sales) + sign(sales) * least(abs(sales) * 1e-11, 1e-7), 4) AS sales, ROUND((avg_discount) + sign(avg_discount) * least(abs(avg_discount) * 1e-11, 1e-7), 4) AS avg_discount,
       ROUND((avg_price) + sign(avg_price) * least(abs(avg_price) * 1e-11, 1e-7), 4) AS avg_price, CAST(row_number() OVER (ORDER BY month) - 1 AS INTEGER) AS time_index
FROM m""", covers=("A27", "W10"))
def q_product_demand_by_month(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_date", "total_sales", "discount_applied",
                                      "unit_price"])
    return rounded(A.product_demand_by_month(tx), {"sales": 4, "avg_discount": 4,
                                                   "avg_price": 4})


_TX_BASKET = tx_sql(["transaction_id", "quantity", "unit_price"])


@query("basket_size", f"""WITH tx AS ({_TX_BASKET}),
b AS (SELECT transaction_id, sum(quantity) * sum(unit_price) AS pos, sum(quantity * unit_price) AS sop
      FROM tx WHERE transaction_id IS NOT NULL GROUP BY 1)
SELECT {R("avg(pos)")} AS avg_basket_product_of_sums, {R("avg(sop)")} AS avg_basket_sum_of_products
FROM b""", covers=("A4",))
def q_basket_size(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_id", "quantity", "unit_price"])
    a = A.basket_size(tx, formula="product_of_sums").withColumnRenamed(
        "avg_basket_size", "avg_basket_product_of_sums")
    b = A.basket_size(tx, formula="sum_of_products").withColumnRenamed(
        "avg_basket_size", "avg_basket_sum_of_products")
    out = a.select(F.col("avg_basket_product_of_sums"),
                   b.select("avg_basket_sum_of_products").scalar().alias("avg_basket_sum_of_products"))
    return rounded(out, {"avg_basket_product_of_sums": 4, "avg_basket_sum_of_products": 4})
