"""Channel questions: online vs in-store totals, monthly and hourly patterns."""

from __future__ import annotations

from ..operators import aggregates as A
from pyspark.sql import functions as F

from ..sources.tables import events, order_lines, transactions, tx_sql
from .registry import query, rounded

_TX_CH = tx_sql(["channel", "gross_sales", "customer_id"])


@query("channel_sales", f"""WITH tx AS ({_TX_CH})
SELECT channel, ROUND((CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) + sign(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) * least(abs(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) * 1e-11, 1e-7), 4) AS total_sales, CAST(count(*) AS BIGINT) AS transactions,
       ROUND((CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE) / count(*)) + sign(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE) / count(*)) * least(abs(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE) / count(*)) * 1e-11, 1e-7), 4) AS avg_basket,
       CAST(count(DISTINCT customer_id) AS BIGINT) AS unique_customers
FROM tx WHERE channel IS NOT NULL GROUP BY channel""", covers=("A13", "J11", "E25"))
def q_channel_sales(spark, sf_dir):
    o = order_lines(spark, sf_dir).where(F.col("channel").isNotNull())
    out = (o.groupBy("channel").agg(
        F.sum("order_gross_sales").cast("double").alias("total_sales"),
        F.sum("n_lines").alias("transactions"),
        (F.sum("order_gross_sales").cast("double") / F.sum("n_lines")).alias("avg_basket"),
        F.count_distinct("customer_id").alias("unique_customers")))
    return rounded(out, {"total_sales": 4, "avg_basket": 4})


_TX_CHM = tx_sql(["channel", "transaction_date", "gross_sales"])


@query("channel_monthly_sales", f"""WITH tx AS ({_TX_CHM})
SELECT channel, date_trunc('month', transaction_date)::DATE AS month, ROUND((CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) + sign(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) * least(abs(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) * 1e-11, 1e-7), 4) AS sales
FROM tx WHERE channel IS NOT NULL AND transaction_date IS NOT NULL GROUP BY 1, 2""",
       covers=("A14",))
def q_channel_monthly_sales(spark, sf_dir):
    # order-grain facts: the additive sum needs no line-level join
    o = order_lines(spark, sf_dir)
    return rounded(A.channel_monthly_sales(o, sales="order_gross_sales"), {"sales": 4})


@query("channel_hourly_sales", """
SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, ROUND((sum(value)) + sign(sum(value)) * least(abs(sum(value)) * 1e-11, 1e-7), 4) AS sales,
       CAST(count(*) AS BIGINT) AS events
FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2""", covers=("A15",))
def q_channel_hourly_sales(spark, sf_dir):
    return rounded(A.channel_hourly_sales(events(spark, sf_dir)), {"sales": 4})


_TX_CI = tx_sql(["channel", "total_sales", "quantity", "discount_applied"])


@query("channel_conditional_means", f"""WITH tx AS ({_TX_CI})
SELECT ROUND((avg(CASE WHEN channel = 'online' THEN total_sales END)) + sign(avg(CASE WHEN channel = 'online' THEN total_sales END)) * least(abs(avg(CASE WHEN channel = 'online' THEN total_sales END)) * 1e-11, 1e-7), 4) AS avg_online_total_sales,
       ROUND((avg(CASE WHEN channel = 'online' THEN quantity END)) + sign(avg(CASE WHEN channel = 'online' THEN quantity END)) * least(abs(avg(CASE WHEN channel = 'online' THEN quantity END)) * 1e-11, 1e-7), 4) AS avg_online_quantity,
       ROUND((avg(CASE WHEN channel = 'online' THEN discount_applied END)) + sign(avg(CASE WHEN channel = 'online' THEN discount_applied END)) * least(abs(avg(CASE WHEN channel = 'online' THEN discount_applied END)) * 1e-11, 1e-7), 4) AS avg_online_discount_applied,
       ROUND((avg(CASE WHEN channel = 'in_store' THEN total_sales END)) + sign(avg(CASE WHEN channel = 'in_store' THEN total_sales END)) * least(abs(avg(CASE WHEN channel = 'in_store' THEN total_sales END)) * 1e-11, 1e-7), 4) AS avg_in_store_total_sales,
       ROUND((avg(CASE WHEN channel = 'in_store' THEN quantity END)) + sign(avg(CASE WHEN channel = 'in_store' THEN quantity END)) * least(abs(avg(CASE WHEN channel = 'in_store' THEN quantity END)) * 1e-11, 1e-7), 4) AS avg_in_store_quantity,
       ROUND((avg(CASE WHEN channel = 'in_store' THEN discount_applied END)) + sign(avg(CASE WHEN channel = 'in_store' THEN discount_applied END)) * least(abs(avg(CASE WHEN channel = 'in_store' THEN discount_applied END)) * 1e-11, 1e-7), 4) AS avg_in_store_discount_applied
FROM tx""", covers=("A34",))
def q_channel_conditional_means(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["channel", "total_sales", "quantity", "discount_applied"])
    out = A.conditional_means(tx, "channel", ["online", "in_store"],
                              ["total_sales", "quantity", "discount_applied"])
    return rounded(out, {c: 4 for c in out.columns})


_TX_PV = tx_sql(["region", "channel", "total_sales"])


@query("region_channel_pivot", f"""WITH tx AS ({_TX_PV})
SELECT region, ROUND((CAST(sum(CASE WHEN channel = 'in_store' THEN CAST(total_sales AS DECIMAL(18,4)) END) AS DOUBLE) / count(CASE WHEN channel = 'in_store' THEN 1 END)) + sign(CAST(sum(CASE WHEN channel = 'in_store' THEN CAST(total_sales AS DECIMAL(18,4)) END) AS DOUBLE) / count(CASE WHEN channel = 'in_store' THEN 1 END)) * least(abs(CAST(sum(CASE WHEN channel = 'in_store' THEN CAST(total_sales AS DECIMAL(18,4)) END) AS DOUBLE) / count(CASE WHEN channel = 'in_store' THEN 1 END)) * 1e-11, 1e-7), 4) AS in_store,
       ROUND((CAST(sum(CASE WHEN channel = 'online' THEN CAST(total_sales AS DECIMAL(18,4)) END) AS DOUBLE) / count(CASE WHEN channel = 'online' THEN 1 END)) + sign(CAST(sum(CASE WHEN channel = 'online' THEN CAST(total_sales AS DECIMAL(18,4)) END) AS DOUBLE) / count(CASE WHEN channel = 'online' THEN 1 END)) * least(abs(CAST(sum(CASE WHEN channel = 'online' THEN CAST(total_sales AS DECIMAL(18,4)) END) AS DOUBLE) / count(CASE WHEN channel = 'online' THEN 1 END)) * 1e-11, 1e-7), 4) AS online
FROM tx WHERE region IS NOT NULL GROUP BY region""", covers=("A36",))
def q_region_channel_pivot(spark, sf_dir):
    # mean per line = Σ sales / Σ lines over order-grain facts
    o = order_lines(spark, sf_dir, with_geo=True).where(F.col("region").isNotNull())
    out = (o.groupBy("region").pivot("channel", ["in_store", "online"])
            .agg((F.sum("order_sales").cast("double") / F.sum("n_lines")).alias("m")))
    return rounded(out, {"in_store": 4, "online": 4})
