"""Statistics queries: distributions, correlations, fits, profiles, encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import discount_percent
from ..operators import aggregates as A
from ..sources.tables import transactions, tx_sql
from .q_time import GROSS_DAILY_CTE, gross_daily
from .registry import R, query, rounded

_TX_BOX = tx_sql(["product_category", "quantity"])


@query("category_quantity_box", f"""WITH tx AS ({_TX_BOX}),
g AS (SELECT product_category, min(quantity) AS min, max(quantity) AS max, count(quantity) AS count,
        quantile_cont(quantity, 0.25) AS q1, quantile_cont(quantity, 0.5) AS median,
        quantile_cont(quantity, 0.75) AS q3
      FROM tx WHERE product_category IS NOT NULL GROUP BY 1)
SELECT product_category, {R("min")} AS min, {R("max")} AS max, CAST(count AS BIGINT) AS count,
       {R("q1")} AS q1, {R("median")} AS median, {R("q3")} AS q3,
       {R("greatest(min, q1 - 1.5 * (q3 - q1))")} AS whisker_low,
       {R("least(max, q3 + 1.5 * (q3 - q1))")} AS whisker_high
FROM g""", covers=("A28",))
def q_category_quantity_box(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["product_category", "quantity"])
    out = A.box_stats(tx, "product_category", "quantity", exact=True)
    return rounded(out, {c: 4 for c in ("min", "max", "q1", "median", "q3", "whisker_low",
                                         "whisker_high")})


_TX_H = tx_sql(["total_sales"])


@query("sales_histogram", f"""WITH tx AS ({_TX_H}),
b AS (SELECT min(total_sales) AS lo, max(total_sales) AS hi FROM tx),
c AS (SELECT CASE WHEN b.hi = b.lo THEN 1
             ELSE least(CAST(floor((total_sales - b.lo) / ((b.hi - b.lo) / 30)) AS INTEGER) + 1, 30) END AS bin
      FROM tx, b WHERE total_sales IS NOT NULL)
SELECT bin, CAST(count(*) AS BIGINT) AS count,
       {R("(SELECT lo FROM b) + (bin - 1) * (((SELECT hi FROM b) - (SELECT lo FROM b)) / 30)")} AS bin_start,
       {R("(SELECT lo FROM b) + bin * (((SELECT hi FROM b) - (SELECT lo FROM b)) / 30)")} AS bin_end
FROM c GROUP BY bin""", covers=("A29",))
def q_sales_histogram(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["total_sales"])
    return rounded(A.histogram(tx, "total_sales", 30), {"bin_start": 4, "bin_end": 4})


_TX_PS = tx_sql(["quantity", "unit_price", "discount_applied"])


@query("price_discount_effect", f"""WITH tx AS ({_TX_PS}),
t AS (SELECT unit_price, quantity * unit_price AS sales,
             discount_applied / NULLIF(unit_price, 0) * 100 AS discount_percentage FROM tx)
SELECT {R("corr(unit_price, sales)", 6)} AS price_sales_corr,
       {R("corr(discount_percentage, sales)", 6)} AS discount_sales_corr,
       {R("regr_slope(sales, unit_price)", 6)} AS price_slope,
       {R("regr_intercept(sales, unit_price)", 4)} AS price_intercept,
       {R("regr_r2(sales, unit_price)", 6)} AS price_r2,
       {R("regr_slope(sales, discount_percentage)", 6)} AS discount_slope,
       {R("regr_intercept(sales, discount_percentage)", 4)} AS discount_intercept,
       {R("regr_r2(sales, discount_percentage)", 6)} AS discount_r2
FROM t""", covers=("A30", "A39", "F13", "E24"))
def q_price_discount_effect(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["quantity", "unit_price", "discount_applied"])
    t = tx.select("unit_price", (F.col("quantity") * F.col("unit_price")).alias("sales"),
                  discount_percent("discount_applied", "unit_price").alias("discount_percentage"))
    out = t.agg(
        F.corr("unit_price", "sales").alias("price_sales_corr"),
        F.corr("discount_percentage", "sales").alias("discount_sales_corr"),
        F.regr_slope("sales", "unit_price").alias("price_slope"),
        F.regr_intercept("sales", "unit_price").alias("price_intercept"),
        F.regr_r2("sales", "unit_price").alias("price_r2"),
        F.regr_slope("sales", "discount_percentage").alias("discount_slope"),
        F.regr_intercept("sales", "discount_percentage").alias("discount_intercept"),
        F.regr_r2("sales", "discount_percentage").alias("discount_r2"))
    return rounded(out, {"price_sales_corr": 6, "discount_sales_corr": 6, "price_slope": 6,
                         "price_intercept": 4, "price_r2": 6, "discount_slope": 6,
                         "discount_intercept": 4, "discount_r2": 6})


_TX_FIT = tx_sql(["quantity", "unit_price"])


@query("price_fitted_sales", f"""WITH tx AS ({_TX_FIT}),
t AS (SELECT unit_price, quantity * unit_price AS sales FROM tx),
f AS (SELECT regr_slope(sales, unit_price) AS b, regr_intercept(sales, unit_price) AS a FROM t)
SELECT {R("unit_price")} AS unit_price, {R("sales")} AS sales,
       {R("(SELECT a FROM f) + (SELECT b FROM f) * unit_price", 2)} AS fitted
FROM t""", covers=("A39", "L1"))
def q_price_fitted_sales(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["quantity", "unit_price"])
    t = tx.select("unit_price", (F.col("quantity") * F.col("unit_price")).alias("sales"))
    return rounded(A.with_linear_fit(t, "sales", "unit_price"),
                   {"unit_price": 4, "sales": 4, "fitted": 2})


_TX_CC = tx_sql(["product_category", "discount_pct", "total_sales"])


@query("category_discount_correlation", f"""WITH tx AS ({_TX_CC})
SELECT product_category, {R("corr(discount_pct, total_sales)", 3)} AS correlation
FROM tx WHERE product_category IS NOT NULL GROUP BY 1""", covers=("A31", "F15"))
def q_category_discount_correlation(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["product_category", "discount_pct", "total_sales"])
    out = A.correlation(tx, "discount_pct", "total_sales", group="product_category")
    return rounded(out, {"correlation": 3})


_CM_COLS = ["quantity", "unit_price", "discount_pct", "total_sales"]
_TX_CM = tx_sql(_CM_COLS)


@query("correlation_matrix", f"WITH tx AS ({_TX_CM})\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {R(f'corr({a}, {b})', 6)} AS correlation FROM tx"
    for a in _CM_COLS for b in _CM_COLS), covers=("A32",))
def q_correlation_matrix(spark, sf_dir):
    tx = transactions(spark, sf_dir, _CM_COLS)
    return rounded(A.correlation_matrix(tx, _CM_COLS), {"correlation": 6})


_TX_SEG = tx_sql(["income_bracket", "quantity", "total_sales", "product_category"])


@query("segment_profile", f"""WITH tx AS ({_TX_SEG}),
m AS (SELECT income_bracket, product_category, count(*) AS n FROM tx
      WHERE income_bracket IS NOT NULL AND product_category IS NOT NULL GROUP BY 1, 2),
top AS (SELECT income_bracket, product_category FROM
        (SELECT *, row_number() OVER (PARTITION BY income_bracket ORDER BY n DESC, product_category) AS rn FROM m)
        WHERE rn = 1),
g AS (SELECT income_bracket, avg(quantity) AS avg_quantity, avg(total_sales) AS avg_total_sales,
             count(*) AS count FROM tx WHERE income_bracket IS NOT NULL GROUP BY 1)
SELECT g.income_bracket, {R("avg_quantity")} AS avg_quantity, {R("avg_total_sales")} AS avg_total_sales,
       top.product_category AS mode_product_category, CAST(count AS BIGINT) AS count
FROM g LEFT JOIN top ON g.income_bracket = top.income_bracket""", covers=("A33",))
def q_segment_profile(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["income_bracket", "quantity", "total_sales",
                                      "product_category"])
    out = A.group_profile(tx, "income_bracket", ["quantity", "total_sales"], ["product_category"])
    return rounded(out, {"avg_quantity": 4, "avg_total_sales": 4})


_TX_FE = tx_sql(["transaction_id", "line_number", "product_id", "product_brand"])


@query("brand_frequency_encoding", f"""WITH tx AS ({_TX_FE}),
c AS (SELECT product_brand, count(*) AS n FROM tx WHERE product_brand IS NOT NULL GROUP BY 1)
SELECT tx.transaction_id, tx.line_number, tx.product_id, tx.product_brand,
       {R("c.n / (SELECT sum(n) FROM c)", 6)} AS product_brand_freq
FROM tx LEFT JOIN c ON tx.product_brand = c.product_brand""", covers=("A35",))
def q_brand_frequency_encoding(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_id", "line_number", "product_id",
                                      "product_brand"])
    return rounded(A.frequency_encode(tx, "product_brand"), {"product_brand_freq": 6})


@query("sales_trend_fit", f"""WITH {GROSS_DAILY_CTE},
t AS (SELECT ds, y, row_number() OVER (ORDER BY ds) - 1 AS t FROM d)
SELECT {R("regr_slope(y, t)", 6)} AS slope, {R("regr_intercept(y, t)", 4)} AS intercept,
       {R("regr_r2(y, t)", 6)} AS r2, CAST(regr_count(y, t) AS BIGINT) AS n,
       CASE WHEN regr_slope(y, t) > 0 THEN 'upward' WHEN regr_slope(y, t) < 0 THEN 'downward'
            WHEN regr_slope(y, t) IS NOT NULL THEN 'flat' END AS trend
FROM t""", covers=("A39", "F17", "W10", "E27"))
def q_sales_trend_fit(spark, sf_dir):
    from ..operators.windows import time_index
    t = time_index(gross_daily(spark, sf_dir), ["ds"], out="t")
    out = A.linear_fit(t, "y", "t").withColumn("n", F.col("n").cast("long"))
    return rounded(out, {"slope": 6, "intercept": 4, "r2": 6})


_TX_HC = tx_sql(["transaction_id", "line_number", "product_id", "product_brand", "product_category",
                 "product_name", "market_segment"])


@query("high_cardinality_encoding", f"""WITH tx AS ({_TX_HC}),
c AS (SELECT product_name, count(*) AS n FROM tx WHERE product_name IS NOT NULL GROUP BY 1)
SELECT tx.transaction_id, tx.line_number, tx.product_id, tx.product_brand, tx.product_category,
       tx.market_segment, {R("c.n / (SELECT sum(n) FROM c)", 8)} AS product_name
FROM tx LEFT JOIN c ON tx.product_name = c.product_name""", covers=("A35", "E29"))
def q_high_cardinality_encoding(spark, sf_dir):
    """Columns with more than 50 distinct values are replaced by their value share;
    the others (brand 25, category 6, segment 5 values) stay as they are."""
    tx = transactions(spark, sf_dir, ["transaction_id", "line_number", "product_id",
                                      "product_brand", "product_category", "product_name",
                                      "market_segment"])
    out = A.frequency_encode_wide(tx, ["product_brand", "product_category", "product_name",
                                       "market_segment"], min_distinct=50)
    return rounded(out, {"product_name": 8})
