"""Cleaning and shaping queries (P operators) on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import clean as P
from ..operators import windows as Wn
from ..sources.tables import customers, table, transactions, tx_sql
from .q_customers import RFM_CTE, rfm_frame
from .q_time import REGION_DAILY_CTE, region_daily
from .registry import R, query, rounded


@query("text_dates_parsed", """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS transaction_date,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS iso_date, o_totalprice AS total_price
FROM orders""", covers=("P3", "P4"))
def q_text_dates_parsed(spark, sf_dir):
    # the raw form: text dates as MM-dd-yyyy and numbers as text, as a CSV holds them
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "MM-dd-yyyy").alias("transaction_date"),
        F.col("o_totalprice").cast("string").alias("total_price"))
    raw = raw.withColumn("iso_date", F.col("transaction_date"))
    typed = P.clean_types(raw, double_cols=["total_price"], date_cols=["transaction_date"],
                          date_format="MM-dd-yyyy")
    return P.convert_date_format(typed, ["iso_date"], source="M-d-yyyy")


_TX_A8 = tx_sql(["product_id", "unit_price"])


@query("product_price_std_imputed", f"""WITH tx AS ({_TX_A8}),
g AS (SELECT product_id, stddev_samp(unit_price) AS s FROM tx WHERE product_id IS NOT NULL GROUP BY 1)
SELECT product_id, {R("s")} AS product_unit_price_std,
       {R("coalesce(s, (SELECT avg(s) FROM g))")} AS product_unit_price_std_imputed
FROM g""", covers=("P5", "P15"))
def q_product_price_std_imputed(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["product_id", "unit_price"])
    g = (tx.where(F.col("product_id").isNotNull()).groupBy("product_id")
           .agg(F.stddev_samp("unit_price").alias("product_unit_price_std")))
    out = P.impute_mean(g, ["product_unit_price_std"])
    return rounded(out, {"product_unit_price_std": 4, "product_unit_price_std_imputed": 4})


_LAGS = (1, 7, 30)


@query("lag_features_zero_filled", f"""WITH {REGION_DAILY_CTE}
SELECT region, ds, {R("y")} AS y,
  {", ".join(f"{R(f'coalesce(lag(y, {n}) OVER (PARTITION BY region ORDER BY ds), 0)')} AS lag_{n}" for n in _LAGS)}
FROM d""", covers=("P7",))
def q_lag_features_zero_filled(spark, sf_dir):
    out = Wn.lag_features(region_daily(spark, sf_dir), "y", _LAGS, order=["ds"],
                          partition=["region"])
    out = P.fill_zero(out, [f"lag_{n}" for n in _LAGS])
    return rounded(out, {c: 4 for c in ["y", *[f"lag_{n}" for n in _LAGS]]})


_TX_TOPCAT = tx_sql(["customer_id", "product_category"])


@query("customer_top_category", f"""WITH tx AS ({_TX_TOPCAT}),
c AS (SELECT customer_id, product_category, count(*) AS n FROM tx
      WHERE customer_id IS NOT NULL AND product_category IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, product_category) AS rn FROM c)
SELECT cu.c_custkey AS customer_id, coalesce(r.product_category, 'Unknown') AS top_category
FROM customer cu LEFT JOIN r ON cu.c_custkey = r.customer_id AND r.rn = 1""", covers=("P6", "A33"))
def q_customer_top_category(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["customer_id", "product_category"])
    top = A.group_profile(tx, "customer_id", [], ["product_category"]).select(
        "customer_id", F.col("mode_product_category").alias("top_category"))
    cust = customers(spark, sf_dir, with_geo=False).select(F.col("c_custkey").alias("customer_id"))
    return P.fill_unknown(cust.join(top, "customer_id", "left"), ["top_category"])


_TX_W = tx_sql(["transaction_id", "line_number", "product_id", "supplier_id", "quantity"])


@query("winsorized_quantity", f"""WITH tx AS ({_TX_W}),
q AS (SELECT quantile_cont(quantity, 0.01) AS lo, quantile_cont(quantity, 0.99) AS hi FROM tx)
SELECT transaction_id, line_number, product_id, supplier_id,
       {R("least(greatest(quantity, (SELECT lo FROM q)), (SELECT hi FROM q))")} AS quantity
FROM tx""", covers=("P13",))
def q_winsorized_quantity(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_id", "line_number", "product_id",
                                      "supplier_id", "quantity"])
    # quantity has a bounded domain, so the exact percentile buffer is small
    return rounded(P.winsorize(tx, ["quantity"], exact=True), {"quantity": 4})


@query("small_active_customers", f"""WITH {RFM_CTE}
SELECT customer_id, frequency, {R("monetary")} AS monetary FROM rfm
WHERE frequency <= 40 AND monetary <= 1500000 AND churn = 0""", covers=("P11", "P12"))
def q_small_active_customers(spark, sf_dir):
    r = rfm_frame(spark, sf_dir)
    out = P.range_filter(r, {"frequency": 40, "monetary": 1_500_000}).where(F.col("churn") == 0)
    return rounded(out.select("customer_id", "frequency", "monetary"), {"monetary": 4})


@query("churn_risk_tiers", f"""WITH {RFM_CTE},
s AS (SELECT customer_id, recency / (SELECT max(recency) FROM rfm) AS score FROM rfm)
SELECT customer_id, {R("score", 6)} AS churn_score,
       CASE WHEN score > 0.7 THEN 'High' WHEN score > 0.3 THEN 'Medium' WHEN score IS NOT NULL THEN 'Low' END AS risk_tier
FROM s""", covers=("P18", "W13"))
def q_churn_risk_tiers(spark, sf_dir):
    r = Wn.normalize_by_max(rfm_frame(spark, sf_dir), "recency", out="churn_score")
    out = r.select("customer_id", "churn_score", P.risk_tier("churn_score").alias("risk_tier"))
    return rounded(out, {"churn_score": 6})


@query("income_levels", """
SELECT c_custkey AS customer_id,
       CASE WHEN c_acctbal < 2500 THEN 'Low' WHEN c_acctbal < 6000 THEN 'Medium'
            WHEN c_acctbal IS NOT NULL THEN 'High' END AS income_bracket,
       CASE WHEN c_acctbal < 2500 THEN 1 WHEN c_acctbal < 6000 THEN 2 WHEN c_acctbal IS NOT NULL THEN 3 ELSE 0 END
         AS income_level
FROM customer""", covers=("P19",))
def q_income_levels(spark, sf_dir):
    from ..sources.tables import income_bracket
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        income_bracket(F.col("c_acctbal")).alias("income_bracket"))
    return c.withColumn("income_level", P.ordinal_level("income_bracket"))


_TX_CAT = tx_sql(["product_category"])


@query("distinct_categories", f"""WITH tx AS ({_TX_CAT})
SELECT DISTINCT product_category FROM tx""", covers=("P16",))
def q_distinct_categories(spark, sf_dir):
    return P.distinct_values(transactions(spark, sf_dir, ["product_category"]), "product_category")


_TX_SER = tx_sql(["product_id", "transaction_date", "total_sales"])


@query("series_min_length", f"""WITH tx AS ({_TX_SER}),
d AS (SELECT product_id, transaction_date AS ds, sum(total_sales) AS y FROM tx
      WHERE product_id IS NOT NULL AND transaction_date IS NOT NULL GROUP BY 1, 2),
ok AS (SELECT product_id FROM d GROUP BY 1 HAVING count(*) >= 30)
SELECT product_id, ds, {R("y")} AS y FROM d WHERE product_id IN (SELECT product_id FROM ok)""",
       covers=("P23",))
def q_series_min_length(spark, sf_dir):
    d = A.daily_sales(transactions(spark, sf_dir, ["product_id", "transaction_date", "total_sales"]),
                      keys=["product_id"])
    return rounded(P.series_with_min_length(d, ["product_id"], 30), {"y": 4})


_NUM = ["quantity", "unit_price", "discount_applied", "discount_pct", "total_sales",
        "account_balance", "retail_price", "product_size"]


@query("numeric_null_profile", "WITH tx AS (" + tx_sql(_NUM) + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM tx" for c in _NUM),
       covers=("A37", "P15"))
def q_numeric_null_profile(spark, sf_dir):
    # schema-driven: keep the numeric columns of a mixed projection
    tx = transactions(spark, sf_dir, [*_NUM, "channel", "product_category"])
    return A.null_counts(tx.select(*P.numeric_columns(tx)))


_TX_WIDE = tx_sql(["transaction_id", "customer_id", "product_id", "product_category",
                   "transaction_date", "quantity", "unit_price", "store_state"])


@query("wide_csv_split", f"""WITH tx AS ({_TX_WIDE})
SELECT 'customer' AS part, CAST(count(DISTINCT customer_id) AS BIGINT) AS rows FROM tx
UNION ALL SELECT 'product', CAST(count(DISTINCT product_id) AS BIGINT) FROM tx
UNION ALL SELECT 'transaction', CAST(count(*) AS BIGINT) FROM tx
UNION ALL SELECT 'store', CAST(count(*) AS BIGINT) FROM tx
UNION ALL SELECT 'weekend_lines', CAST(sum(CASE WHEN isodow(transaction_date) >= 6 THEN 1 ELSE 0 END) AS BIGINT) FROM tx
UNION ALL SELECT 'parsed_dates', CAST(count(transaction_date) AS BIGINT) FROM tx""",
       covers=("P1", "P2", "P3", "IO1", "IO6"))
def q_wide_csv_split(spark, sf_dir):
    """The wide retail CSV (text ids, MM-dd-yyyy dates, Yes/No flags) written to
    shared storage, read back with the declared schema, cleaned and split."""
    import uuid
    from ..sources import files as IO
    tx = transactions(spark, sf_dir, ["transaction_id", "customer_id", "product_id",
                                      "product_category", "transaction_date", "quantity",
                                      "unit_price", "store_state"])
    wide = tx.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.date_format("transaction_date", "MM-dd-yyyy").alias("transaction_date"),
        F.col("product_id").cast("string").alias("product_id"), "product_category", "quantity",
        "unit_price", "store_state",
        F.when(F.weekday("transaction_date") >= 5, "Yes").otherwise("No").alias("weekend"))
    path = IO.shared_path(spark, "io", f"wide-{uuid.uuid4().hex}")
    IO.write_table(wide, path, fmt="csv")
    back = IO.read_csv(spark, path, schema=IO.schema_for(wide.columns))
    back = P.clean_types(back, double_cols=["quantity", "unit_price"],
                         date_cols=["transaction_date"], date_format="MM-dd-yyyy")
    parts = P.split_tables(back.withColumn("weekend_flag", P.yes_no_flag("weekend")))
    tx_part = parts["transaction"]
    rows = [parts["customer"].select(F.lit("customer").alias("part"), F.count(F.lit(1)).alias("rows")),
            parts["product"].select(F.lit("product").alias("part"), F.count(F.lit(1)).alias("rows")),
            tx_part.select(F.lit("transaction").alias("part"), F.count(F.lit(1)).alias("rows")),
            parts["store"].select(F.lit("store").alias("part"), F.count(F.lit(1)).alias("rows")),
            tx_part.select(F.lit("weekend_lines").alias("part"),
                           F.sum("weekend_flag").cast("long").alias("rows")),
            tx_part.select(F.lit("parsed_dates").alias("part"),
                           F.count("transaction_date").alias("rows"))]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


_DAILY = tx_sql(["transaction_date", "total_sales"])


@query("train_mean_imputation", f"""WITH tx AS ({_DAILY}),
d AS (SELECT transaction_date AS ds, sum(total_sales) AS y FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1),
l AS (SELECT ds, y, lag(y, 7) OVER (ORDER BY ds) AS lag_7, row_number() OVER (ORDER BY ds) AS rn,
             count(*) OVER () AS n FROM d),
m AS (SELECT avg(lag_7) AS mu FROM l WHERE rn <= floor(n * 0.8))
SELECT ds, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split,
       {R("coalesce(lag_7, (SELECT mu FROM m))")} AS lag_7_imputed FROM l""", covers=("P8", "M9"))
def q_train_mean_imputation(spark, sf_dir):
    """Imputer fitted on the training days only, applied to train and test."""
    from ..models import prep as Mp
    d = A.daily_sales(transactions(spark, sf_dir, ["transaction_date", "total_sales"]))
    d = Wn.lag_features(d, "y", [7], order=["ds"])
    train, test = Mp.time_split(d, "ds", 0.8)
    model = P.fit_mean_imputer(train, ["lag_7"])
    out = (model.transform(train.withColumn("lag_7", F.col("lag_7").cast("double")))
           .withColumn("split", F.lit("train"))
           .unionByName(model.transform(test.withColumn("lag_7", F.col("lag_7").cast("double")))
                        .withColumn("split", F.lit("test"))))
    return rounded(out.select("ds", "split", "lag_7_imputed"), {"lag_7_imputed": 4})


@query("segment_string_index", """
WITH c AS (SELECT c_mktsegment AS market_segment, count(*) AS n FROM customer GROUP BY 1)
SELECT market_segment, CAST(row_number() OVER (ORDER BY n DESC, market_segment) - 1 AS DOUBLE) AS segment_index
FROM c""", covers=("M4",))
def q_segment_string_index(spark, sf_dir):
    """StringIndexer (most frequent first, ties alphabetical) fitted on customers."""
    from ..models.prep import string_index
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("market_segment"))
    model = string_index("market_segment", "segment_index").fit(c)
    return model.transform(c.distinct())
