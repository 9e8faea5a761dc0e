"""Time questions: period sums, resampling grids, day-grain series features,
calendar and holiday features, as-of indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..operators.clean import fill_defaults
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import windows as Wn
from ..sources.tables import money, transactions, tx_sql
from .registry import query, rounded

_TX_MS = tx_sql(["transaction_date", "quantity", "unit_price"])


@query("monthly_sales", f"""WITH tx AS ({_TX_MS})
SELECT strftime(transaction_date, '%Y-%m') AS month, ROUND((sum(quantity * unit_price)) + sign(sum(quantity * unit_price)) * least(abs(sum(quantity * unit_price)) * 1e-11, 1e-7), 4) AS sales
FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1""", covers=("A3",))
def q_monthly_sales(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_date", "quantity", "unit_price"])
    return rounded(A.monthly_sales(tx), {"sales": 4})


_TX_DS = tx_sql(["transaction_date", "total_sales"])
_TX_GS = tx_sql(["transaction_date", "gross_sales"])


@query("sales_by_period", f"""WITH tx AS ({_TX_GS})
SELECT 'week' AS grain, date_trunc('week', transaction_date)::DATE AS period_start,
       ROUND((CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) + sign(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) * least(abs(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) * 1e-11, 1e-7), 4) AS sales FROM tx WHERE transaction_date IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'month', date_trunc('month', transaction_date)::DATE, ROUND((CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) + sign(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) * least(abs(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) * 1e-11, 1e-7), 4)
FROM tx WHERE transaction_date IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'year', date_trunc('year', transaction_date)::DATE, ROUND((CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) + sign(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) * least(abs(CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE)) * 1e-11, 1e-7), 4)
FROM tx WHERE transaction_date IS NOT NULL GROUP BY 2""", covers=("A16", "T8"))
def q_sales_by_period(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_date", "gross_sales"])
    tx = tx.withColumn("gross_sales", money("gross_sales"))
    out = A.sales_by_periods(tx, ("week", "month", "year"), sales="gross_sales")
    return rounded(out, {"sales": 4})


@query("sales_by_month_and_week", f"""WITH tx AS ({_TX_DS})
SELECT 'month' AS kind, CAST(month(transaction_date) AS INTEGER) AS period, ROUND((sum(total_sales)) + sign(sum(total_sales)) * least(abs(sum(total_sales)) * 1e-11, 1e-7), 4) AS sales
FROM tx WHERE transaction_date IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'iso_week', CAST(weekofyear(transaction_date) AS INTEGER), ROUND((sum(total_sales)) + sign(sum(total_sales)) * least(abs(sum(total_sales)) * 1e-11, 1e-7), 4)
FROM tx WHERE transaction_date IS NOT NULL GROUP BY 2""", covers=("A17", "F1"))
def q_sales_by_month_and_week(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_date", "total_sales"])
    return rounded(A.sales_by_month_and_week(tx), {"sales": 4})


@query("daily_sales", f"""WITH tx AS ({_TX_DS})
SELECT transaction_date AS ds, ROUND((sum(total_sales)) + sign(sum(total_sales)) * least(abs(sum(total_sales)) * 1e-11, 1e-7), 4) AS y FROM tx
WHERE transaction_date IS NOT NULL GROUP BY 1""", covers=("A21",))
def q_daily_sales(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_date", "total_sales"])
    return rounded(A.daily_sales(tx), {"y": 4})


@query("month_of_year_profile", f"""WITH tx AS ({_TX_GS}),
d AS (SELECT transaction_date AS ds, CAST(sum(CAST(gross_sales AS DECIMAL(18,4))) AS DOUBLE) AS y FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1)
SELECT CAST(month(ds) AS INTEGER) AS month, ROUND((sum(y)) + sign(sum(y)) * least(abs(sum(y)) * 1e-11, 1e-7), 4) AS sum_sales, ROUND((avg(y)) + sign(avg(y)) * least(abs(avg(y)) * 1e-11, 1e-7), 4) AS mean_sales,
       CAST(count(y) AS BIGINT) AS n_days FROM d GROUP BY 1""", covers=("A22",))
def q_month_of_year_profile(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_date", "gross_sales"])
    tx = tx.withColumn("gross_sales", money("gross_sales"))
    return rounded(A.month_of_year_profile(A.daily_sales(tx, sales="gross_sales")),
                   {"sum_sales": 4, "mean_sales": 4})


@query("month_end_resample", f"""WITH tx AS ({_TX_DS}),
m AS (SELECT date_trunc('month', transaction_date)::DATE AS mon, sum(total_sales) AS s FROM tx
      WHERE transaction_date IS NOT NULL GROUP BY 1),
grid AS (SELECT unnest(generate_series((SELECT min(mon) FROM m), (SELECT max(mon) FROM m),
                                       INTERVAL 1 MONTH))::DATE AS mon)
SELECT last_day(grid.mon) AS month_end, ROUND((coalesce(m.s, 0.0)) + sign(coalesce(m.s, 0.0)) * least(abs(coalesce(m.s, 0.0)) * 1e-11, 1e-7), 4) AS sales
FROM grid LEFT JOIN m ON grid.mon = m.mon""", covers=("A18",))
def q_month_end_resample(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_date", "total_sales"])
    m = (tx.where(F.col("transaction_date").isNotNull())
           .groupBy(F.trunc("transaction_date", "month").alias("mon"))
           .agg(F.sum("total_sales").alias("s")))
    grid = C.date_spine(m, "mon", step="month", out="mon")
    out = grid.join(m, "mon", "left").select(
        F.last_day("mon").alias("month_end"),
        F.coalesce(F.col("s"), F.lit(0.0)).alias("sales"))
    return rounded(out, {"sales": 4})


@query("weekly_resample_sunday", f"""WITH tx AS ({_TX_DS}),
w AS (SELECT transaction_date + CAST((7 - isodow(transaction_date)) % 7 AS INTEGER) AS week_end,
             sum(total_sales) AS s FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1),
grid AS (SELECT unnest(generate_series((SELECT min(week_end) FROM w), (SELECT max(week_end) FROM w),
                                       INTERVAL 7 DAY))::DATE AS week_end)
SELECT grid.week_end, ROUND((coalesce(w.s, 0.0)) + sign(coalesce(w.s, 0.0)) * least(abs(coalesce(w.s, 0.0)) * 1e-11, 1e-7), 4) AS sales
FROM grid LEFT JOIN w ON grid.week_end = w.week_end""", covers=("A19",))
def q_weekly_resample_sunday(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_date", "total_sales"])
    w = (tx.where(F.col("transaction_date").isNotNull())
           .groupBy(C.week_ending_sunday("transaction_date").alias("week_end"))
           .agg(F.sum("total_sales").alias("s")))
    lo = w.select(F.min("week_end")).scalar()
    hi = w.select(F.max("week_end")).scalar()
    grid = spark.range(1).select(
        F.explode(F.sequence(lo, hi, F.expr("INTERVAL 7 DAYS"))).alias("week_end"))
    out = grid.join(w, "week_end", "left").select(
        "week_end", F.coalesce(F.col("s"), F.lit(0.0)).alias("sales"))
    return rounded(out, {"sales": 4})


@query("daily_asfreq", f"""WITH tx AS ({_TX_DS}),
d AS (SELECT transaction_date AS ds, sum(total_sales) AS y FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1),
grid AS (SELECT unnest(generate_series((SELECT min(ds) FROM d), (SELECT max(ds) FROM d), INTERVAL 1 DAY))::DATE AS ds)
SELECT grid.ds, ROUND((d.y) + sign(d.y) * least(abs(d.y) * 1e-11, 1e-7), 4) AS y FROM grid LEFT JOIN d ON grid.ds = d.ds""", covers=("A20",))
def q_daily_asfreq(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_date", "total_sales"])
    d = A.daily_sales(tx)
    grid = C.date_spine(d, "ds")
    return rounded(grid.join(d, "ds", "left"), {"y": 4})


_TX_ROW = tx_sql(["transaction_id", "line_number", "product_id", "transaction_date", "total_sales"])


@query("monthly_trend_feature", f"""WITH tx AS ({_TX_ROW}),
r AS (SELECT *, strftime(transaction_date, '%Y-%m') AS year_month FROM tx),
m AS (SELECT year_month, sum(total_sales) AS monthly_sales_trends FROM r WHERE year_month IS NOT NULL GROUP BY 1)
SELECT r.transaction_id, r.line_number, r.product_id, r.year_month,
       ROUND((m.monthly_sales_trends) + sign(m.monthly_sales_trends) * least(abs(m.monthly_sales_trends) * 1e-11, 1e-7), 4) AS monthly_sales_trends
FROM r LEFT JOIN m ON r.year_month = m.year_month""", covers=("A10", "J5"))
def q_monthly_trend_feature(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_id", "line_number", "product_id",
                                      "transaction_date", "total_sales"])
    out = A.monthly_trend_feature(tx).select("transaction_id", "line_number", "product_id",
                                             "year_month", "monthly_sales_trends")
    return rounded(out, {"monthly_sales_trends": 4})


@query("seasonal_trend_feature", f"""WITH tx AS ({_TX_ROW}),
r AS (SELECT *, CAST(month(transaction_date) AS INTEGER) AS month FROM tx),
m AS (SELECT month, avg(total_sales) AS seasonal_sales_trends FROM r WHERE month IS NOT NULL GROUP BY 1)
SELECT r.transaction_id, r.line_number, r.product_id, r.month,
       ROUND((m.seasonal_sales_trends) + sign(m.seasonal_sales_trends) * least(abs(m.seasonal_sales_trends) * 1e-11, 1e-7), 4) AS seasonal_sales_trends
FROM r LEFT JOIN m ON r.month = m.month""", covers=("A11", "F5"))
def q_seasonal_trend_feature(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_id", "line_number", "product_id",
                                      "transaction_date", "total_sales"])
    out = A.seasonal_trend_feature(tx).select("transaction_id", "line_number", "product_id",
                                              "month", "seasonal_sales_trends")
    return rounded(out, {"seasonal_sales_trends": 4})


# ------------------------------------------------------------------ day-grain series per region
_TX_REG = tx_sql(["region", "transaction_date", "total_sales"])
REGION_DAILY_CTE = f"""tx AS ({_TX_REG}),
d AS (SELECT region, transaction_date AS ds, sum(total_sales) AS y FROM tx
      WHERE region IS NOT NULL AND transaction_date IS NOT NULL GROUP BY 1, 2)"""


def region_daily(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["region", "transaction_date", "total_sales"])
    return A.daily_sales(tx, keys=["region"])


_LAGS = (1, 2, 3, 7, 14, 30)


@query("daily_lag_features", f"""WITH {REGION_DAILY_CTE}
SELECT region, ds, ROUND((y) + sign(y) * least(abs(y) * 1e-11, 1e-7), 4) AS y,
  {", ".join(f"ROUND((lag(y, {n}) OVER (PARTITION BY region ORDER BY ds)) + sign(lag(y, {n}) OVER (PARTITION BY region ORDER BY ds)) * least(abs(lag(y, {n}) OVER (PARTITION BY region ORDER BY ds)) * 1e-11, 1e-7), 4) AS lag_{n}" for n in _LAGS)}
FROM d""", covers=("W1", "W2", "W3"))
def q_daily_lag_features(spark, sf_dir):
    out = Wn.lag_features(region_daily(spark, sf_dir), "y", _LAGS, order=["ds"],
                          partition=["region"])
    return rounded(out, {c: 4 for c in ["y", *[f"lag_{n}" for n in _LAGS]]})


_ROLL = (3, 7, 14, 30)
_RSTATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "median": "median"}


def _roll_sql(n, stat, shift=0):
    frame = f"ROWS BETWEEN {n - 1 + shift} PRECEDING AND {'CURRENT ROW' if not shift else f'{shift} PRECEDING'}"
    w = f"OVER (PARTITION BY region ORDER BY ds {frame})"
    name = f"rolling_{stat}_{n}" + (f"_lag{shift}" if shift else "")
    return f"ROUND((CASE WHEN count(y) {w} = {n} THEN {_RSTATS[stat]}(y) {w} END) + sign(CASE WHEN count(y) {w} = {n} THEN {_RSTATS[stat]}(y) {w} END) * least(abs(CASE WHEN count(y) {w} = {n} THEN {_RSTATS[stat]}(y) {w} END) * 1e-11, 1e-7), 4) AS {name}"


@query("daily_rolling_features", f"""WITH {REGION_DAILY_CTE}
SELECT region, ds, ROUND((y) + sign(y) * least(abs(y) * 1e-11, 1e-7), 4) AS y,
  {", ".join(_roll_sql(n, s) for n in _ROLL for s in _RSTATS)}
FROM d""", covers=("W4", "W5"))
def q_daily_rolling_features(spark, sf_dir):
    out = Wn.rolling_stats(region_daily(spark, sf_dir), "y", _ROLL, order=["ds"],
                           partition=["region"], stats=list(_RSTATS))
    return rounded(out, {c: 4 for c in out.columns if c not in ("region", "ds")})


@query("daily_lagged_rolling", f"""WITH {REGION_DAILY_CTE}
SELECT region, ds, ROUND((y) + sign(y) * least(abs(y) * 1e-11, 1e-7), 4) AS y, {_roll_sql(7, "mean", 1)}, {_roll_sql(7, "std", 1)}
FROM d""", covers=("W6",))
def q_daily_lagged_rolling(spark, sf_dir):
    out = Wn.rolling_stats(region_daily(spark, sf_dir), "y", [7], order=["ds"],
                           partition=["region"], stats=["mean", "std"], shift=1)
    return rounded(out, {c: 4 for c in out.columns if c not in ("region", "ds")})


@query("daily_minmax_scaled", f"""WITH {REGION_DAILY_CTE}
SELECT region, ds, ROUND((y) + sign(y) * least(abs(y) * 1e-11, 1e-7), 4) AS y,
  ROUND((CASE WHEN max(y) OVER (PARTITION BY region) = min(y) OVER (PARTITION BY region) THEN 0.0
        ELSE (y - min(y) OVER (PARTITION BY region)) / (max(y) OVER (PARTITION BY region) - min(y) OVER (PARTITION BY region)) END) + sign(CASE WHEN max(y) OVER (PARTITION BY region) = min(y) OVER (PARTITION BY region) THEN 0.0
        ELSE (y - min(y) OVER (PARTITION BY region)) / (max(y) OVER (PARTITION BY region) - min(y) OVER (PARTITION BY region)) END) * least(abs(CASE WHEN max(y) OVER (PARTITION BY region) = min(y) OVER (PARTITION BY region) THEN 0.0
        ELSE (y - min(y) OVER (PARTITION BY region)) / (max(y) OVER (PARTITION BY region) - min(y) OVER (PARTITION BY region)) END) * 1e-11, 1e-7), 6)
    AS y_scaled
FROM d""", covers=("W17",))
def q_daily_minmax_scaled(spark, sf_dir):
    out = Wn.min_max_scale(region_daily(spark, sf_dir), "y", partition=["region"])
    return rounded(out, {"y": 4, "y_scaled": 6})


DAILY_CTE = f"""tx AS ({_TX_DS}),
d AS (SELECT transaction_date AS ds, sum(total_sales) AS y FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1)"""


def daily(spark, sf_dir):
    return A.daily_sales(transactions(spark, sf_dir, ["transaction_date", "total_sales"]))


GROSS_DAILY_CTE = f"""tx AS ({_TX_GS}),
d AS (SELECT transaction_date AS ds, sum(gross_sales) AS y FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1)"""


def gross_daily(spark, sf_dir, keys=()):
    """Daily quantity × unit price (the sales of the trend and seasonality reports)."""
    cols = ["transaction_date", "gross_sales", *keys]
    return A.daily_sales(transactions(spark, sf_dir, cols), sales="gross_sales", keys=keys)


@query("daily_sequences", f"""WITH {DAILY_CTE},
r AS (SELECT ds, ROUND(y + sign(y) * least(abs(y) * 1e-11, 1e-7), 4) AS y FROM d),
s AS (SELECT ds, y, list(y) OVER (ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sequence FROM r)
SELECT ds, sequence, y AS target FROM s WHERE len(sequence) = 7""", covers=("W16",))
def q_daily_sequences(spark, sf_dir):
    d = rounded(daily(spark, sf_dir), {"y": 4})
    return Wn.sliding_sequences(d, "y", 7, order=["ds"])


@query("market_indicators_asof", f"""WITH {DAILY_CTE},
ind AS (SELECT ds, y,
   CASE WHEN count(y) OVER w = 30 THEN avg(y) OVER w END AS ma_30,
   CASE WHEN count(y) OVER w = 30 THEN stddev_samp(y) OVER w END AS volatility_30
  FROM d WINDOW w AS (ORDER BY ds ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
ind2 AS (SELECT ds, ma_30, volatility_30, coalesce(CAST(y > ma_30 AS INTEGER), 0) AS sentiment FROM ind),
grid AS (SELECT unnest(generate_series((SELECT min(ds) FROM d), (SELECT max(ds) FROM d), INTERVAL 1 DAY))::DATE AS ds),
g AS (SELECT grid.ds, ind2.ma_30, ind2.volatility_30, ind2.sentiment FROM grid LEFT JOIN ind2 ON grid.ds = ind2.ds)
SELECT ds,
  ROUND((last_value(ma_30 IGNORE NULLS) OVER o) + sign(last_value(ma_30 IGNORE NULLS) OVER o) * least(abs(last_value(ma_30 IGNORE NULLS) OVER o) * 1e-11, 1e-7), 4) AS ma_30,
  ROUND((last_value(volatility_30 IGNORE NULLS) OVER o) + sign(last_value(volatility_30 IGNORE NULLS) OVER o) * least(abs(last_value(volatility_30 IGNORE NULLS) OVER o) * 1e-11, 1e-7), 4) AS volatility_30,
  last_value(sentiment IGNORE NULLS) OVER o AS sentiment
FROM g WINDOW o AS (ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
       covers=("W7", "J7"))
def q_market_indicators_asof(spark, sf_dir):
    ind = indicators_asof(spark, sf_dir)
    return rounded(ind, {"ma_30": 4, "volatility_30": 4})


def indicators_asof(spark, sf_dir):
    d = daily(spark, sf_dir)
    ind = Wn.moving_average_signal(d, "y", order=["ds"], n=30).drop("y")
    grid = C.date_spine(d, "ds")
    return J.asof_fill(grid, ind, "ds", ["ma_30", "volatility_30", "sentiment"])


_TX_J6 = tx_sql(["transaction_id", "line_number", "product_id", "transaction_date", "total_sales"])


@query("rows_with_indicators", f"""WITH {DAILY_CTE},
ind AS (SELECT ds, y, CASE WHEN count(y) OVER w = 30 THEN avg(y) OVER w END AS ma_30
  FROM d WINDOW w AS (ORDER BY ds ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
grid AS (SELECT unnest(generate_series((SELECT min(ds) FROM d), (SELECT max(ds) FROM d), INTERVAL 1 DAY))::DATE AS ds),
g AS (SELECT grid.ds, last_value(ind.ma_30 IGNORE NULLS) OVER (ORDER BY grid.ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ma_30
      FROM grid LEFT JOIN ind ON grid.ds = ind.ds),
rows AS ({_TX_J6})
SELECT rows.transaction_id, rows.line_number, rows.product_id, rows.transaction_date,
       ROUND((coalesce(g.ma_30, 4000.0)) + sign(coalesce(g.ma_30, 4000.0)) * least(abs(coalesce(g.ma_30, 4000.0)) * 1e-11, 1e-7), 4) AS ma_30
FROM rows LEFT JOIN g ON rows.transaction_date = g.ds""", covers=("J6", "P21"))
def q_rows_with_indicators(spark, sf_dir):
    ind = indicators_asof(spark, sf_dir).select("ds", "ma_30")
    tx = transactions(spark, sf_dir, ["transaction_id", "line_number", "product_id",
                                      "transaction_date"])
    out = J.attach_by_date(tx, ind, "transaction_date")
    # default when the indicator is missing (first 29 days): a parameter
    out = fill_defaults(out, {"ma_30": 4000.0})
    return rounded(out, {"ma_30": 4})


# ------------------------------------------------------------------ calendar features
_TX_DATES = tx_sql(["transaction_date"])


@query("calendar_features", f"""WITH tx AS ({_TX_DATES}),
d AS (SELECT DISTINCT transaction_date AS ds FROM tx WHERE transaction_date IS NOT NULL)
SELECT ds, CAST(year(ds) AS INTEGER) AS year, CAST(month(ds) AS INTEGER) AS month,
  CAST(day(ds) AS INTEGER) AS day, CAST(quarter(ds) AS INTEGER) AS quarter,
  CAST(dayofyear(ds) AS INTEGER) AS day_of_year, CAST(weekofyear(ds) AS INTEGER) AS week_of_year,
  CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week,
  CASE WHEN isodow(ds) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend,
  CAST(ds = date_trunc('month', ds) AS INTEGER) AS is_month_start,
  CAST(ds = last_day(ds) AS INTEGER) AS is_month_end,
  CAST(ds = date_trunc('quarter', ds) AS INTEGER) AS is_quarter_start,
  CAST(ds = CAST(date_trunc('quarter', ds) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS INTEGER) AS is_quarter_end,
  ROUND((sin(month(ds) * 2 * pi() / 12)) + sign(sin(month(ds) * 2 * pi() / 12)) * least(abs(sin(month(ds) * 2 * pi() / 12)) * 1e-11, 1e-7), 6) + 0.0 AS month_sin, ROUND((cos(month(ds) * 2 * pi() / 12)) + sign(cos(month(ds) * 2 * pi() / 12)) * least(abs(cos(month(ds) * 2 * pi() / 12)) * 1e-11, 1e-7), 6) + 0.0 AS month_cos,
  ROUND((sin((isodow(ds) - 1) * 2 * pi() / 7)) + sign(sin((isodow(ds) - 1) * 2 * pi() / 7)) * least(abs(sin((isodow(ds) - 1) * 2 * pi() / 7)) * 1e-11, 1e-7), 6) + 0.0 AS day_of_week_sin,
  ROUND((cos((isodow(ds) - 1) * 2 * pi() / 7)) + sign(cos((isodow(ds) - 1) * 2 * pi() / 7)) * least(abs(cos((isodow(ds) - 1) * 2 * pi() / 7)) * 1e-11, 1e-7), 6) + 0.0 AS day_of_week_cos
FROM d""", covers=("F1", "F2", "F3", "F4", "F5"))
def q_calendar_features(spark, sf_dir):
    d = (transactions(spark, sf_dir, ["transaction_date"])
         .select(F.col("transaction_date").alias("ds")).where(F.col("ds").isNotNull()).distinct())
    out = d.withColumns({**C.date_parts("ds"), **C.period_flags("ds"), **C.cyclic_calendar("ds")})
    trig = ("month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos")
    out = rounded(out, {c: 6 for c in trig})
    # + 0.0 turns a rounded -0.0 into 0.0 (engines differ on the zero sign)
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in trig})


HOLIDAY_SQL_CTE = """yrs AS (SELECT unnest(range(CAST(min(year(ds)) AS INTEGER) - 1, CAST(max(year(ds)) AS INTEGER) + 2)) AS y FROM d),
fixed AS (SELECT make_date(y, m, dd) AS hd FROM yrs, (VALUES (1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0)) v(m, dd, since)
          WHERE y >= since),
obs AS (SELECT CASE isodow(hd) WHEN 6 THEN hd - 1 WHEN 7 THEN hd + 1 END AS hd FROM fixed WHERE isodow(hd) IN (6, 7)),
flo AS (SELECT make_date(y, m, 1) + CAST(((k - isodow(make_date(y, m, 1)) + 7) % 7) + 7 * (n - 1) AS INTEGER) AS hd
        FROM yrs, (VALUES (1, 1, 3, 1986), (2, 1, 3, 0), (9, 1, 1, 0), (10, 1, 2, 0), (11, 4, 4, 0)) v(m, k, n, since)
        WHERE y >= since),
mem AS (SELECT make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) AS hd FROM yrs),
hol AS (SELECT hd FROM fixed UNION SELECT hd FROM obs UNION SELECT hd FROM flo UNION SELECT hd FROM mem)"""


@query("holiday_features", f"""WITH tx AS ({_TX_DATES}),
d AS (SELECT DISTINCT transaction_date AS ds FROM tx WHERE transaction_date IS NOT NULL),
{HOLIDAY_SQL_CTE}
SELECT ds,
  CAST(ds IN (SELECT hd FROM hol) AS INTEGER) AS is_holiday,
  CAST(coalesce((SELECT min(abs(ds - hd)) FROM hol WHERE abs(ds - hd) <= 30), 30) AS INTEGER) AS days_to_holiday,
  CAST(month(ds) = 12 AND day(ds) >= 15 AS INTEGER) AS is_christmas_season,
  CAST(month(ds) = 1 AND day(ds) <= 7 AS INTEGER) AS is_new_year,
  CAST(ds = make_date(year(ds), 11, 1) + CAST(((4 - isodow(make_date(year(ds), 11, 1)) + 7) % 7) + 22 AS INTEGER) AS INTEGER)
    AS is_black_friday
FROM d""", covers=("F7", "F8", "F9", "J8", "J9"))
def q_holiday_features(spark, sf_dir):
    d = (transactions(spark, sf_dir, ["transaction_date"])
         .select(F.col("transaction_date").alias("ds")).where(F.col("ds").isNotNull()).distinct())
    hol = C.us_holidays(C.years_of(d, "ds"))
    flagged = J.holiday_flag(d, hol, "ds")
    dist = J.holiday_distance(d, hol, "ds", max_days=30)
    s = C.season_flags("ds")
    return (flagged.join(dist, "ds", "left")
            .withColumns({k: s[k] for k in ("is_christmas_season", "is_new_year",
                                            "is_black_friday")}))
