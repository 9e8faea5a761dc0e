"""Series decomposition, stationarity and forecast queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import timeseries as TS
from ..session import cut_lineage
from ..sources.tables import transactions, tx_sql
from .q_time import GROSS_DAILY_CTE, REGION_DAILY_CTE, gross_daily, region_daily
from .registry import R, S, query, rnd, sigd

_TX_GS = tx_sql(["transaction_date", "gross_sales"])
WEEKLY_CTE = f"""tx AS ({_TX_GS}),
w AS (SELECT date_trunc('week', transaction_date)::DATE AS ds, sum(gross_sales) AS y FROM tx
      WHERE transaction_date IS NOT NULL GROUP BY 1)"""


def weekly(spark, sf_dir):
    tx = transactions(spark, sf_dir, ["transaction_date", "gross_sales"])
    return A.sales_by_period(tx, "week", sales="gross_sales").select(F.col("period_start").alias("ds"),
                                                F.col("sales").alias("y"))


@query("weekly_additive_decomposition", f"""WITH {WEEKLY_CTE},
t AS (SELECT ds, y, row_number() OVER (ORDER BY ds) - 1 AS t,
        CASE WHEN count(y) OVER f = 53
             THEN (sum(y) OVER f - 0.5 * first_value(y) OVER f - 0.5 * last_value(y) OVER f) / 52 END AS trend
      FROM w WINDOW f AS (ORDER BY ds ROWS BETWEEN 52 PRECEDING AND CURRENT ROW)),
d AS (SELECT *, y - trend AS det, t % 52 AS phase FROM t),
pm AS (SELECT phase, avg(det) AS pm FROM d WHERE det IS NOT NULL GROUP BY 1),
pc AS (SELECT phase, pm - (SELECT avg(pm) FROM pm) AS seasonal FROM pm)
SELECT d.ds, {S("d.y")} AS y, {S("d.trend")} AS trend, {S("pc.seasonal")} AS seasonal,
       {S("d.det - pc.seasonal")} AS resid
FROM d LEFT JOIN pc ON d.phase = pc.phase""", covers=("W14", "E27", "A16"))
def q_weekly_additive_decomposition(spark, sf_dir):
    out = TS.decompose(weekly(spark, sf_dir), "y", "ds", 52, model="additive", two_sided=False)
    return sigd(out.select("ds", "y", "trend", "seasonal", "resid"),
                ["y", "trend", "seasonal", "resid"])


@query("daily_multiplicative_decomposition", f"""WITH {GROSS_DAILY_CTE},
t AS (SELECT ds, y, row_number() OVER (ORDER BY ds) - 1 AS t,
        CASE WHEN count(y) OVER f = 365 THEN avg(y) OVER f END AS trend
      FROM d WINDOW f AS (ORDER BY ds ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING)),
x AS (SELECT *, y / trend AS det, t % 365 AS phase FROM t),
pm AS (SELECT phase, avg(det) AS pm FROM x WHERE det IS NOT NULL GROUP BY 1),
pc AS (SELECT phase, pm / (SELECT avg(pm) FROM pm) AS seasonal FROM pm)
SELECT x.ds, {S("x.y")} AS y, {S("x.trend")} AS trend, {S("pc.seasonal")} AS seasonal,
       {S("x.det / pc.seasonal")} AS resid
FROM x LEFT JOIN pc ON x.phase = pc.phase""", covers=("W15", "E26"))
def q_daily_multiplicative_decomposition(spark, sf_dir):
    out = TS.decompose(gross_daily(spark, sf_dir), "y", "ds", 365, model="multiplicative",
                       two_sided=True)
    return sigd(out.select("ds", "y", "trend", "seasonal", "resid"),
                ["y", "trend", "seasonal", "resid"])


_TX_RGS = tx_sql(["region", "transaction_date", "gross_sales"])
REGION_GROSS_CTE = f"""tx AS ({_TX_RGS}),
d AS (SELECT region, transaction_date AS ds, sum(gross_sales) AS y FROM tx
      WHERE region IS NOT NULL AND transaction_date IS NOT NULL GROUP BY 1, 2)"""


@query("region_stationarity", f"""WITH {REGION_GROSS_CTE},
x AS (SELECT region, ds, y, lag(y) OVER (PARTITION BY region ORDER BY ds) AS x FROM d),
g AS (SELECT region, regr_slope(y - x, x) AS b, regr_sxx(y - x, x) AS sxx, regr_syy(y - x, x) AS syy,
             regr_count(y - x, x) AS n FROM x GROUP BY region),
s AS (SELECT region, b / sqrt((syy - b * b * sxx) / (n - 2) / sxx) AS stat, n FROM g)
SELECT region, {S("stat")} AS adf_statistic, CAST(-2.86 AS DOUBLE) AS critical_5pct,
       CAST(stat < -2.86 AS INTEGER) AS is_stationary, CAST(n AS BIGINT) AS n FROM s""",
       covers=("L14",))
def q_region_stationarity(spark, sf_dir):
    out = TS.dickey_fuller(gross_daily(spark, sf_dir, keys=["region"]), "y", "ds", keys=["region"])
    return sigd(out, ["adf_statistic"])


@query("daily_fourier_forecast", None, covers=("L12", "E26"))
def q_daily_fourier_forecast(spark, sf_dir):
    fc, _ = TS.fourier_forecast(gross_daily(spark, sf_dir), horizon=30)
    return fc


_TERMS = {"t": "t", **{f"{name}_{f}{k}": f"{f}(2 * pi() * {k} / {period} * t)"
                       for name, (period, order) in TS.SEASONALITIES.items()
                       for k in range(1, order + 1) for f in ("sin", "cos")}}


@query("daily_fourier_moments", f"""WITH {GROSS_DAILY_CTE},
x AS (SELECT y, CAST(date_diff('day', min(ds) OVER (), ds) AS DOUBLE) AS t FROM d),
m AS (SELECT count(*) AS n, avg(y) AS mean, {", ".join(f"avg(y * {e}) AS {c}" for c, e in _TERMS.items())} FROM x)
{" UNION ALL ".join(f"SELECT '{c}' AS term, n AS n_days, CASE WHEN abs({c} / mean) >= 5e-5 THEN {R(f'{c} / mean', 4)} ELSE 0.0 END AS moment FROM m" for c in _TERMS)}""",
       covers=("L12", "E26"))
def q_daily_fourier_moments(spark, sf_dir):
    """The normal equations of the daily forecast: the fit has the data's moment with each of its terms."""
    f = cut_lineage(q_daily_fourier_forecast(spark, sf_dir).where("y IS NOT NULL"))
    t = F.datediff("ds", f.select(F.min("ds")).scalar()).cast("double")
    terms = {"t": t, **TS.fourier_terms(t)}
    wide = f.agg(F.count(F.lit(1)).alias("n_days"), F.avg("y").alias("mean"),
                 *[F.avg(F.col("yhat") * x).alias(c) for c, x in terms.items()])
    stack = ", ".join(f"'{c}', {c} / mean" for c in terms)
    out = wide.selectExpr("n_days", f"stack({len(terms)}, {stack}) AS (term, moment)")
    return out.withColumn("moment", F.when(F.abs("moment") >= 5e-5, rnd("moment")).otherwise(0.0))  # no -0.0


# smoothing of every (alpha, gamma) of the grid day by day; the season's slot of day i is i % 12
_HOLT_WINTERS = f"""WITH RECURSIVE {REGION_DAILY_CTE},
n AS (SELECT region, y AS v, row_number() OVER (PARTITION BY region ORDER BY ds) - 1 AS i,
        count(*) OVER (PARTITION BY region) AS n FROM d),
s AS (SELECT region, avg(v) AS level, list(v ORDER BY i) AS first FROM n WHERE i < 12 AND n > 24 GROUP BY 1),
g AS (SELECT unnest([0.1, 0.2, 0.3, 0.5, 0.7, 0.9]::DOUBLE[]) AS alpha),
h AS (SELECT unnest([0.05, 0.1, 0.2, 0.3, 0.5]::DOUBLE[]) AS gamma),
st AS (
  SELECT region, alpha, gamma, 0::BIGINT AS i, level, list_transform(first, lambda x: x - level) AS season,
         0.0::DOUBLE AS sse FROM s, g, h
  UNION ALL
  SELECT region, alpha, gamma, i + 1, new_level,
         list_concat(season[2:12], [gamma * (v - new_level) + (1 - gamma) * season[1]]),
         sse + (v - level - season[1]) * (v - level - season[1])
  FROM (SELECT st.*, n.v, alpha * (n.v - season[1]) + (1 - alpha) * level AS new_level
        FROM st JOIN n ON n.region = st.region AND n.i = st.i)),
e AS (SELECT st.* FROM st JOIN (SELECT region, max(i) + 1 AS last FROM n GROUP BY 1) z
      ON z.region = st.region AND z.last = st.i),
b AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY region ORDER BY sse) = 1),
p AS (SELECT unnest(range(1, 31)) AS step)
SELECT region, CAST(step AS INTEGER) AS step, {S("level + season[(step - 1) % 12 + 1]", 8)} AS forecast, alpha, gamma,
  {S("sse", 8)} AS sse FROM b, p"""


@query("region_holt_winters", _HOLT_WINTERS, covers=("L13",))
def q_region_holt_winters(spark, sf_dir):
    out = TS.holt_winters_additive(region_daily(spark, sf_dir), ["region"], period=12, horizon=30)
    return sigd(out, ["forecast", "sse"], 8)
