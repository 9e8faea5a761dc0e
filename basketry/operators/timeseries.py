"""Series decomposition, unit-root test and forecasts.

All operators work on day- or week-grain series with an optional series
key, so they run as many independent series in parallel. Per-series state
is bounded by the calendar span of one series, never by the row volume.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage


def _w(keys: Sequence[str]):
    return W.partitionBy(*keys) if keys else W.partitionBy()


# ---------------------------------------------------------------- W14, W15
def decompose(df: DataFrame, y: str, order: str, period: int, keys: Sequence[str] = (),
              model: str = "additive", two_sided: bool = True) -> DataFrame:
    """Classical decomposition: moving-average trend, phase-mean seasonal, residual.

    Trend filter: the mean of ``period`` values (odd period) or of
    ``period + 1`` values with half weight on both ends (even period);
    centred (two-sided) or trailing (one-sided). Seasonal: the mean of the
    detrended values at each phase (position mod period), centred on zero
    (additive) or on one (multiplicative). Residual: what remains.
    """
    keys = list(keys)
    w = _w(keys).orderBy(order)
    d = df.withColumn("_t", F.row_number().over(w) - 1)
    even = period % 2 == 0
    span = period + 1 if even else period
    if two_sided:
        lo, hi = -(span // 2), span // 2
    else:
        lo, hi = -(span - 1), 0
    frame = w.rowsBetween(lo, hi)
    s = F.sum(y).over(frame)
    if even:
        s = s - 0.5 * F.first(y).over(frame) - 0.5 * F.last(y).over(frame)
    full = F.count(y).over(frame) == span
    d = d.withColumn("trend", F.when(full, s / period))
    mult = model == "multiplicative"
    det = F.try_divide(F.col(y).cast("double"), F.col("trend")) if mult else (F.col(y) - F.col("trend"))
    d = d.withColumn("_det", det).withColumn("_phase", F.col("_t") % period)
    phase = (d.where(F.col("_det").isNotNull()).groupBy(*keys, "_phase")
               .agg(F.avg("_det").alias("_pm")))
    if keys:
        centre = phase.groupBy(*keys).agg(F.avg("_pm").alias("_c"))
        phase = phase.join(centre, keys, "inner")
    else:
        phase = phase.withColumn("_c", phase.select(F.avg("_pm")).scalar())
    phase = phase.select(*keys, "_phase",
                         (F.try_divide(F.col("_pm"), F.col("_c")) if mult else (F.col("_pm") - F.col("_c")))
                         .alias("seasonal"))
    # ≤ period rows per series: joined back on (series, phase)
    d = d.join(phase, [*keys, "_phase"], "left")
    resid = F.try_divide(F.col("_det"), F.col("seasonal")) if mult else (F.col("_det") - F.col("seasonal"))
    return d.withColumn("resid", resid).drop("_det", "_phase")


# ---------------------------------------------------------------- L14
# Dickey–Fuller critical values, regression with constant, large sample.
DF_CRITICAL = {"1%": -3.43, "5%": -2.86, "10%": -2.57}


def dickey_fuller(df: DataFrame, y: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Dickey–Fuller test without added lags, per series.

    Regression Δy_t = a + b·y_{t−1}; statistic = b / se(b) with
    se(b)² = (Syy − b²·Sxx) / (n − 2) / Sxx. Stationary at 5% when the
    statistic is below the critical value.
    """
    keys = list(keys)
    w = _w(keys).orderBy(order)
    d = df.withColumn("_x", F.lag(y, 1).over(w)).withColumn("_dy", F.col(y) - F.col("_x"))
    aggs = [F.regr_slope("_dy", "_x").alias("b"), F.regr_sxx("_dy", "_x").alias("sxx"),
            F.regr_syy("_dy", "_x").alias("syy"), F.regr_count("_dy", "_x").alias("n")]
    g = d.groupBy(*keys).agg(*aggs) if keys else d.agg(*aggs)
    # null for a constant series and for fewer than four points
    se = F.sqrt(F.greatest(F.try_divide(
        F.try_divide(F.col("syy") - F.col("b") * F.col("b") * F.col("sxx"),
                     (F.col("n") - 2).cast("double")), F.col("sxx")), F.lit(0.0)))
    return (g.withColumn("adf_statistic", F.when(F.col("n") > 2, F.try_divide("b", se)))
             .withColumn("critical_5pct", F.lit(DF_CRITICAL["5%"]))
             .withColumn("is_stationary",
                         (F.col("adf_statistic") < DF_CRITICAL["5%"]).cast("int"))
             .select(*keys, "adf_statistic", "critical_5pct", "is_stationary",
                     F.col("n").cast("long").alias("n")))


# ---------------------------------------------------------------- L12
# Seasonalities of the reference forecaster (period in days, Fourier order).
SEASONALITIES = {"yearly": (365.25, 10), "weekly": (7.0, 3), "monthly": (30.5, 5),
                 "quarterly": (91.25, 8)}


def fourier_terms(t_days, seasonalities=SEASONALITIES) -> dict:
    cols = {}
    for name, (period, order) in seasonalities.items():
        for k in range(1, order + 1):
            ang = t_days * (2 * math.pi * k / period)
            cols[f"{name}_sin{k}"] = F.sin(ang)
            cols[f"{name}_cos{k}"] = F.cos(ang)
    return cols


def fourier_forecast(daily: DataFrame, ds: str = "ds", y: str = "y", horizon: int = 30,
                     multiplicative: bool = False, seasonalities=SEASONALITIES,
                     interval_z: float = 1.28) -> tuple[DataFrame, DataFrame]:
    """Linear trend + Fourier seasonality fitted by least squares (Spark ML).

    Returns (forecast, fit_metrics): the forecast covers history and
    ``horizon`` future days (calendar spine from the last date) with
    80% bounds ŷ ± 1.28·σ_resid; ``multiplicative`` fits log y, which days without positive y
    cannot enter: they are forecast like any other day, and fit_metrics gives n_days and n_fitted.
    """
    hist = cut_lineage(daily.select(ds, y))  # day grain, written once: dates, fit and forecast read it
    start = hist.select(F.min(ds)).scalar()
    last = hist.select(F.max(ds)).scalar()
    future = daily.sparkSession.range(1).select(
        F.explode(F.sequence(F.date_add(last, 1), F.date_add(last, horizon))).alias(ds)
    ).withColumn(y, F.lit(None).cast("double"))
    allrows = hist.unionByName(future)
    t = F.datediff(F.col(ds), start).cast("double")
    feats = {"t": t, **fourier_terms(t, seasonalities)}
    allrows = allrows.withColumns(feats)
    target = F.when(F.col(y) > 0, F.log(F.col(y))) if multiplicative else F.col(y)
    allrows = allrows.withColumn("_target", target)
    va = VectorAssembler(inputCols=list(feats), outputCol="features")
    data = va.transform(allrows)
    train = data.where(F.col("_target").isNotNull())
    lr = LinearRegression(featuresCol="features", labelCol="_target", solver="normal",
                          regParam=0.0)
    model = lr.fit(train)
    pred = model.transform(data)
    sd = pred.where(F.col("_target").isNotNull()).select(
        F.stddev_pop(F.col("_target") - F.col("prediction"))).scalar()
    lo = F.col("prediction") - interval_z * sd
    hi = F.col("prediction") + interval_z * sd
    if multiplicative:
        out = pred.select(ds, y, "_target", F.exp("prediction").alias("yhat"), F.exp(lo).alias("yhat_lower"),
                          F.exp(hi).alias("yhat_upper"))
    else:
        out = pred.select(ds, y, "_target", F.col("prediction").alias("yhat"), lo.alias("yhat_lower"),
                          hi.alias("yhat_upper"))
    r = F.col(y) - F.col("yhat")
    fit = out.where(F.col(y).isNotNull()).agg(
        F.avg(F.abs(r)).alias("mae"), F.sqrt(F.avg(r * r)).alias("rmse"),
        (1 - F.try_divide(F.sum(r * r), F.var_pop(y) * F.count(y))).alias("r2"),
        F.count(F.lit(1)).alias("n_days"), F.count("_target").alias("n_fitted"))
    return out.drop("_target"), fit


# ---------------------------------------------------------------- L13
def holt_winters_additive(series: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y",
                          period: int = 12, horizon: int = 30,
                          alphas: Sequence[float] = (0.1, 0.2, 0.3, 0.5, 0.7, 0.9),
                          gammas: Sequence[float] = (0.05, 0.1, 0.2, 0.3, 0.5)) -> DataFrame:
    """Additive-seasonal exponential smoothing (no trend), many series at once.

    Each series (one row per day; bounded by the calendar span) is folded
    in time order with ``F.aggregate`` for every (α, γ) of a fixed grid;
    the pair with the smallest one-step-ahead SSE is kept and its final
    state extended ``horizon`` steps. Initial level: mean of the first
    period; initial seasonal: first-period deviations from it. A series of at most two periods
    cannot be fitted: its forecast is null.
    Output: (keys…, step, forecast, alpha, gamma, sse).
    """
    keys = list(keys)
    ser = (series.groupBy(*keys)
                 .agg(F.sort_array(F.collect_list(F.struct(F.col(ds).alias("d"),
                                                           F.col(y).alias("v")))).alias("_pts"))
                 .withColumn("_ys", F.transform("_pts", lambda p: p["v"].cast("double"))))
    short = F.size("_ys") <= 2 * period
    too_short = ser.where(short).select(*keys, F.explode(F.sequence(F.lit(1), F.lit(horizon)))
                                        .alias("step"), *[F.lit(None).cast("double").alias(c) for c in
                                                          ("forecast", "alpha", "gamma", "sse")])
    ser = ser.where(~short)
    # one row per (series, α, γ) of the fixed parameter grid
    grid = F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.lit(float(g)).alias("gamma"))
                     for a in alphas for g in gammas])
    ser = ser.withColumn("_g", F.explode(grid)).select("*", "_g.alpha", "_g.gamma").drop("_g")
    m = period
    init_level = F.aggregate(F.slice("_ys", 1, m), F.lit(0.0), lambda acc, v: acc + v) / m
    ser = ser.withColumn("_l0", init_level)
    ser = ser.withColumn("_s0", F.transform(F.slice("_ys", 1, m), lambda v: v - F.col("_l0")))
    state0 = F.struct(F.col("_l0").alias("level"), F.col("_s0").alias("season"),
                      F.lit(0).alias("i"), F.lit(0.0).alias("sse"))

    def step(st, v):
        idx = (st["i"] % m) + 1
        s_old = F.element_at(st["season"], idx)
        err = v - (st["level"] + s_old)
        level = F.col("alpha") * (v - s_old) + (1 - F.col("alpha")) * st["level"]
        s_new = F.col("gamma") * (v - level) + (1 - F.col("gamma")) * s_old
        season = F.transform(st["season"], lambda s, j: F.when(j + 1 == idx, s_new).otherwise(s))
        return F.struct(level.alias("level"), season.alias("season"), (st["i"] + 1).alias("i"),
                        (st["sse"] + err * err).alias("sse"))

    ser = ser.withColumn("_fit", F.aggregate("_ys", state0, step))
    best = (ser.groupBy(*keys) if keys else ser.groupBy())\
        .agg(F.min_by(F.struct("alpha", "gamma", "_fit"), F.col("_fit")["sse"]).alias("_b"))
    steps = F.sequence(F.lit(1), F.lit(horizon))
    out = best.select(*keys, F.col("_b.alpha").alias("alpha"), F.col("_b.gamma").alias("gamma"),
                      F.col("_b._fit").alias("_f"), F.explode(steps).alias("step"))
    idx = ((F.col("_f.i") + F.col("step") - 1) % m) + 1
    fitted = out.select(*keys, "step",
                        (F.col("_f.level") + F.element_at(F.col("_f.season"), idx)).alias("forecast"),
                        "alpha", "gamma", F.col("_f.sse").alias("sse"))
    return fitted.unionByName(too_short)
