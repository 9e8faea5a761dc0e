"""Evaluation queries on deterministic baseline predictions.

Forecast baselines per region-day: yesterday's value, the value a week
ago, and the mean of the previous 7 days. Churn baseline: a rule score
from purchase frequency. These make every metric exact and oracle-checked
without a trained model; the same operators score Spark ML outputs
(``basketry.models``).
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import windows as Wn
from ..operators.aggregates import pivot_mean
from ..operators.clean import quality_gate
from .q_customers import RFM_CTE, rfm_frame
from .q_time import DAILY_CTE, REGION_DAILY_CTE, daily, region_daily
from .registry import R, S, query, rounded, sigd

Z95 = NormalDist().inv_cdf(0.975)
MODELS = ("naive_lag1", "naive_lag7", "moving_avg7")

FORECAST_CTE = f"""{REGION_DAILY_CTE},
f AS (SELECT region, ds, y,
        lag(y, 1) OVER w AS naive_lag1,
        lag(y, 7) OVER w AS naive_lag7,
        CASE WHEN count(y) OVER w7 = 7 THEN avg(y) OVER w7 END AS moving_avg7
      FROM d WINDOW w AS (PARTITION BY region ORDER BY ds),
                    w7 AS (PARTITION BY region ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
e AS (SELECT * FROM f WHERE naive_lag1 IS NOT NULL AND naive_lag7 IS NOT NULL AND moving_avg7 IS NOT NULL),
p AS (SELECT region, ds, y, 'naive_lag1' AS model, naive_lag1 AS prediction FROM e
      UNION ALL SELECT region, ds, y, 'naive_lag7', naive_lag7 FROM e
      UNION ALL SELECT region, ds, y, 'moving_avg7', moving_avg7 FROM e)"""


def forecast_wide(spark, sf_dir):
    d = region_daily(spark, sf_dir)
    d = Wn.lag_features(d, "y", [1, 7], order=["ds"], partition=["region"], prefix="naive_lag")
    d = Wn.rolling_stats(d, "y", [7], order=["ds"], partition=["region"], stats=["mean"], shift=1)
    d = d.withColumnsRenamed({"naive_lag_1": "naive_lag1", "naive_lag_7": "naive_lag7",
                              "rolling_mean_7_lag1": "moving_avg7"})
    return d.dropna(subset=list(MODELS))


def forecast_long(spark, sf_dir):
    w = forecast_wide(spark, sf_dir)
    stack = ", ".join(f"'{m}', {m}" for m in MODELS)
    return w.selectExpr("region", "ds", "y", f"stack({len(MODELS)}, {stack}) AS (model, prediction)")


_REG_METRICS = {
    "mae": "avg(abs(y - prediction))",
    "mse": "avg((y - prediction) * (y - prediction))",
    "rmse": "sqrt(avg((y - prediction) * (y - prediction)))",
    "r2": "1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(y))",
    "mape": "avg(abs((y - prediction) / (y + 1e-8))) * 100",
    "max_error": "max(abs(y - prediction))",
    "mean_residual": "avg(y - prediction)",
    "std_residual": "stddev_pop(y - prediction)",
}
METRICS_SQL_CTE = FORECAST_CTE + ",\nm AS (" + "\nUNION ALL\n".join(
    f"SELECT model, '{k}' AS metric, {v} AS value FROM p GROUP BY model" for k, v in _REG_METRICS.items()) + ")"


def forecast_metrics_frame(spark, sf_dir):
    return M.regression_metrics(forecast_long(spark, sf_dir), "y", "prediction", by=["model"])


@query("forecast_metrics", f"WITH {METRICS_SQL_CTE}\nSELECT model, metric, {S('value')} AS value FROM m",
       covers=("E1", "E2", "T8"))
def q_forecast_metrics(spark, sf_dir):
    return sigd(forecast_metrics_frame(spark, sf_dir), ["value"])


@query("forecast_report_pivot", f"""WITH {METRICS_SQL_CTE}
SELECT model, {S("max(CASE WHEN metric = 'mae' THEN value END)")} AS mae,
       {S("max(CASE WHEN metric = 'rmse' THEN value END)")} AS rmse,
       {S("max(CASE WHEN metric = 'r2' THEN value END)")} AS r2
FROM m GROUP BY model""", covers=("E17", "A36"))
def q_forecast_report_pivot(spark, sf_dir):
    m = forecast_metrics_frame(spark, sf_dir)
    wide = pivot_mean(m, "model", "metric", "value", ["mae", "rmse", "r2"])
    return sigd(wide, ["mae", "rmse", "r2"])


@query("forecast_quality_gate", f"""WITH {METRICS_SQL_CTE}
SELECT model, metric, {S("value")} AS value, CAST(0.85 AS DOUBLE) AS threshold, CAST(value >= 0.85 AS INTEGER) AS passed
FROM m WHERE metric = 'r2'""", covers=("P20",))
def q_forecast_quality_gate(spark, sf_dir):
    gate = quality_gate(forecast_metrics_frame(spark, sf_dir))
    return sigd(gate, ["value"])


@query("forecast_error_gate", f"""WITH {METRICS_SQL_CTE}
SELECT model, metric, {S("value")} AS value, CAST(0.15 AS DOUBLE) AS threshold, CAST(value <= 0.15 AS INTEGER) AS passed
FROM m WHERE metric = 'rmse'""", covers=("P20",))
def q_forecast_error_gate(spark, sf_dir):
    gate = quality_gate(forecast_metrics_frame(spark, sf_dir), at_most=True)
    return sigd(gate, ["value"])


@query("model_error_normalised", f"""WITH {METRICS_SQL_CTE}
SELECT model, {S("value")} AS value, {R("1 - value / (SELECT max(value) FROM m WHERE metric = 'rmse')", 6)} AS value_norm
FROM m WHERE metric = 'rmse'""", covers=("W13",))
def q_model_error_normalised(spark, sf_dir):
    m = forecast_metrics_frame(spark, sf_dir).where("metric = 'rmse'").select("model", "value")
    out = Wn.normalize_by_max(m, "value", lower_is_better=True)
    return rounded(sigd(out, ["value"]), {"value_norm": 6})


@query("forecast_actual_predicted", f"""WITH {FORECAST_CTE}
SELECT region, ds, model, {R("y")} AS actual, {R("prediction")} AS predicted FROM p""", covers=("E31",))
def q_forecast_actual_predicted(spark, sf_dir):
    out = forecast_long(spark, sf_dir).select("region", "ds", "model", F.col("y").alias("actual"),
                                              F.col("prediction").alias("predicted"))
    return rounded(out, {"actual": 4, "predicted": 4})


@query("best_model_per_region", f"""WITH {FORECAST_CTE},
r AS (SELECT region, model, sqrt(avg((y - prediction) * (y - prediction))) AS rmse FROM p GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY rmse, model) AS rn FROM r)
SELECT region, model, {S("rmse")} AS rmse FROM b WHERE rn = 1""", covers=("W12",))
def q_best_model_per_region(spark, sf_dir):
    m = M.regression_metrics(forecast_long(spark, sf_dir), "y", "prediction",
                             by=["region", "model"], long=False).select("region", "model", "rmse")
    best = Wn.best_per_group(m, "region", "rmse", larger_is_better=False, tiebreak="model")
    return sigd(best, ["rmse"])


@query("forecast_intervals", f"""WITH {FORECAST_CTE}
SELECT region, ds, {R("avg(prediction)", 2)} AS mean_prediction, {R("stddev_pop(prediction)", 2)} AS std_prediction,
       {R(f"avg(prediction) - {Z95!r} * stddev_pop(prediction)", 2)} AS lower_bound,
       {R(f"avg(prediction) + {Z95!r} * stddev_pop(prediction)", 2)} AS upper_bound
FROM p GROUP BY region, ds""", covers=("E14",))
def q_forecast_intervals(spark, sf_dir):
    out = M.prediction_interval(forecast_long(spark, sf_dir), ["region", "ds"])
    # std-derived values: 2 decimals keep the comparison above variance-algorithm noise
    return rounded(out, {c: 2 for c in ("mean_prediction", "std_prediction", "lower_bound",
                                         "upper_bound")})


@query("blended_forecast", f"""WITH {FORECAST_CTE}
SELECT region, ds, {R("y")} AS y, {R("naive_lag1 * 0.5 + naive_lag7 * 0.3 + moving_avg7 * 0.2")} AS blended
FROM e""", covers=("L17",))
def q_blended_forecast(spark, sf_dir):
    w = forecast_wide(spark, sf_dir)
    out = M.blend(w, {"naive_lag1": 0.5, "naive_lag7": 0.3, "moving_avg7": 0.2})
    return rounded(out.select("region", "ds", "y", "blended"), {"y": 4, "blended": 4})


@query("adaptive_blend", f"""WITH {METRICS_SQL_CTE},
inv AS (SELECT model, 1.0 / (value + 1e-8) AS iw FROM m WHERE metric = 'mse'),
wt AS (SELECT model, iw / (SELECT sum(iw) FROM inv) AS weight FROM inv)
SELECT p.region, p.ds, {R("sum(wt.weight * p.prediction)")} AS blended
FROM p JOIN wt ON p.model = wt.model GROUP BY p.region, p.ds""", covers=("L18",))
def q_adaptive_blend(spark, sf_dir):
    m = M.regression_metrics(forecast_long(spark, sf_dir), "y", "prediction", by=["model"],
                             long=False)
    wts = M.adaptive_weights(m)
    out = M.blend_long(forecast_long(spark, sf_dir), wts, ["region", "ds"])
    return rounded(out, {"blended": 4})


CHURN_RULE_CTE = f"""{RFM_CTE},
s AS (SELECT customer_id, churn AS label, 1 - frequency / (SELECT max(frequency) FROM rfm) AS score FROM rfm),
pr AS (SELECT *, CASE WHEN score > 0.6 THEN 1 ELSE 0 END AS prediction FROM s),
c AS (SELECT CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
             CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
             CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
             CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn FROM pr)"""


def churn_rule(spark, sf_dir, threshold: float = 0.6):
    r = rfm_frame(spark, sf_dir)
    top = r.select(F.max("frequency")).scalar()
    s = r.select("customer_id", F.col("churn").alias("label"),
                 (1 - F.col("frequency") / top).alias("score"))
    return s.withColumn("prediction", (F.col("score") > threshold).cast("int"))


def _z(a, b):
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END"


_P1, _R1 = _z("tp", "tp + fp"), _z("tp", "tp + fn")
_P0, _R0 = _z("tn", "tn + fn"), _z("tn", "tn + fp")
_F1 = _z(f"2 * ({_P1}) * ({_R1})", f"({_P1}) + ({_R1})")
_F0 = _z(f"2 * ({_P0}) * ({_R0})", f"({_P0}) + ({_R0})")
_N = "(tp + fp + fn + tn)"
_CLS = {
    "accuracy": _z("tp + tn", _N), "precision": _P1, "recall": _R1, "f1": _F1,
    "specificity": _R0, "balanced_accuracy": f"(({_R1}) + ({_R0})) / 2",
    "weighted_precision": _z(f"({_P1}) * (tp + fn) + ({_P0}) * (tn + fp)", _N),
    "weighted_recall": _z(f"({_R1}) * (tp + fn) + ({_R0}) * (tn + fp)", _N),
    "weighted_f1": _z(f"({_F1}) * (tp + fn) + ({_F0}) * (tn + fp)", _N),
}


@query("churn_rule_metrics", f"WITH {CHURN_RULE_CTE}\n" + "\nUNION ALL\n".join(
    f"SELECT '{k}' AS metric, {S(v)} AS value FROM c" for k, v in _CLS.items()),
       covers=("E3", "E4", "E5"))
def q_churn_rule_metrics(spark, sf_dir):
    return sigd(M.classification_metrics(churn_rule(spark, sf_dir), "label", "prediction"),
                ["value"])


_TASKS = f"""WITH a AS (
SELECT * FROM (WITH {METRICS_SQL_CTE} SELECT 'forecast' AS task, model, metric, value FROM m)
UNION ALL SELECT * FROM (WITH {CHURN_RULE_CTE}
""" + "\nUNION ALL\n".join(f"SELECT 'churn' AS task, 'frequency_rule' AS model, '{k}' AS metric, {v} AS value FROM c"
                           for k, v in _CLS.items()) + """)),
k AS (SELECT task, model, row_number() OVER (PARTITION BY task ORDER BY
        coalesce(max(value) FILTER (metric = 'r2'), max(value) FILTER (metric = 'f1')) DESC NULLS LAST, model) AS place
      FROM a GROUP BY 1, 2)
"""


def all_task_metrics(spark, sf_dir):
    """Long metrics of the forecast baselines and of the churn rule."""
    f = forecast_metrics_frame(spark, sf_dir).withColumn("task", F.lit("forecast"))
    c = M.classification_metrics(churn_rule(spark, sf_dir), "label", "prediction")
    c = c.withColumns({"task": F.lit("churn"), "model": F.lit("frequency_rule")})
    return f.unionByName(c).select("task", "model", "metric", "value")


@query("all_task_report", _TASKS + f"""SELECT a.task, a.model, a.metric, {S("a.value")} AS value, CAST(k.place AS INTEGER) AS place
FROM a JOIN k ON k.task = a.task AND k.model = a.model""", covers=("E17", "T5", "T8"))
def q_all_task_report(spark, sf_dir):
    return sigd(M.sorted_report(all_task_metrics(spark, sf_dir)), ["value"])


@query("churn_rule_confusion", f"""WITH {CHURN_RULE_CTE}
SELECT 1 AS label, 1 AS prediction, CAST(tp AS BIGINT) AS count FROM c UNION ALL
SELECT 0, 1, CAST(fp AS BIGINT) FROM c UNION ALL SELECT 1, 0, CAST(fn AS BIGINT) FROM c UNION ALL
SELECT 0, 0, CAST(tn AS BIGINT) FROM c""", covers=("E7",))
def q_churn_rule_confusion(spark, sf_dir):
    return M.confusion_matrix(churn_rule(spark, sf_dir), "label", "prediction")


@query("churn_rule_auc", f"""WITH {CHURN_RULE_CTE},
rk AS (SELECT label, (rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1
                      + rank() OVER (ORDER BY score)) / 2.0 AS mid_rank FROM s),
t AS (SELECT sum(CASE WHEN label = 1 THEN mid_rank END) AS rs, CAST(sum(label) AS DOUBLE) AS np,
             CAST(count(*) - sum(label) AS DOUBLE) AS nn FROM rk)
SELECT {S("(rs - np * (np + 1) / 2) / (np * nn)")} AS roc_auc, CAST(np AS BIGINT) AS n_pos,
       CAST(nn AS BIGINT) AS n_neg FROM t""", covers=("E6",))
def q_churn_rule_auc(spark, sf_dir):
    return sigd(M.roc_auc(churn_rule(spark, sf_dir), "label", "score"), ["roc_auc"])


_QQ_P = "CASE WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n) WHEN i = n THEN pow(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END"


@query("forecast_residuals", f"""WITH {DAILY_CTE},
f AS (SELECT ds, y, CASE WHEN count(y) OVER w7 = 7 THEN avg(y) OVER w7 END AS yhat FROM d
      WINDOW w7 AS (ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
r AS (SELECT ds, y, yhat, y - yhat AS residual FROM f WHERE yhat IS NOT NULL),
q AS (SELECT *, row_number() OVER (ORDER BY ds) - 1 AS idx,
             row_number() OVER (ORDER BY residual, ds) AS i, count(*) OVER () AS n,
             stddev_pop(residual) OVER () AS sd FROM r)
SELECT ds, {R("residual")} AS residual, {R("sqrt(abs(residual / sd))", 6)} AS std_residual_sqrt,
       CAST(idx AS INTEGER) AS index, CAST(i AS INTEGER) AS residual_rank,
       {R(M.normal_quantile_sql(_QQ_P), 6)} AS theoretical_quantile
FROM q""", covers=("E15", "E31"))
def q_forecast_residuals(spark, sf_dir):
    d = daily(spark, sf_dir)
    d = Wn.rolling_stats(d, "y", [7], order=["ds"], stats=["mean"], shift=1)
    d = d.withColumnRenamed("rolling_mean_7_lag1", "yhat")
    out = M.residual_table(d, "y", "yhat", order=["ds"])
    out = out.select("ds", "residual", "std_residual_sqrt", F.col("index").cast("int"),
                     F.col("residual_rank").cast("int"), "theoretical_quantile")
    return rounded(out, {"residual": 4, "std_residual_sqrt": 6, "theoretical_quantile": 6})


_WEIGHTS = {"naive_lag1": 0.5, "naive_lag7": 0.3, "moving_avg7": 0.2}


@query("model_contributions", f"""WITH {FORECAST_CTE},
w AS (SELECT * FROM (VALUES ('naive_lag1', 0.5), ('naive_lag7', 0.3), ('moving_avg7', 0.2)) t(model, weight))
SELECT p.region, p.ds, p.model, {R("p.y")} AS y, {R("p.prediction")} AS prediction,
       CAST(w.weight AS DOUBLE) AS weight, {R("w.weight * p.prediction")} AS contribution
FROM p JOIN w ON p.model = w.model""", covers=("E16",))
def q_model_contributions(spark, sf_dir):
    long = forecast_long(spark, sf_dir)
    # the weights are one literal per model: a map lookup, no join
    wmap = F.create_map(*[x for m, w in _WEIGHTS.items() for x in (F.lit(m), F.lit(float(w)))])
    out = long.withColumn("weight", wmap[F.col("model")]).withColumn(
        "contribution", F.col("weight") * F.col("prediction"))
    return rounded(out, {"y": 4, "prediction": 4, "contribution": 4})


@query("interval_plot_points", f"""WITH {FORECAST_CTE},
iv AS (SELECT region, ds, avg(y) AS y, avg(prediction) AS m, stddev_pop(prediction) AS s FROM p GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (ORDER BY y, region, ds) AS pos FROM iv)
SELECT region, ds, {R("y")} AS y, {R("m")} AS mean_prediction, {R(f"m - {Z95!r} * s")} AS lower_bound,
       {R(f"m + {Z95!r} * s")} AS upper_bound, CAST(pos AS INTEGER) AS position
FROM o WHERE pos <= 100""", covers=("T7", "E14"))
def q_interval_plot_points(spark, sf_dir):
    long = forecast_long(spark, sf_dir)
    iv = M.prediction_interval(long, ["region", "ds"]).join(
        long.groupBy("region", "ds").agg(F.avg("y").alias("y")), ["region", "ds"])
    # the first 100 points by actual value: a top-k (per-partition limit, then merge)
    top = iv.orderBy("y", "region", "ds").limit(100)
    from pyspark.sql import Window as W
    out = top.withColumn("position", F.row_number().over(W.orderBy("y", "region", "ds")))
    out = out.select("region", "ds", "y", "mean_prediction", "lower_bound", "upper_bound",
                     F.col("position").cast("int"))
    return rounded(out, {"y": 4, "mean_prediction": 4, "lower_bound": 4, "upper_bound": 4})
