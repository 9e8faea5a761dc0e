"""Model evaluation on a predictions table (SURVEY §2.10 E1–E7, E14, E15;
§2.9 L17, L18).

Predictions are a DataFrame with a label / target column and one or more
prediction columns (wide) or ``(row key…, model, prediction)`` rows (long).
Every metric is one grouped aggregation over the predictions (a partial
aggregation per model), so nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .windows import broadcast_if_small, group_places, prefix_sums, segmented_prefix_sums


def _long(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Stack one-row-per-key metric columns into (keys…, metric, value)."""
    stack = ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names)
    return df.selectExpr(*[f"`{k}`" for k in keys],
                         f"stack({len(names)}, {stack}) AS (metric, value)")


# ---------------------------------------------------------------- E1, E2
REGRESSION_METRICS = ("mae", "mse", "rmse", "r2", "mape", "max_error", "mean_residual",
                      "std_residual")


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (),
                       eps: float = 1e-8, long: bool = True) -> DataFrame:
    """MAE, MSE, RMSE, R², MAPE (ε-guarded, in %), max |error|, mean and
    population std of the residual — per group ``by``. R² of a constant target is null."""
    r = F.col(y) - F.col(yhat)
    aggs = [
        F.avg(F.abs(r)).alias("mae"),
        F.avg(r * r).alias("mse"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        (1 - F.try_divide(F.sum(r * r), F.var_pop(y) * F.count(y))).alias("r2"),
        (F.avg(F.abs(F.try_divide(r, F.col(y) + eps))) * 100).alias("mape"),
        F.max(F.abs(r)).alias("max_error"),
        F.avg(r).alias("mean_residual"),
        F.stddev_pop(r).alias("std_residual"),
    ]
    d = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    out = d.groupBy(*by).agg(*aggs) if by else d.agg(*aggs)
    return _long(out, list(by), REGRESSION_METRICS) if long else out


# ---------------------------------------------------------------- E3, E4, E5, E7
def confusion_counts(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn per group in one pass."""
    lab, prd = F.col(label), F.col(pred)
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    aggs = [cnt((lab == 1) & (prd == 1)).alias("tp"), cnt((lab == 0) & (prd == 1)).alias("fp"),
            cnt((lab == 1) & (prd == 0)).alias("fn"), cnt((lab == 0) & (prd == 0)).alias("tn")]
    d = df.where(lab.isNotNull() & prd.isNotNull())
    return d.groupBy(*by).agg(*aggs) if by else d.agg(*aggs)


def _div(a: Column, b: Column, zero_division: float) -> Column:
    return F.when(b == 0, F.lit(float(zero_division))).otherwise(a / b)


CLASSIFICATION_METRICS = ("accuracy", "precision", "recall", "f1", "specificity",
                          "balanced_accuracy", "weighted_precision", "weighted_recall",
                          "weighted_f1")


def classification_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = (),
                           zero_division: float = 0.0, long: bool = True) -> DataFrame:
    """Binary metrics from the four counts (``zero_division`` for empty ratios).

    Weighted precision / recall / F1 average the per-class values by class
    support, as scikit-learn's ``average='weighted'``.
    """
    c = confusion_counts(df, label, pred, by)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    z = zero_division

    def f1(p, r):
        return _div(2 * p * r, p + r, z)

    p1, r1 = _div(tp, tp + fp, z), _div(tp, tp + fn, z)
    p0, r0 = _div(tn, tn + fn, z), _div(tn, tn + fp, z)
    s1, s0 = tp + fn, tn + fp
    out = c.select(
        *by,
        (_div(tp + tn, n, z)).alias("accuracy"),
        p1.alias("precision"), r1.alias("recall"), f1(p1, r1).alias("f1"),
        _div(tn, tn + fp, 0.0).alias("specificity"),
        ((_div(tp, tp + fn, 0.0) + _div(tn, tn + fp, 0.0)) / 2).alias("balanced_accuracy"),
        _div(p1 * s1 + p0 * s0, n, z).alias("weighted_precision"),
        _div(r1 * s1 + r0 * s0, n, z).alias("weighted_recall"),
        _div(f1(p1, r1) * s1 + f1(p0, r0) * s0, n, z).alias("weighted_f1"))
    return _long(out, list(by), CLASSIFICATION_METRICS) if long else out


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(label, prediction, count) — every cell of the 2×2 grid, zeros included."""
    c = confusion_counts(df, label, pred)
    return c.selectExpr("stack(4, 1, 1, tp, 0, 1, fp, 1, 0, fn, 0, 0, tn) "
                        "AS (label, prediction, count)")


# ---------------------------------------------------------------- E6
def roc_auc(df: DataFrame, label: str, score: str, by_buckets: int | None = None,
            by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC (ties count one half) from the rank-sum statistic, per group of ``by``.

    Rows collapse to distinct scores with positive / negative counts (a
    partial aggregation), the count of rows below each score is a
    distributed prefix sum over score ranges, and the rank sum is
    one more aggregation — no global sort of the rows. All groups (models) go in one pass.
    Null for a single class.
    """
    by = list(by)
    d = (df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
           .groupBy(*by, F.col(score).alias("_s")).agg(
               F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("_pos"),
               F.count(F.lit(1)).alias("_all")))
    d = (prefix_sums(d, "_s", ["_all"], buckets=by_buckets, prefix="below") if by_buckets and not by
         else segmented_prefix_sums(d, by, ["_s"], ["_all"], prefix="below"))
    mid_rank = F.col("below__all") + (F.col("_all") + 1) / 2.0
    tot = d.groupBy(*by).agg(F.sum(F.col("_pos") * mid_rank).alias("rank_sum"),
                             F.sum("_pos").alias("n_pos"), F.sum("_all").alias("n_all"))
    npos, nneg = F.col("n_pos").cast("double"), (F.col("n_all") - F.col("n_pos")).cast("double")
    return tot.select(
        *by, F.try_divide(F.col("rank_sum") - npos * (npos + 1) / 2, npos * nneg).alias("roc_auc"),
        F.col("n_pos").cast("long").alias("n_pos"), (F.col("n_all") - F.col("n_pos")).cast("long")
        .alias("n_neg"))


# ---------------------------------------------------------------- E17, T5
def sorted_report(metrics: DataFrame, primary: Sequence[str] = ("r2", "f1")) -> DataFrame:
    """Long metrics (task, model, metric, value) with each model's place in its task.

    The primary metric of a task is the first of ``primary`` that it has; place 1 is the
    largest, ties by model name. One row per task and model is ranked.
    """
    wide = metrics.groupBy("task", "model").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("_m"))
    score = F.coalesce(*[F.try_element_at("_m", F.lit(p)) for p in primary])
    wide = wide.withColumn("_score", score).withColumn(
        "place", F.row_number().over(W.partitionBy("task").orderBy(F.desc_nulls_last("_score"), "model")))
    return metrics.join(wide.select("task", "model", "place"), ["task", "model"])


# ---------------------------------------------------------------- E14
def prediction_interval(long_preds: DataFrame, keys: Sequence[str], pred: str = "prediction",
                        confidence: float = 0.95) -> DataFrame:
    """Mean ± z·σ across models per row (σ = population std).

    z is the normal quantile of (1 + confidence) / 2.
    """
    z = NormalDist().inv_cdf((1 + confidence) / 2)
    g = long_preds.where(F.col(pred).isNotNull()).groupBy(*keys).agg(
        F.avg(pred).alias("mean_prediction"), F.stddev_pop(pred).alias("std_prediction"))
    return (g.withColumn("lower_bound", F.col("mean_prediction") - z * F.col("std_prediction"))
             .withColumn("upper_bound", F.col("mean_prediction") + z * F.col("std_prediction")))


# ---------------------------------------------------------------- E15
# Coefficients of P. J. Acklam's rational approximation of the
# standard normal quantile function (relative error below 1.2e-9).
ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00)
ACKLAM_P_LOW = 0.02425


def _horner(coeffs, x):
    acc = F.lit(coeffs[0])
    for c in coeffs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def normal_quantile(p: Column) -> Column:
    """Standard normal inverse CDF as a column expression (no UDF)."""
    q_lo = F.sqrt(-2 * F.log(p))
    q_hi = F.sqrt(-2 * F.log(1 - p))
    qc = p - 0.5
    r = qc * qc
    low = _horner(ACKLAM_C, q_lo) / (_horner(ACKLAM_D, q_lo) * q_lo + 1)
    high = -_horner(ACKLAM_C, q_hi) / (_horner(ACKLAM_D, q_hi) * q_hi + 1)
    mid = _horner(ACKLAM_A, r) * qc / (_horner(ACKLAM_B, r) * r + 1)
    return (F.when(p < ACKLAM_P_LOW, low).when(p > 1 - ACKLAM_P_LOW, high).otherwise(mid))


def normal_quantile_sql(p: str) -> str:
    """The same approximation as SQL text (for oracles)."""
    def horner(coeffs, x):
        acc = repr(coeffs[0])
        for c in coeffs[1:]:
            acc = f"(({acc}) * ({x}) + {c!r})"
        return acc
    q_lo, q_hi = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - ({p})))"
    qc = f"(({p}) - 0.5)"
    r = f"({qc} * {qc})"
    low = f"({horner(ACKLAM_C, q_lo)}) / (({horner(ACKLAM_D, q_lo)}) * {q_lo} + 1)"
    high = f"-({horner(ACKLAM_C, q_hi)}) / (({horner(ACKLAM_D, q_hi)}) * {q_hi} + 1)"
    mid = f"({horner(ACKLAM_A, r)}) * {qc} / (({horner(ACKLAM_B, r)}) * {r} + 1)"
    return (f"CASE WHEN ({p}) < {ACKLAM_P_LOW} THEN {low} WHEN ({p}) > {1 - ACKLAM_P_LOW!r} "
            f"THEN {high} ELSE {mid} END")


def residual_table(df: DataFrame, y: str, yhat: str, order: Sequence[str],
                   by: Sequence[str] = (), size: int | None = None) -> DataFrame:
    """Residual, √|standardised residual|, time index, and normal Q-Q points, per group of ``by``.

    Q-Q: the i-th smallest residual against the normal quantile of the
    Filliben order-statistic median (1 − 0.5^(1/n) at i=1, 0.5^(1/n) at
    i=n, (i − 0.3175)/(n + 0.365) between). Both ranks are places in ranges of rows, which travel once for
    each and are written once, so rows of any grain and number will do; ``order`` must be unique within
    a group. ``size`` is the number of rows, counted if not given.
    """
    by = list(by)
    d = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull()).withColumn("residual", F.col(y) - F.col(yhat))
    d = group_places(d, by, {"_at": order, "_rank": ["residual", *order]}, size=size)
    stats = d.groupBy(*by).agg(F.stddev_pop("residual").alias("_sd"), F.count(F.lit(1)).alias("_n"))
    if by:
        stats = stats.select(*[F.col(c).alias(f"_g_{c}") for c in by], "_sd", "_n")
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
        d = d.join(broadcast_if_small(stats), same).drop(*[f"_g_{c}" for c in by])
    else:
        d = d.withColumns({"_sd": stats.select("_sd").scalar(), "_n": stats.select("_n").scalar()})
    d = d.withColumns({
        "std_residual_sqrt": F.sqrt(F.abs(F.try_divide(F.col("residual"), F.col("_sd")))),
        "index": F.col("_at").cast("int"), "residual_rank": (F.col("_rank") + 1).cast("int")})
    i, n = F.col("residual_rank"), F.col("_n")
    mn = F.pow(F.lit(0.5), 1.0 / n)
    m = (F.when(i == 1, 1 - mn).when(i == n, mn).otherwise((i - 0.3175) / (n + 0.365)))
    return d.withColumn("theoretical_quantile", normal_quantile(m)).drop(
        "_at", "_rank", "_sd", "_n")


# ---------------------------------------------------------------- L17, L18
def blend(wide: DataFrame, weights: Mapping[str, float], out: str = "blended") -> DataFrame:
    """Weighted sum of prediction columns (weights normalised to sum 1)."""
    total = float(sum(weights.values()))
    expr = None
    for c, w in weights.items():
        term = F.col(c) * (w / total)
        expr = term if expr is None else expr + term
    return wide.withColumn(out, expr)


def adaptive_weights(metrics: DataFrame, model: str = "model", mse: str = "mse",
                     eps: float = 1e-8) -> DataFrame:
    """Weights ∝ 1 / (MSE + ε), normalised to sum 1 (one row per model)."""
    inv = metrics.select(model, (1.0 / (F.col(mse) + eps)).alias("_inv"))
    total = inv.select(F.sum("_inv")).scalar()
    return inv.select(model, (F.col("_inv") / total).alias("weight"))


def blend_long(long_preds: DataFrame, weights: DataFrame, keys: Sequence[str],
               model: str = "model", pred: str = "prediction") -> DataFrame:
    """Σ weight·prediction per row from long predictions and a weights table.

    The weights table has one row per model (bounded), so it is broadcast.
    """
    j = long_preds.join(F.broadcast(weights), model, "inner")
    return j.groupBy(*keys).agg(F.sum(F.col("weight") * F.col(pred)).alias("blended"))
