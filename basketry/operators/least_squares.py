"""Least squares for any number of groups in one job.

Each task adds up, for the groups it meets, the products of the terms (the normal equations) in NumPy
and passes on one packed row per group; a second, small grouping adds these and solves. A group
of any size travels as one row per task, so a hot group costs no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

HELD_GROUPS = 512       # groups whose sums a task holds before it passes them on


def _sums(keys: list[str], d: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}

        def out() -> pd.DataFrame:
            rows = [(*key, m.ravel().tolist()) for key, m in held.items()]
            return pd.DataFrame(rows, columns=[*keys, "_sums"])

        for frame in frames:
            parts = frame.groupby(keys, dropna=False, sort=False) if keys else [((), frame)]
            for key, part in parts:
                xy = np.stack(part["_xy"].to_numpy()).astype(float)
                key = tuple(None if pd.isna(k) else k for k in key)
                m = xy.T @ xy
                held[key] = held[key] + m if key in held else m
            if len(held) > HELD_GROUPS:
                yield out()
                held.clear()
        if held:
            yield out()
    return run


def _solve(keys: list[str], d: int, ridge: float):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        m = np.sum([np.asarray(x) for x in frame["_sums"]], axis=0).reshape(d + 1, d + 1)
        gram, right = m[:d, :d], m[:d, d]
        # terms of different size: solve with a unit diagonal
        scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
        b = np.linalg.lstsq(gram / np.outer(scale, scale) + ridge * np.eye(d), right / scale,
                            rcond=1e-13)[0] / scale
        sse = float(max(0.0, m[d, d] - 2 * b @ right + b @ gram @ b))
        return pd.DataFrame([(*key, b.tolist(), int(round(m[0, 0])), sse)],
                            columns=[*keys, "coefficients", "n", "sse"])
    return run


def grouped_fit(df: DataFrame, terms: Sequence[Column], y: Column, keys: Sequence[str] = (),
                ridge: float = 0.0) -> DataFrame:
    """(keys…, coefficients, n, sse): y on a constant and ``terms``, for each group.

    The first coefficient is the constant's. Rows with a null term or y take no part. A group with
    fewer rows than terms gets the solution of least norm. Keep terms of the order of one (centre and
    scale times), since the normal equations square their condition.
    """
    keys, d = list(keys), len(terms) + 1
    parts = [F.lit(1.0), *[t.cast("double") for t in terms], y.cast("double")]
    rows = df.select(*keys, F.array(*parts).alias("_xy")).where(~F.exists("_xy", lambda v: v.isNull()))
    key_types = [f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields]
    sums = rows.mapInPandas(_sums(keys, d), ", ".join([*key_types, "_sums array<double>"]))
    schema = ", ".join([*key_types, "coefficients array<double>", "n long", "sse double"])
    return sums.groupBy(*keys).applyInPandas(_solve(keys, d, ridge), schema)


def fitted(terms: Sequence[Column], coefficients: Column | str = "coefficients") -> Column:
    """Value of the fit for a row that holds the coefficients."""
    x = F.array(F.lit(1.0), *[t.cast("double") for t in terms])
    return F.aggregate(F.zip_with(x, coefficients, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def polynomial_terms(t: Column, low: Column, high: Column, degree: int) -> list[Column]:
    """Powers of ``t`` brought to [-1, 1]."""
    u = F.coalesce(F.try_divide(2 * t - low - high, high - low), F.lit(0.0))
    return [F.pow(u, F.lit(k)) for k in range(1, degree + 1)]


def seasonal_forecasts(series: DataFrame, keys: Sequence[str], terms: Mapping[str, tuple[float, int]],
                       ds: str = "ds", y: str = "y", horizon: int = 30, interval_z: float = 1.28
                       ) -> DataFrame:
    """Trend and Fourier seasonality of many day series in one job.

    Returns (keys…, ds, y, yhat, yhat_lower, yhat_upper) for the days of each series and ``horizon`` days
    after the last day of all; bounds are ŷ ± z·σ of the series' own residuals.
    """
    from .timeseries import fourier_terms
    keys = list(keys)
    span = series.agg(F.min(ds).alias("lo"), F.max(ds).alias("hi")).first()  # one row
    lo, hi = F.lit(span["lo"]).cast("date"), F.lit(span["hi"]).cast("date")
    t = F.datediff(F.col(ds), lo).cast("double")
    x = [F.coalesce(F.try_divide(t, F.datediff(hi, lo).cast("double")), F.lit(0.0)),
         *fourier_terms(t, terms).values()]
    if not keys:  # one series: the same with a key
        one = seasonal_forecasts(cut_lineage(series.withColumn("_series", F.lit(0))), ["_series"], terms, ds, y,
                                 horizon, interval_z)
        return one.drop("_series")
    models = grouped_fit(series, x, F.col(y), keys)
    after = models.select(*keys, F.explode(F.sequence(F.date_add(hi, 1), F.date_add(hi, horizon))).alias(ds),
                          F.lit(None).cast("double").alias(y))
    rows = series.select(*keys, ds, F.col(y).cast("double").alias(y)).unionByName(after)
    rows = rows.join(models, keys)
    sd = F.sqrt(F.col("sse") / F.col("n"))
    return rows.withColumn("yhat", fitted(x)).select(
        *keys, ds, y, "yhat", (F.col("yhat") - interval_z * sd).alias("yhat_lower"),
        (F.col("yhat") + interval_z * sd).alias("yhat_upper"))
