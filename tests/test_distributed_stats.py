"""Grouped least squares, exact quantiles, segmented prefix sums, exact mutual information."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.models import prep as Mp
from basketry.operators import least_squares as Q
from basketry.operators import metrics as M
from basketry.operators import windows as Wn
from basketry.operators.quantiles import exact_quantiles


def test_grouped_fit_matches_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [(g, float(a), float(b), float(2 * a - b + g + rng.normal(0, 0.1)))
            for g, n in ((1, 400), (2, 7), (3, 2)) for a, b in rng.normal(size=(n, 2))]
    rows += [(1, None, 1.0, 1.0), (1, 1.0, 1.0, None), (None, 1.0, 2.0, 3.0), (None, 2.0, 1.0, 6.0)]
    df = spark.createDataFrame(rows, "g int, a double, b double, y double").repartition(5)
    got = {r.g: r for r in Q.grouped_fit(df, [F.col("a"), F.col("b")], F.col("y"), ["g"]).collect()}
    assert set(got) == {1, 2, 3, None}
    for g in got:
        x = np.array([[1, a, b, y] for h, a, b, y in rows if h == g and a is not None and y is not None])
        want, *_ = np.linalg.lstsq(x[:, :3], x[:, 3], rcond=None)
        assert got[g].n == len(x)
        if len(x) >= 3:
            assert got[g].coefficients == pytest.approx(list(want), abs=1e-9)
        assert got[g].sse == pytest.approx(float(((x[:, 3] - x[:, :3] @ got[g].coefficients) ** 2).sum()), abs=1e-8)
    model = Q.grouped_fit(df, [F.col("a")], F.col("y"))
    line = df.where("g = 1 AND a IS NOT NULL").join(model).select(Q.fitted([F.col("a")]).alias("f"), "a").first()
    assert line.f == pytest.approx(model.first().coefficients[0] + model.first().coefficients[1] * line.a)


def test_series_forecasts_follow_each_series(spark):
    days = "date_add(date'2020-01-01', CAST(i AS INT))"
    df = spark.range(400).withColumnRenamed("id", "i").selectExpr(
        "explode(array(1, 2)) AS k", f"{days} AS ds", "i").withColumn(
        "y", F.when(F.col("k") == 1, 100 + F.col("i") / 10.0).otherwise(
            50 + 5 * F.sin(2 * math.pi * F.col("i") / 7))).drop("i")
    got = Q.seasonal_forecasts(df, ["k"], {"weekly": (7.0, 3)}, horizon=14).collect()
    assert len(got) == 2 * 414
    for r in got:
        i = (r.ds - datetime.date(2020, 1, 1)).days
        want = 100 + i / 10 if r.k == 1 else 50 + 5 * math.sin(2 * math.pi * i / 7)
        assert r.yhat == pytest.approx(want, abs=1e-6) and (r.y is None) == (i >= 400)
    one = Q.seasonal_forecasts(df.where("k = 1").drop("k"), [], {"weekly": (7.0, 3)}, horizon=14)
    assert one.columns == ["ds", "y", "yhat", "yhat_lower", "yhat_upper"]
    assert sorted(r.yhat for r in one.collect()) == pytest.approx(sorted(r.yhat for r in got if r.k == 1), abs=1e-6)


@pytest.mark.parametrize("few,bins", [(4096, 1024), (3, 4), (1, 2)])
def test_exact_quantiles(spark, few, bins):
    rng = np.random.default_rng(1)
    values = {"a": rng.normal(size=300), "b": np.repeat(7.0, 50), "c": np.array([1e-300, 1e300, -1e300, 5.0, 5.0]),
              None: rng.integers(0, 5, 90).astype(float), "one": np.array([3.5])}
    rows = [(g, float(v), 1) for g, vs in values.items() for v in vs]
    rows += [("a", None, 1), ("a", float("nan"), 1), ("empty", None, 1)]
    df = spark.createDataFrame(rows, "g string, v double, rank int").repartition(4)
    qs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = {(r.g, r.quantile): r.value for r in exact_quantiles(df, "v", qs, ["g"], few=few, bins=bins).collect()}
    assert set(got) == {(g, q) for g in values for q in qs}
    for (g, q), v in got.items():
        assert v == pytest.approx(float(np.quantile(values[g], q)), rel=1e-12)
    flat = [v for _, v, _ in rows if v is not None and not math.isnan(v)]
    assert exact_quantiles(df, "v", [0.5], few=few, bins=bins).first().value == pytest.approx(np.median(flat))
    assert exact_quantiles(df.limit(0), "v", [0.5]).count() == 0


def test_segmented_prefix_sums(spark):
    rng = np.random.default_rng(2)
    rows = [("hot", int(i), int(rng.integers(0, 9))) for i in rng.permutation(500)]
    rows += [(g, i, i) for g in ("x", None) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(3)
    out = Wn.segmented_prefix_sums(df, ["g"], ["i"], ["v"], rows=60)
    got = {(r.g, r.i): r.cum_v for r in out.collect()}
    assert len(got) == len(rows)
    for g in ("hot", "x", None):
        total = 0
        for _, i, v in sorted(r for r in rows if r[0] == g):
            assert got[g, i] == total
            total += v
    # no task sees more than a range: windows go by group and range, over counts by group alone
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "_part" in plan


def test_auc_of_several_models_in_one_pass(spark):
    rng = np.random.default_rng(3)
    rows = [(m, float(np.round(rng.normal(y * k, 1), 1)), int(y)) for m, k in (("good", 2.0), ("poor", 0.1))
            for y in rng.integers(0, 2, 200)]
    rows += [("one", 1.0, 1), ("one", 2.0, 1)]
    df = spark.createDataFrame(rows, "model string, s double, y int")
    got = {r.model: r.roc_auc for r in M.roc_auc(df, "y", "s", by=["model"]).collect()}
    assert got.pop("one") is None
    for m, auc in got.items():
        pos = [s for n, s, y in rows if n == m and y == 1]
        neg = [s for n, s, y in rows if n == m and y == 0]
        assert auc == pytest.approx(np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg]))
        assert auc == pytest.approx(M.roc_auc(df.where(F.col("model") == m), "y", "s").first().roc_auc)


def test_residual_ranks_have_no_global_window(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("y"),
                                 F.lit(1.0).alias("p"), (F.col("id") % 2).alias("g"))
    out = M.residual_table(df, "y", "p", ["k"], by=["g"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    for g in (0, 1):
        rows = sorted((r.residual, r.k, r.residual_rank, r["index"]) for r in out.where(f"g = {g}").collect())
        assert [r[2] for r in rows] == list(range(1, 151))
        assert [r[3] for r in sorted(rows, key=lambda r: r[1])] == list(range(150))


def test_mutual_information_bins_are_exact(spark):
    rows = [(float(i), float(i // 50), float(i % 2), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, coarse double, noise double, y double")
    cuts = Mp.frequency_bins(df, ["x", "coarse"], 4)
    assert cuts == {"x": [0.0, 50.0, 100.0, 150.0], "coarse": [0.0, 1.0, 2.0, 3.0]}
    got = {r.feature: r.mutual_information
           for r in Mp.mutual_information(df, ["x", "coarse", "noise"], "y", 4, 4).collect()}
    assert got["x"] == pytest.approx(math.log(4)) == got["coarse"] and got["noise"] == pytest.approx(0.0, abs=1e-12)
