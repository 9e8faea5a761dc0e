"""Invariants for model-backed operators (no exact oracle exists for these)."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from basketry.models import prep as Mp
from basketry.models.neighbours import exact_knn
from basketry.models.resample import knn_impute, smote
from basketry.plans import jobs as J
from basketry.streaming.channel_stream import run_to_files
from basketry.operators import aggregates as A
from basketry.operators import metrics as M


def test_exact_knn_matches_numpy(spark):
    rng = np.random.default_rng(3)
    ref = rng.normal(size=(300, 3))
    qs = rng.normal(size=(20, 3))
    qs[0, 1] = np.nan
    shape = "_rid long, a double, b double, c double, _tie long, _val double"
    rdf = spark.createDataFrame([(i, *map(float, r), i, 0.0) for i, r in enumerate(ref)], shape)
    qdf = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r], i, None)
                                 for i, r in enumerate(qs)], shape)
    got = exact_knn(rdf, qdf, ["a", "b", "c"], k=4, rows=16).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r.q_rid, []).append((r["rank"], r.r_rid))
    for i, q in enumerate(qs):
        present = ~np.isnan(q)
        d = np.sqrt(3 / present.sum() * ((ref[:, present] - q[present]) ** 2).sum(axis=1))
        want = list(np.argsort(d, kind="stable")[:4])
        assert [rid for _, rid in sorted(by_q[i])] == want


def test_knn_impute_fills_only_missing(spark):
    rows = [(i, float(i), float(2 * i) if i % 10 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, a double, b double")
    out = {r.k: r for r in knn_impute(df, ["a", "b"], key=["k"], k=2).collect()}
    assert len(out) == 50
    assert out[11].b == 22.0                       # untouched
    assert out[10].b == pytest.approx((18.0 + 22.0) / 2)   # neighbours 9 and 11


def test_exact_distances_far_from_zero_and_ties(spark):
    shape = "_rid long, a double, _tie long, _val double"
    far = spark.createDataFrame([(i, 1e8 + i / 10, 9 - i, float(i)) for i in range(4)], shape)
    got = exact_knn(far, far, ["a"], k=3, exclude_same=True).where("q_rid = 0").orderBy("rank").collect()
    assert [r.distance for r in got] == pytest.approx([0.1, 0.2, 0.3], abs=1e-6)
    same = spark.createDataFrame([(i, 1.0, (7 * i) % 10, float(i)) for i in range(10)], shape)
    got = exact_knn(same, same.where("_rid = 0"), ["a"], k=3).orderBy("rank").collect()
    assert [r.r_rid for r in got] == [0, 3, 6]  # by tie-break number


def test_knn_impute_donors_per_column(spark):
    rows = [(1, 1.0, None, 5.0), (2, 1.1, 2.0, None), (3, 9.0, 9.0, 9.0), (4, None, None, None),
            (5, 8.0, 9.5, 7.0)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double")
    out = {r.k: r for r in knn_impute(df, ["a", "b", "c"], key=["k"], k=1).collect()}
    assert out[1].b == 2.0          # row 2 has b and is nearest, though it lacks c
    assert out[2].c == 5.0
    assert out[4].a == pytest.approx((1.0 + 1.1 + 9.0 + 8.0) / 4)  # nothing to compare: means
    assert out[4].b == pytest.approx((2.0 + 9.0 + 9.5) / 3) and out[4].c == pytest.approx(7.0)


def test_smote_many_classes(spark):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType
    sizes = {0.0: 40, 1.0: 14, 2.0: 6, 3.0: 1}
    rows = [(int(100 * y) + i, y, Vectors.dense([float(i), y])) for y, n in sizes.items() for i in range(n)]
    schema = StructType([StructField("k", LongType()), StructField("y", DoubleType()),
                         StructField("features", VectorUDT())])
    bal = smote(spark.createDataFrame(rows, schema), "y", key="k", k=3).cache()
    assert {r.y: r["count"] for r in bal.groupBy("y").count().collect()} == dict.fromkeys(sizes, 40)
    assert bal.select("k").distinct().count() == 160
    assert all(r.features[1] == pytest.approx(r.y) for r in bal.collect())


def test_smote_balances_and_interpolates(spark):
    rows = [(i, 0.0, Vectors.dense([float(i), 0.0])) for i in range(40)]
    rows += [(100 + i, 1.0, Vectors.dense([float(i), 1.0])) for i in range(8)]
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType
    schema = StructType([StructField("k", LongType()), StructField("y", DoubleType()),
                         StructField("features", VectorUDT())])
    df = spark.createDataFrame(rows, schema)
    bal = smote(df, "y", key="k", k=3)
    counts = {r.y: r["count"] for r in bal.groupBy("y").count().collect()}
    assert counts == {0.0: 40, 1.0: 40}
    syn = bal.where(F.col("k") < 0).collect()
    assert len(syn) == 32
    for r in syn:                                   # on segments between minority points
        assert r.features[1] == pytest.approx(1.0)
        assert 0.0 <= r.features[0] <= 7.0


def test_splits_are_stable_and_disjoint(spark):
    df = spark.range(2000).withColumnRenamed("id", "k").withColumn("y", (F.col("k") % 3 == 0).cast("int"))
    tr, te = Mp.stratified_split(df, ["k"], "y")
    a, b = tr.count(), te.count()
    assert a + b == 2000 and 0.15 < b / 2000 < 0.25
    assert tr.join(te, "k").count() == 0
    tr2, _ = Mp.stratified_split(df.repartition(5), ["k"], "y")
    assert tr2.count() == a
    folds = df.select(Mp.fold_column(["k"], 5).alias("f")).groupBy("f").count().collect()
    assert sorted(r.f for r in folds) == [0, 1, 2, 3, 4]


def test_time_split_day_series(spark):
    df = spark.createDataFrame([(F_date(i), float(i)) for i in range(11)], "ds date, y double")
    tr, te = Mp.time_split(df, "ds", 0.8)
    assert tr.count() == 8 and te.count() == 3


def F_date(i):
    import datetime as dt
    return dt.date(2020, 1, 1) + dt.timedelta(days=i)


def test_forecast_and_churn_jobs(spark, sf_small):
    fm = J.forecast_job(spark, sf_small, models=("linear_regression",))
    rows = {(r.model, r.metric): r.value for r in fm.collect()}
    for model in ("linear_regression", "mean_baseline"):
        for metric in M.REGRESSION_METRICS:
            assert np.isfinite(rows[(model, metric)])
        assert rows[(model, "rmse")] >= rows[(model, "mae")] >= 0
        assert rows[(model, "r2")] <= 1.0
    cm = J.churn_job(spark, sf_small, models=("logistic_regression",))
    vals = {r.metric: r.value for r in cm.collect()}
    for k in ("accuracy", "precision", "recall", "f1", "roc_auc"):
        assert 0.0 <= vals[k] <= 1.0


def test_scoring_probabilities_and_tiers(spark, sf_small):
    s = J.scoring_job(spark, sf_small)
    agg = s.agg(F.min("churn_probability"), F.max("churn_probability"), F.count("*")).first()
    assert 0.0 <= agg[0] <= agg[1] <= 1.0 and agg[2] > 0
    assert {r.risk_tier for r in s.select("risk_tier").distinct().collect()} <= {"Low", "Medium", "High"}


def test_adaptive_weights_sum_to_one(spark):
    m = spark.createDataFrame([("a", 1.0), ("b", 4.0)], "model string, mse double")
    w = {r.model: r.weight for r in M.adaptive_weights(m).collect()}
    assert sum(w.values()) == pytest.approx(1.0) and w["a"] == pytest.approx(0.8)


def test_holt_winters_horizon(spark, sf_small):
    from basketry.operators import timeseries as TS
    from basketry.sources.tables import transactions
    d = A.daily_sales(transactions(spark, sf_small, ["transaction_date", "total_sales"]))
    d = d.withColumn("series", F.lit("all"))
    out = TS.holt_winters_additive(d, ["series"], horizon=10).collect()
    assert [r.step for r in out] == list(range(1, 11))
    assert all(np.isfinite(r.forecast) for r in out)


def test_streaming_equals_batch(spark, sf_small, tmp_path):
    t = run_to_files(spark, sf_small, str(tmp_path / "ck"), str(tmp_path / "out"), glob="events.parquet")
    written = spark.read.parquet(str(tmp_path / "out"))
    assert 0 < written.count() < t.count()  # the last windows are still open
    s = {(r.w.start, r.event_type): (round(r.sales, 6), r.events) for r in t.collect()}
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    b = ev.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(
        F.sum("value").alias("sales"), F.count("*").alias("events"))
    bb = {(r.w.start, r.event_type): (round(r.sales, 6), r.events) for r in b.collect()}
    assert s == bb


def _hw_python(ys, m, alpha, gamma):
    level = sum(ys[:m]) / m
    season = [v - level for v in ys[:m]]
    sse = 0.0
    for i, v in enumerate(ys):
        s_old = season[i % m]
        err = v - (level + s_old)
        sse += err * err
        level = alpha * (v - s_old) + (1 - alpha) * level
        season[i % m] = gamma * (v - level) + (1 - gamma) * s_old
    return level, season, sse, len(ys)


def test_holt_winters_fold_matches_python(spark):
    import datetime as dt
    rng = np.random.default_rng(5)
    ys = [10 + 3 * np.sin(2 * np.pi * i / 12) + rng.normal(0, 0.3) for i in range(60)]
    df = spark.createDataFrame([("s", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(v))
                                for i, v in enumerate(ys)], "series string, ds date, y double")
    from basketry.operators import timeseries as TS
    out = TS.holt_winters_additive(df, ["series"], period=12, horizon=5,
                                   alphas=(0.2, 0.5), gammas=(0.1, 0.3)).orderBy("step").collect()
    best = min((_hw_python(ys, 12, a, g) + (a, g) for a in (0.2, 0.5) for g in (0.1, 0.3)),
               key=lambda t: t[2])
    level, season, sse, n, a, g = best
    assert out[0].alpha == a and out[0].gamma == g and out[0].sse == pytest.approx(sse)
    for r in out:
        assert r.forecast == pytest.approx(level + season[(n + r.step - 1) % 12])


def test_fourier_forecast_recovers_signal(spark):
    import datetime as dt
    from basketry.operators import timeseries as TS
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(400)]
    ys = [50 + 0.1 * i + 5 * np.sin(2 * np.pi * i / 7) for i in range(400)]
    df = spark.createDataFrame(list(zip(days, map(float, ys))), "ds date, y double")
    fc, fit = TS.fourier_forecast(df, horizon=7, seasonalities={"weekly": (7.0, 3)})
    assert fit.first().r2 == pytest.approx(1.0, abs=1e-9)
    fut = fc.where(F.col("y").isNull()).orderBy("ds").collect()
    assert len(fut) == 7
    for j, r in enumerate(fut):
        i = 400 + j
        assert r.yhat == pytest.approx(50 + 0.1 * i + 5 * np.sin(2 * np.pi * i / 7), abs=1e-6)


def test_mutual_information_matches_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 4, 2000)
    y = (x + rng.integers(0, 2, 2000)) % 4
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(x, y)], "x int, y int")
    got = Mp.mutual_information(df, ["x"], "y", bins=8, label_bins=None).first().mutual_information
    joint = np.zeros((4, 4))
    for a, b in zip(x, y):
        joint[a, b] += 1
    p = joint / joint.sum()
    px, py = p.sum(1, keepdims=True), p.sum(0, keepdims=True)
    nz = p > 0
    assert got == pytest.approx(float((p[nz] * np.log(p[nz] / (px @ py)[nz])).sum()))


def test_qq_points_follow_filliben_medians(spark):
    import statistics
    vals = [3.0, -1.0, 2.5, 0.0, 7.0, -4.0, 1.0]
    df = spark.createDataFrame([(i, v, 0.0) for i, v in enumerate(vals)], "t int, y double, yhat double")
    out = sorted(M.residual_table(df, "y", "yhat", ["t"]).collect(), key=lambda r: r.residual_rank)
    n = len(vals)
    m = [1 - 0.5 ** (1 / n)] + [(i - 0.3175) / (n + 0.365) for i in range(2, n)] + [0.5 ** (1 / n)]
    nd = statistics.NormalDist()
    assert [r.residual for r in out] == sorted(vals)
    for r, p in zip(out, m):
        assert r.theoretical_quantile == pytest.approx(nd.inv_cdf(p), rel=1e-8)


def test_frequency_encoding_gate(spark):
    rows = [(i % 60, i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, "many int, few int")
    out = A.frequency_encode_wide(df, ["many", "few"], min_distinct=50)
    assert dict(out.dtypes)["many"] == "double" and dict(out.dtypes)["few"] == "int"
    assert out.select(F.sum("many")).first()[0] == pytest.approx(600 * (10 / 600))


def test_smote_exact_count_with_remainder(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType
    rows = [(i, 0.0, Vectors.dense([float(i), 0.0])) for i in range(37)]
    rows += [(100 + i, 1.0, Vectors.dense([float(i), 2.0])) for i in range(7)]
    schema = StructType([StructField("k", LongType()), StructField("y", DoubleType()),
                         StructField("features", VectorUDT())])
    bal = smote(spark.createDataFrame(rows, schema), "y", key="k", k=3)
    counts = {r.y: r["count"] for r in bal.groupBy("y").count().collect()}
    assert counts == {0.0: 37, 1.0: 37}          # 30 synthetic = 4 per row + 2 extra
    assert bal.where(F.col("k") < 0).select("k").distinct().count() == 30
