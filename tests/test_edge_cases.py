"""Metrics, series and tables at their edges, under ANSI mode."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.operators import aggregates as A
from basketry.operators import metrics as M
from basketry.operators import timeseries as TS
from basketry.operators import windows as Wn


def test_single_class_and_constant_target(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    one = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, s double")
    assert M.roc_auc(one, "y", "s").first().roc_auc is None
    flat = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y double, p double")
    got = {r.metric: r.value for r in M.regression_metrics(flat, "y", "p").collect()}
    assert got["r2"] is None and got["mae"] == 1.0
    same = spark.createDataFrame([(1, 2.0, 1.0), (2, 3.0, 2.0)], "t int, y double, p double")
    assert [r.std_residual_sqrt for r in M.residual_table(same, "y", "p", ["t"]).collect()] == [None, None]


def test_zero_maximum_and_error_metrics(spark):
    zero = spark.createDataFrame([(0.0,), (0.0,)], "x double")
    assert [r.x_norm for r in Wn.normalize_by_max(zero, "x").collect()] == [None, None]
    err = spark.createDataFrame([(2.0,), (8.0,)], "x double")
    assert sorted(r.x_norm for r in Wn.normalize_by_max(err, "x", True).collect()) == [0.0, 0.75]


def test_zero_trend_short_and_constant_series(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(8)]
    zero = spark.createDataFrame([(d, 0.0) for d in days], "ds date, y double")
    got = TS.decompose(zero, "y", "ds", 2, model="multiplicative").collect()
    assert all(r.resid is None for r in got)
    flat = spark.createDataFrame([("a", d, 3.0) for d in days] + [("b", days[0], 1.0), ("b", days[1], 2.0)],
                                 "k string, ds date, y double")
    got = {r.k: r for r in TS.dickey_fuller(flat, "y", "ds", ["k"]).collect()}
    assert got["a"].adf_statistic is None and got["b"].adf_statistic is None


def test_short_series_keep_their_rows(spark):
    rows = [("long", i, float(i % 3)) for i in range(9)] + [("short", i, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, ds int, y double")
    got = TS.holt_winters_additive(df, ["k"], period=3, horizon=4).collect()
    assert sorted((r.k, r.step, r.forecast is None) for r in got) == [
        ("long", i, False) for i in range(1, 5)] + [("short", i, True) for i in range(1, 5)]


def test_multiplicative_forecast_counts_days_it_cannot_fit(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    df = spark.createDataFrame([(d, 0.0 if i == 5 else 10.0 + i % 7) for i, d in enumerate(days)], "ds date, y double")
    out, fit = TS.fourier_forecast(df, multiplicative=True, horizon=3, seasonalities={"weekly": (7.0, 3)})
    row = fit.first()
    assert (row.n_days, row.n_fitted) == (60, 59)
    assert out.count() == 63 and out.where("yhat is null").count() == 0


def test_ties_go_to_the_first_name(spark):
    df = spark.createDataFrame([("t", "b", 0.5), ("t", "a", 0.5), ("t", "c", 0.5)], "g string, model string, v double")
    for larger in (True, False):
        assert Wn.best_per_group(df, "g", "v", larger, "model").first().model == "a"


def test_interval_of_any_confidence(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0)], "k int, prediction double")
    for c, z in ((0.8, 1.2815515655), (0.95, 1.9599639845), (0.99, 2.5758293035)):
        r = M.prediction_interval(df, ["k"], confidence=c).first()
        assert r.upper_bound - r.mean_prediction == pytest.approx(z)


def test_null_keys(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(1, day, 1), (None, day, 2), (2, None, 3)],
                               "customer_id int, transaction_date date, transaction_id int")
    got = {r.transaction_id: r.days_between_purchases for r in Wn.days_between_purchases(df).collect()}
    assert got == {1: 0, 2: 0, 3: 0}


def test_rfm_counts_the_date_of_rows_without_customer(spark):
    rows = [(1, dt.date(2024, 1, 1), 5.0, 1), (None, dt.date(2024, 1, 11), 7.0, 2)]
    df = spark.createDataFrame(rows, "customer_id int, transaction_date date, total_sales double, transaction_id int")
    got = A.rfm(df).collect()
    assert [(r.customer_id, r.recency) for r in got] == [(1, 10)]


def test_prefix_sums_with_buckets_by_row_count(spark, monkeypatch):
    monkeypatch.setattr(Wn, "ROWS_PER_BUCKET", 5)
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), F.lit(1).alias("one"))
    got = Wn.prefix_sums(df, "x", ["one"]).collect()
    assert all(r.cum_one == int(r.x) for r in got)


def test_shared_folder_is_needed_off_a_local_master(monkeypatch):
    from basketry import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
