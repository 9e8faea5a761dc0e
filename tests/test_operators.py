"""Hand-made fixtures with hand-worked answers (nulls, ties, single rows, gaps)."""

import datetime as dt
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.functions import calendar as C
from basketry.functions import scalar as X
from basketry.operators import aggregates as A
from basketry.operators import clean as P
from basketry.operators import joins as J
from basketry.operators import metrics as M
from basketry.operators import timeseries as TS
from basketry.operators import windows as Wn

D = dt.date


def test_confusion_matrix_fixture(spark):
    # y_true [0,1,0,1,0,1], y_pred [0,1,1,1,0,0] → TN 2, FP 1, FN 1, TP 2
    df = spark.createDataFrame(list(zip([0, 1, 0, 1, 0, 1], [0, 1, 1, 1, 0, 0])), "label int, prediction int")
    cm = {(r.label, r.prediction): r["count"] for r in M.confusion_matrix(df, "label", "prediction").collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    m = {r.metric: r.value for r in M.classification_metrics(df, "label", "prediction").collect()}
    assert m["accuracy"] == pytest.approx(4 / 6)
    assert m["precision"] == pytest.approx(2 / 3)
    assert m["recall"] == pytest.approx(2 / 3)
    assert m["specificity"] == pytest.approx(2 / 3)


def test_single_class_labels_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1)], "label int, prediction int")
    m = {r.metric: r.value for r in M.classification_metrics(df, "label", "prediction").collect()}
    assert m["recall"] == 0.0 and m["precision"] == 0.0 and m["f1"] == 0.0
    m1 = {r.metric: r.value for r in M.classification_metrics(df, "label", "prediction",
                                                                zero_division=1.0).collect()}
    assert m1["recall"] == 1.0


def _black_friday(y):
    nov1 = dt.date(y, 11, 1)
    first_thu = nov1 + dt.timedelta(days=(3 - nov1.weekday()) % 7)
    return first_thu + dt.timedelta(days=22)


def test_black_friday_every_year(spark):
    years = spark.range(1990, 2031).select(F.col("id").cast("int").alias("y"))
    got = {r.y: r.bf for r in years.select("y", C.black_friday(F.col("y")).alias("bf")).collect()}
    assert got == {y: _black_friday(y) for y in range(1990, 2031)}


def test_black_friday_flag_weekday_starts(spark):
    # Novembers starting on each weekday
    days = [D(y, 11, d) for y in (2019, 2020, 2021, 2022, 2023, 2024, 2025) for d in range(1, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d for r in df.where(C.season_flags("d")["is_black_friday"] == 1).collect()}
    assert got == {_black_friday(y) for y in (2019, 2020, 2021, 2022, 2023, 2024, 2025)}


def test_us_holidays_known_years(spark):
    years = spark.createDataFrame([(2021,), (2022,), (2024,)], "year int")
    hol = {r.holiday_date for r in C.us_holidays(years).collect()}
    for d in [D(2024, 1, 1), D(2024, 1, 15), D(2024, 2, 19), D(2024, 5, 27), D(2024, 6, 19),
              D(2024, 7, 4), D(2024, 9, 2), D(2024, 10, 14), D(2024, 11, 11), D(2024, 11, 28),
              D(2024, 12, 25)]:
        assert d in hol
    assert D(2022, 12, 26) in hol          # Christmas on Sunday, observed Monday
    assert D(2021, 12, 31) in hol          # New Year 2022 on Saturday, observed Friday before
    assert D(2021, 6, 18) in hol           # Juneteenth 2021 on Saturday
    assert D(2024, 11, 29) not in hol


def test_holiday_distance_matches_brute_force(spark):
    years = spark.createDataFrame([(2023,), (2024,)], "year int")
    hol = C.us_holidays(years)
    hdays = [r.holiday_date for r in hol.collect()]
    dates = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(0, 366, 3)]
    df = spark.createDataFrame([(d,) for d in dates], "ds date")
    got = {r.ds: r.days_to_holiday for r in J.holiday_distance(df, hol, "ds", 30).collect()}
    for d in dates:
        near = [abs((d - h).days) for h in hdays if abs((d - h).days) <= 30]
        assert got[d] == (min(near) if near else 30)


def test_group_by_drops_null_keys_and_single_row_std(spark):
    rows = [(1, 10.0, 1.0, 0.0, D(2020, 1, 1)), (1, 20.0, 2.0, 0.0, D(2020, 1, 5)),
            (2, 5.0, 1.0, 0.0, D(2020, 2, 1)), (None, 99.0, 1.0, 0.0, D(2020, 3, 1))]
    df = spark.createDataFrame(rows, "customer_id long, total_sales double, quantity double, "
                                     "discount_applied double, transaction_date date")
    out = {r.customer_id: r for r in A.customer_feature_stats(df).collect()}
    assert set(out) == {1, 2}
    assert out[2].customer_total_sales_std is None           # one-row group
    assert out[1].customer_lifetime_days == 4
    assert out[1].customer_purchase_frequency == pytest.approx(2 / 5)


def test_rolling_full_window_guard(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 10])], "t int, y double")
    out = Wn.rolling_stats(df, "y", [3], order=["t"], stats=["mean", "median", "std"])
    r = [x.rolling_mean_3 for x in out.orderBy("t").collect()]
    assert r[:2] == [None, None] and r[2:] == pytest.approx([2.0, 3.0, 17 / 3])
    med = [x.rolling_median_3 for x in out.orderBy("t").collect()]
    assert med[2:] == pytest.approx([2.0, 3.0, 4.0])
    lagged = Wn.rolling_stats(df, "y", [2], order=["t"], stats=["mean"], shift=1)
    assert [x.rolling_mean_2_lag1 for x in lagged.orderBy("t").collect()][:4] == [None, None, 1.5, 2.5]


def test_days_between_same_day_repeats(spark):
    rows = [(1, D(2020, 1, 1), 10), (1, D(2020, 1, 1), 11), (1, D(2020, 1, 4), 12),
            (1, D(2020, 1, 4), 13), (2, D(2020, 1, 2), 14), (None, D(2020, 1, 2), 15)]
    df = spark.createDataFrame(rows, "customer_id long, transaction_date date, transaction_id long")
    got = {r.transaction_id: r.days_between_purchases
           for r in Wn.days_between_purchases(df).collect()}
    assert got == {10: 0, 11: 0, 12: 3, 13: 0, 14: 0, 15: 0}


def test_text_dates_that_do_not_parse(spark):
    df = spark.createDataFrame([("01-31-2024", "12.5"), ("13-45-2024", "abc"), (None, None)],
                               "d string, x string")
    out = P.clean_types(df, double_cols=["x"], date_cols=["d"], date_format="MM-dd-yyyy").collect()
    assert out[0].d == D(2024, 1, 31) and out[0].x == 12.5
    assert out[1].d is None and out[1].x is None
    conv = P.convert_date_format(spark.createDataFrame([("1-5-2024",), ("bad",)], "d string"), ["d"])
    assert [r.d for r in conv.collect()] == ["2024-01-05", None]


def test_discount_on_zero_price(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 50.0)], "discount double, price double")
    got = [r.p for r in df.select(X.discount_percent("discount", "price").alias("p")).collect()]
    assert got == [None, 10.0]
    r = df.select(X.safe_ratio("discount", "price").alias("r")).collect()
    assert r[0].r == pytest.approx(5.0 / 1e-8)


def test_top_n_tie_at_edge(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 9.0), ("a", 3, 9.0), ("a", 4, 1.0),
                                ("b", 5, 3.0)], "g string, item int, v double")
    out = Wn.top_n_per_group(df, "g", "v", 2, tiebreak=["item"])
    assert sorted((r.g, r.item) for r in out.collect()) == [("a", 1), ("a", 2), ("b", 5)]


def test_best_per_group(spark):
    df = spark.createDataFrame([("t", "m1", 0.5), ("t", "m2", 0.7), ("u", "m1", 0.2)],
                               "task string, model string, score double")
    got = {r.task: r.model for r in Wn.best_per_group(df, "task", "score").collect()}
    assert got == {"t": "m2", "u": "m1"}
    low = {r.task: r.model for r in Wn.best_per_group(df, "task", "score", False).collect()}
    assert low == {"t": "m1", "u": "m1"}


def test_normal_quantile_accuracy(spark):
    ps = [1e-6, 0.001, 0.02, 0.02425, 0.1, 0.3, 0.5, 0.7, 0.9, 0.98, 0.999, 1 - 1e-6]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r.q for r in df.select(M.normal_quantile(F.col("p")).alias("q")).collect()]
    nd = statistics.NormalDist()
    for p, q in zip(ps, got):
        assert q == pytest.approx(nd.inv_cdf(p), rel=1e-8, abs=1e-8)


def test_prefix_sums_distributed(spark):
    rng = np.random.default_rng(0)
    vals = rng.integers(1, 100, 500)
    df = spark.createDataFrame([(float(i * 1.5), int(v)) for i, v in enumerate(vals)], "o double, v long")
    out = {r.o: r.cum_v for r in Wn.prefix_sums(df, "o", ["v"], buckets=8).collect()}
    expect = np.concatenate([[0], np.cumsum(vals)[:-1]])
    assert [out[i * 1.5] for i in range(500)] == list(expect)


def test_roc_auc_with_ties(spark):
    labels = [0, 0, 1, 1, 0, 1, 1, 0, 1, 0]
    scores = [0.1, 0.4, 0.35, 0.8, 0.4, 0.4, 0.9, 0.05, 0.35, 0.2]
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, score double")
    assert M.roc_auc(df, "label", "score").first().roc_auc == pytest.approx(brute)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]], "v double")
    got = {r.bin: r["count"] for r in A.histogram(df, "v", bins=5).collect()}
    assert got == {1: 2, 2: 2, 5: 1}


def test_daily_spine_fills_gaps(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), 1.0), (D(2020, 1, 4), 2.0)], "ds date, y double")
    grid = C.date_spine(df, "ds")
    out = grid.join(df, "ds", "left").orderBy("ds").collect()
    assert [r.ds for r in out] == [D(2020, 1, d) for d in range(1, 5)]
    assert [r.y for r in out] == [1.0, None, None, 2.0]


def test_asof_fill_by_date(spark):
    spine = spark.createDataFrame([(D(2020, 1, d),) for d in range(1, 6)], "ds date")
    vals = spark.createDataFrame([(D(2020, 1, 4), 4.0), (D(2020, 1, 2), 2.0)], "ds date, v double")
    got = [r.v for r in J.asof_fill(spine, vals, "ds", ["v"]).orderBy("ds").collect()]
    assert got == [None, 2.0, 2.0, 4.0, 4.0]


def _decompose_np(x, period, two_sided, mult):
    x = np.asarray(x, float)
    if period % 2 == 0:
        filt = np.r_[0.5, np.ones(period - 1), 0.5] / period
    else:
        filt = np.ones(period) / period
    n, m = len(x), len(filt)
    trend = np.full(n, np.nan)
    for t in range(n):
        lo = t - m // 2 if two_sided else t - (m - 1)
        if lo >= 0 and lo + m <= n:
            trend[t] = np.dot(filt, x[lo:lo + m])
    det = x / trend if mult else x - trend
    pa = np.array([np.nanmean(det[i::period]) for i in range(period)])
    pa = pa / pa.mean() if mult else pa - pa.mean()
    seas = np.tile(pa, n // period + 1)[:n]
    return trend, seas


@pytest.mark.parametrize("period,two_sided,mult", [(4, False, False), (5, True, True), (4, True, False)])
def test_decompose_matches_reference_rules(spark, period, two_sided, mult):
    rng = np.random.default_rng(1)
    x = 100 + np.arange(40) + 10 * np.sin(np.arange(40)) + rng.normal(0, 1, 40)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "t int, y double")
    out = TS.decompose(df, "y", "t", period, model="multiplicative" if mult else "additive",
                       two_sided=two_sided).orderBy("t").collect()
    trend, seas = _decompose_np(x, period, two_sided, mult)
    for r, tr, se in zip(out, trend, seas):
        if np.isnan(tr):
            assert r.trend is None
        else:
            assert r.trend == pytest.approx(tr)
        assert r.seasonal == pytest.approx(se)


def test_dickey_fuller_statistic(spark):
    rng = np.random.default_rng(2)
    y = np.cumsum(rng.normal(0, 1, 200)) * 0.2 + rng.normal(0, 1, 200)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "t int, y double")
    got = TS.dickey_fuller(df, "y", "t").first()
    x, dy = y[:-1], np.diff(y)
    X_ = np.c_[np.ones_like(x), x]
    beta, res, *_ = np.linalg.lstsq(X_, dy, rcond=None)
    sigma2 = res[0] / (len(dy) - 2)
    se = math.sqrt(sigma2 * np.linalg.inv(X_.T @ X_)[1, 1])
    assert got.adf_statistic == pytest.approx(beta[1] / se, rel=1e-6)


def test_winsorize_and_impute(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)] + [(None,), (float("nan"),)], "x double")
    w = P.winsorize(df.dropna(), ["x"], 0.05, 0.95, exact=True).agg(F.min("x"), F.max("x")).first()
    assert w[0] == pytest.approx(5.95) and w[1] == pytest.approx(95.05)
    imp = P.impute_mean(df, ["x"]).where(F.col("x").isNull() | F.isnan("x")).collect()
    assert [r.x_imputed for r in imp] == [50.5, 50.5]


def test_frequency_encoding_with_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    got = sorted((r.c, r.c_freq) for r in A.frequency_encode(df, "c").collect() if r.c)
    assert got == [("a", pytest.approx(2 / 3)), ("a", pytest.approx(2 / 3)), ("b", pytest.approx(1 / 3))]


def test_sample_rows_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r.k for r in P.sample_rows(df, 10, ["k"]).collect()]
    b = [r.k for r in P.sample_rows(df.repartition(7), 10, ["k"]).collect()]
    assert a == b and len(a) == 10


def test_quality_gate(spark):
    m = spark.createDataFrame([("m1", "r2", 0.9), ("m2", "r2", 0.5), ("m1", "mae", 3.0)],
                              "model string, metric string, value double")
    got = {(r.model, r.metric): r.passed for r in P.quality_gate(m).collect()}
    assert got == {("m1", "r2"): 1, ("m2", "r2"): 0}


def test_weather_and_labels(spark):
    df = spark.createDataFrame([(20.0, 0.0, "Random Forest"), (70.0, 0.7, "X Y")],
                               "t double, p double, name string")
    f = X.weather_flags("t", "p")
    out = df.select(f["is_rainy"].alias("r"), f["is_extreme_weather"].alias("e"),
                    X.snake_case("name").alias("s")).collect()
    assert [(r.r, r.e, r.s) for r in out] == [(0, 1, "random_forest"), (1, 0, "x_y")]
    tiers = spark.createDataFrame([(0.8,), (0.5,), (0.3,), (None,)], "p double")
    assert [r.t for r in tiers.select(P.risk_tier("p").alias("t")).collect()] == ["High", "Medium", "Low", None]
    lv = spark.createDataFrame([("Low",), ("High",), ("x",)], "v string")
    assert [r.l for r in lv.select(P.ordinal_level("v").alias("l")).collect()] == [1, 3, 0]


def test_sliding_sequences(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(6)], "t int, y double")
    out = Wn.sliding_sequences(df, "y", 3, order=["t"]).orderBy("t").collect()
    assert [(list(r.sequence), r.target) for r in out] == [([0.0, 1.0, 2.0], 3.0),
                                                           ([1.0, 2.0, 3.0], 4.0),
                                                           ([2.0, 3.0, 4.0], 5.0)]


def test_correlation_matrix_long_form(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9)], "a double, b double")
    got = {(r.column_a, r.column_b): r.correlation for r in A.correlation_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "a")] == pytest.approx(1.0)
    assert got[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])


def test_missing_source_is_clear(spark, tmp_path):
    from basketry.sources.files import SourceMissing, read_csv, read_parquet
    with pytest.raises(SourceMissing):
        read_parquet(spark, str(tmp_path / "nope.parquet"))
    with pytest.raises(SourceMissing):
        read_csv(spark, str(tmp_path / "nope.csv"))


def test_fourier_multiplicative_positive(spark):
    days = [D(2021, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    ys = [100 * math.exp(0.01 * i) * (1 + 0.1 * math.sin(2 * math.pi * i / 7)) for i in range(120)]
    df = spark.createDataFrame(list(zip(days, ys)), "ds date, y double")
    fc, fit = TS.fourier_forecast(df, horizon=5, multiplicative=True,
                                  seasonalities={"weekly": (7.0, 3)})
    rows = fc.where(F.col("y").isNull()).collect()
    assert len(rows) == 5 and all(r.yhat > 0 and r.yhat_lower < r.yhat < r.yhat_upper for r in rows)
    assert fit.first().r2 > 0.99


def test_min_max_scale_global_and_grouped(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 5.0)], "g string, x double")
    glob = sorted(r.x_scaled for r in Wn.min_max_scale(df, "x").collect())
    assert glob == [0.0, 0.5, 1.0, 1.0]
    grp = {(r.g, r.x): r.x_scaled for r in Wn.min_max_scale(df, "x", partition=["g"]).collect()}
    assert grp[("a", 1.0)] == 0.0 and grp[("a", 3.0)] == 1.0 and grp[("b", 5.0)] == 0.0


def test_approximate_quantile_paths(spark):
    df = spark.createDataFrame([(float(v), "g") for v in range(1, 1001)], "x double, g string")
    w = P.winsorize(df, ["x"], 0.01, 0.99).agg(F.min("x"), F.max("x")).first()
    assert 9 <= w[0] <= 12 and 989 <= w[1] <= 992
    b = A.box_stats(df, "g", "x").first()
    assert abs(b.median - 500) <= 2 and b.whisker_low == 1.0 and b.whisker_high == 1000.0


def test_pivot_mean(spark):
    df = spark.createDataFrame([("r1", "x", 1.0), ("r1", "y", 3.0), ("r2", "x", 5.0)],
                               "row string, col string, v double")
    piv = {r.row: (r.x, r.y) for r in A.pivot_mean(df, "row", "col", "v").collect()}
    assert piv == {"r1": (1.0, 3.0), "r2": (5.0, None)}


def test_time_split_irregular_days(spark):
    from basketry.models import prep as Mp
    rows = [(D(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in (0, 1, 5, 6, 7, 20, 21, 40, 41, 90)]
    tr, te = Mp.time_split(spark.createDataFrame(rows, "ds date, y double"), "ds", 0.8)
    assert sorted(r.y for r in tr.collect()) == [0, 1, 5, 6, 7, 20, 21, 40]
    assert sorted(r.y for r in te.collect()) == [41, 90]
