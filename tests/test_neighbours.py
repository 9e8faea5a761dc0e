"""Exact neighbours: the result against brute force, and how little of the block pairs is read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.models.neighbours import box_distances, exact_knn, kd_cuts


def brute(ref, tie, q, k, skip=None):
    both = ~np.isnan(ref) & ~np.isnan(q)
    gap = np.where(both, ref - q, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(both.any(1), np.sqrt((gap ** 2).sum(1) * (len(q) / both.sum(1))), np.inf)
    if skip is not None:
        d[skip] = np.inf
    order = [i for i in np.lexsort((np.arange(len(ref)), tie, d)) if np.isfinite(d[i])]
    return order[:k], d


@pytest.mark.parametrize("rows", [8, 64, 1024])
def test_matches_brute_force_with_gaps_and_copies(spark, rows):
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(400, 3)).round(1)
    x[:130] = [0.5, 0.5, 0.5]           # a third of all rows at one point
    x[rng.random(x.shape) < 0.15] = np.nan
    tie = rng.integers(0, 50, 400)
    shape = "_rid long, _tie long, a double, b double, c double, _val double"
    df = spark.createDataFrame([(i, int(tie[i]), *[None if np.isnan(v) else float(v) for v in r], float(i))
                                for i, r in enumerate(x)], shape)
    got = {}
    for r in exact_knn(df, df, ["a", "b", "c"], k=4, exclude_same=True, rows=rows).collect():
        got.setdefault(r.q_rid, {})[r["rank"]] = r
    for i in range(400):
        want, d = brute(x, tie, x[i], 4, skip=i)
        assert [got[i][n + 1].r_rid for n in range(len(want))] == want if want else i not in got
        assert all(got[i][n + 1].distance == pytest.approx(d[j]) for n, j in enumerate(want))


def test_few_block_pairs_are_read(spark):
    orders = spark.read.parquet("/root/testdata/sf0.1/orders.parquet")
    day = F.datediff("o_orderdate", F.lit("1992-01-01")) / 100.0
    df = orders.select(F.col("o_orderkey").cast("long").alias("_rid"), F.col("o_orderkey").cast("long").alias("_tie"),
                       (F.col("o_totalprice").cast("double") / 1e4).alias("price"), day.alias("day"),
                       F.lit(0.0).alias("_val")).dropna()
    stats = {}
    queries = df.where("_rid % 20 = 0")
    got = exact_knn(df, queries, ["price", "day"], k=5, exclude_same=True, stats=stats)
    assert 0 < stats["pairs_read"] < 0.1 * stats["pairs"]
    rows = df.orderBy("_rid").toPandas()
    x, ids = rows[["price", "day"]].to_numpy(), rows["_rid"].to_numpy()
    some = got.where("q_rid % 2000 = 0").toPandas()
    assert some["q_rid"].nunique() >= 10
    for q, part in some.groupby("q_rid"):
        at = int(np.searchsorted(ids, q))
        want, _ = brute(x, ids, x[at], 5, skip=at)
        assert list(part.sort_values("rank")["r_rid"]) == list(ids[want])


def test_boxes_and_cuts():
    lo, hi = np.array([0.0, np.nan]), np.array([1.0, np.nan])
    los, his = np.array([[3.0, 1.0], [0.5, 1.0], [np.nan, 1.0]]), np.array([[4.0, 2.0], [2.0, 2.0], [np.nan, 2.0]])
    assert box_distances(lo, hi, los, his) == pytest.approx([2.0 * np.sqrt(2), 0.0, np.inf])
    axis, value = kd_cuts(np.array([[0.0, 5.0], [10.0, 5.0], [20.0, 6.0], [30.0, 6.0]]), 4)
    assert axis[0] == 0 and value[0] == 15.0 and len(axis) == 3


def test_nothing_to_find(spark):
    df = spark.createDataFrame([(1, 1, 2.0, 0.0)], "_rid long, _tie long, a double, _val double")
    assert exact_knn(df.limit(0), df, ["a"]).count() == 0
    assert exact_knn(df, df.limit(0), ["a"]).count() == 0
    assert exact_knn(df, df, ["a"], exclude_same=True).count() == 0
