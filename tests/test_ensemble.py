import duckdb
import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from basketry.models import ensemble as E

KEY = ["id", "day"]
FOLDS = 3


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 2))
    y = 3 * x[:, 0] - x[:, 1] ** 2 + rng.normal(scale=0.2, size=120) + 10
    data = [(i, f"d{i % 7}", float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    data.append((500, "d0", 1.0, 1.0, None))    # no label: not a row
    df = spark.createDataFrame(data, "id long, day string, a double, b double, y double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df)
    return E.ensemble_rows(df, "f", "y", KEY, FOLDS, F.col("id") >= 100)


def models():
    return {"linear": LinearRegression(), "forest": RandomForestRegressor(numTrees=5, maxDepth=3, seed=1)}


@pytest.fixture(scope="module")
def table(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ensemble"))
    return E.prediction_table(rows, KEY, models(), FOLDS, path), path


def _fit(x, y):
    return np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)[0]


def _apply(w, x):
    return np.column_stack([x, np.ones(len(x))]) @ w


def test_predictions_of_unseen_folds(rows, table):
    r = rows.toPandas()
    x, y, fold = np.array([v.toArray() for v in r["features"]]), r["label"].to_numpy(), r["fold"].to_numpy()
    assert len(r) == 120 and (fold == E.HOLDOUT).sum() == 20
    p = table[0].toPandas()
    assert p.groupby("kind").size().to_dict() == {"in_sample": 200, "out_of_fold": 200, "holdout": 40}
    got = {(t.kind, t.id): t.prediction for t in p[p.model == "linear"].itertuples()}
    for k in range(FOLDS):
        want = _apply(_fit(x[(fold >= 0) & (fold != k)], y[(fold >= 0) & (fold != k)]), x)
        for i in np.flatnonzero(fold == k):
            assert got["out_of_fold", r["id"][i]] == pytest.approx(want[i], abs=1e-6)
    want = _apply(_fit(x[fold >= 0], y[fold >= 0]), x)
    for i in range(len(r)):
        assert got["holdout" if fold[i] < 0 else "in_sample", r["id"][i]] == pytest.approx(want[i], abs=1e-6)


@pytest.mark.parametrize("learn", ["out_of_fold", "in_sample"])
def test_stacking_is_least_squares_over_the_table(table, learn):
    p = table[0].toPandas()
    wide = p.pivot(index=["id", "label", "kind"], columns="model", values="prediction").reset_index()
    own = wide[wide.kind == learn]
    w = _fit(own[["linear", "forest"]].to_numpy(), own["label"].to_numpy())
    part = wide[wide.kind.isin([learn, "holdout"])]
    want = dict(zip(zip(part.kind, part.id), _apply(w, part[["linear", "forest"]].to_numpy())))
    got = {(t.kind, t.id): t.prediction for t in E.stacked(table[0], KEY, ["linear", "forest"], learn).collect()}
    assert got == pytest.approx(want, abs=1e-6)


def test_blends_and_contributions_by_sql(table):
    frame, path = table
    con = duckdb.connect()
    con.execute(f"CREATE VIEW p AS SELECT * FROM read_parquet('{path}/*/*/rows/*.parquet')")
    con.execute("""CREATE VIEW w AS SELECT model, i / sum(i) OVER () AS weight FROM (
        SELECT model, 1 / (avg((label - prediction) ** 2) + 1e-8) AS i FROM p WHERE kind = 'out_of_fold' GROUP BY 1)""")
    weights = E.error_weights(frame)
    assert {r.model: r.weight for r in weights.collect()} == pytest.approx(dict(con.execute("FROM w").fetchall()))
    held = frame.where("kind = 'holdout'")
    want = dict(con.execute("SELECT id, sum(weight * prediction) FROM p JOIN w USING (model) "
                            "WHERE kind = 'holdout' GROUP BY 1").fetchall())
    assert {r.id: r.prediction for r in E.blended(held, weights, KEY).collect()} == pytest.approx(want)
    added = E.contributions(held, weights).groupBy("id").agg(F.sum("contribution").alias("c")).collect()
    assert {r.id: r.c for r in added} == pytest.approx(want)
    mean = dict(con.execute("SELECT id, avg(prediction) FROM p WHERE kind = 'holdout' GROUP BY 1").fetchall())
    equal = E.blended(held, E.equal_weights(frame), KEY).collect()
    assert {r.id: r.prediction for r in equal} == pytest.approx(mean)


class Counted:
    """An estimator that counts its fits and fails from a given one on."""

    def __init__(self, most):
        self.most, self.fits = most, 0

    def fit(self, frame):
        self.fits += 1
        if self.fits > self.most:
            raise RuntimeError("killed")
        return LinearRegression().fit(frame)


def test_killed_run_goes_on(rows, tmp_path):
    first = Counted(2)
    with pytest.raises(RuntimeError, match="killed"):
        E.prediction_table(rows, KEY, {"m": first}, FOLDS, str(tmp_path), parallelism=1)
    second = Counted(99)
    got = E.prediction_table(rows, KEY, {"m": second}, FOLDS, str(tmp_path), parallelism=1)
    assert second.fits == FOLDS + 1 - 2
    assert got.count() == 220


def test_no_rows(rows, tmp_path):
    assert E.prediction_table(rows.where("false"), KEY, models(), FOLDS, str(tmp_path)).count() == 0
