"""The rules of fitted models find what breaks them."""

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketry.models import estimators as L
from basketry.models import prep as Mp
from basketry.plans import checks as K


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, float(i % 7), float((i * i) % 11), float(i % 7 + (i * 5) % 13 > 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, churn double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()


def _violations(df):
    return df.first()["violations"]


def test_gradient_of_a_fit_and_of_a_moved_one(points):
    weighted = Mp.balanced_class_weights(points, "churn")
    est = L.classifiers(label="churn", weight="class_weight")["logistic_regression"].setMaxIter(500).setTol(1e-12)
    p = est.fit(weighted).transform(weighted).select(
        "churn", "class_weight", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("score"))
    assert _violations(K._gradient(p, "m")) == 0
    assert _violations(K._gradient(p.withColumn("score", F.col("score") * 0.9), "m")) == 3


def test_silhouette_from_sums(points):
    c = KMeans(k=3, seed=1, predictionCol="cluster").fit(points).transform(points)
    reported = L.silhouette(c)
    x = c.withColumn("x", vector_to_array("features"))
    assert _violations(K._silhouette_rule(x, reported, 2)) == 0
    assert _violations(K._silhouette_rule(x, reported + 1e-3, 2)) == 1


def test_rules_count_rows(points):
    got = K._rule(points, "r", "m", F.col("customer_id") >= 190).first()
    assert (got["n_rows"], got["violations"]) == (200, 10)
    assert _violations(K._rule(points.limit(0), "r", "m", F.lit(True))) == 0
    assert _violations(K._sum_rule(points, "r", "m", F.count(F.lit(1)) == 200)) == 0
    assert _violations(K._sum_rule(points, "r", "m", F.count(F.lit(1)) == 199)) == 1


def test_group_totals_do_not_depend_on_the_groups(points):
    for groups in (1, 2, 7):
        g = points.groupBy(F.col("customer_id") % groups).agg(
            F.avg("a").alias("mean_a"), F.avg("b").alias("mean_b"), F.count(F.lit(1)).alias("n"))
        got = {r["feature"]: (r["n_rows"], round(r["total"], 6))
               for r in K.group_totals(g, "n", {"a": "mean_a", "b": "mean_b"}).collect()}
        whole = points.agg(F.sum("a"), F.sum("b")).first()
        assert got == {"a": (200, whole[0]), "b": (200, whole[1])}


def test_unseen_levels_have_one_slot(spark):
    from pyspark.ml import Pipeline
    train = spark.createDataFrame([("x",), ("y",)], "level string")
    test = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "level string")
    enc = Pipeline(stages=Mp.one_hot_stages(["level"], drop_first=False, keep_unknown=True)).fit(train)
    got = [list(r[0]) for r in enc.transform(test).select(vector_to_array("level_ohe")).collect()]
    assert got == [[1, 0, 0], [0, 1, 0], [0, 0, 1], [0, 0, 1]]
