"""Spark ML estimators for forecasting, churn and segmentation.

Each single-machine model of the reference maps to a distributed MLlib
estimator: linear and logistic regression, random forests, gradient-boosted
trees (for the XGBoost / LightGBM / CatBoost family), a decision tree, a
linear SVM, k-means. All fit on DataFrames with a ``features`` vector.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SEED = 42


# ---------------------------------------------------------------- L1–L3
def regressors(label: str = "label", features: str = "features", trees: int = 200,
               iterations: int = 1000) -> dict:
    """Named regression estimators; by default of the reference's sizes."""
    return {
        "linear_regression": LinearRegression(featuresCol=features, labelCol=label),
        "random_forest": RandomForestRegressor(featuresCol=features, labelCol=label,
                                               numTrees=trees, maxDepth=8, seed=SEED),
        "gradient_boosting": GBTRegressor(featuresCol=features, labelCol=label, maxIter=iterations,
                                          maxDepth=5, stepSize=0.1, subsamplingRate=0.8,
                                          seed=SEED),
    }


# ---------------------------------------------------------------- L5–L9
def classifiers(label: str = "label", features: str = "features", weight: str | None = None,
                trees: int = 200, iterations: int = 1000) -> dict:
    """Named classification estimators; by default of the reference's sizes."""
    lr = LogisticRegression(featuresCol=features, labelCol=label, maxIter=100)
    svc = LinearSVC(featuresCol=features, labelCol=label, maxIter=50)
    if weight:
        lr.setWeightCol(weight)
        svc.setWeightCol(weight)
    return {
        "logistic_regression": lr,
        "random_forest": RandomForestClassifier(featuresCol=features, labelCol=label,
                                                numTrees=trees, maxDepth=8, seed=SEED),
        "gradient_boosting": GBTClassifier(featuresCol=features, labelCol=label, maxIter=iterations,
                                           maxDepth=8, stepSize=0.05, seed=SEED),
        "decision_tree": DecisionTreeClassifier(featuresCol=features, labelCol=label, seed=SEED),
        "linear_svc": svc,
    }


# ---------------------------------------------------------------- L4
def mean_baseline(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Predict the train mean for every test row (scalar subquery)."""
    return test.withColumn("prediction", train.select(F.avg(label)).scalar())


def mode_baseline(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Predict the most frequent train label (ties → smallest)."""
    return test.withColumn("prediction", train.select(F.mode(label, True)).scalar()
                           .cast("double"))


# ---------------------------------------------------------------- L10, L11, E8
def kmeans(k: int, features: str = "features", prediction: str = "cluster") -> KMeans:
    return KMeans(k=k, seed=SEED, featuresCol=features, predictionCol=prediction)


def silhouette(pred: DataFrame, features: str = "features", prediction: str = "cluster") -> float:
    """Silhouette with squared Euclidean distance (Spark's definition)."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol=prediction,
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    return ev.evaluate(pred)


def elbow_curve(df: DataFrame, ks: Sequence[int] = range(1, 11), features: str = "features") -> DataFrame:
    """Within-cluster sum of squares per k.

    Spark refuses k = 1; its cost is n·Σ var_pop over the feature
    dimensions, one aggregation over the vector elements.
    """
    spark = df.sparkSession
    rows = []
    for k in ks:
        if k == 1:
            arr = df.select(vector_to_array(features).alias("_v"))
            dim = len(arr.first()["_v"])
            agg = arr.agg(F.count(F.lit(1)).alias("n"),
                          *[F.var_pop(F.col("_v")[i]).alias(f"v{i}") for i in range(dim)]).first()
            cost = float(agg["n"]) * sum(float(agg[f"v{i}"] or 0.0) for i in range(dim))
        else:
            cost = float(kmeans(k, features).fit(df).summary.trainingCost)
        rows.append((int(k), cost))
    return spark.createDataFrame(rows, "k int, inertia double")


# Names of the performance levels.
PERFORMANCE_LEVELS = ("Low Performer", "Mid Performer", "Top Performer")


def performance_labels(clustered: DataFrame, cluster: str, value: str,
                       labels: Sequence[str] = PERFORMANCE_LEVELS) -> DataFrame:
    """Name clusters by the rank of their mean ``value``.

    Cluster means are one row per cluster (k rows); the rank runs on those
    k rows and the label map is broadcast back to the members.
    """
    means = clustered.groupBy(cluster).agg(F.avg(value).alias("_mean"))
    ranked = means.withColumn("_r", F.row_number().over(W.orderBy("_mean", cluster)) - 1)
    names = F.array(*[F.lit(x) for x in labels])
    ranked = ranked.select(cluster, F.element_at(names, F.least(F.col("_r") + 1, F.lit(len(labels))))
                           .alias("performance_level"))
    return clustered.join(F.broadcast(ranked), cluster, "left")


# ---------------------------------------------------------------- L15
def feature_importance(model, names: Sequence[str], model_name: str) -> DataFrame:
    """(model, feature, importance) from tree importances or |coefficients|."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        vals = [abs(float(v)) for v in model.coefficients.toArray()]
    else:
        raise ValueError("model has no importances or coefficients")
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    rows = [(model_name, n, float(v)) for n, v in zip(names, vals)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    """Mean importance per feature over models, top n."""
    return (importance.groupBy("feature").agg(F.avg("importance").alias("mean_importance"))
                      .orderBy(F.desc("mean_importance"), "feature").limit(n))
