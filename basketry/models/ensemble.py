"""Ensembles from one long table of predictions.

Every model is fitted once per fold and once on all training rows. The predictions are written
as rows (key, label, fold, kind, model, prediction): ``out_of_fold`` for the fold a model has not seen,
``in_sample`` for the training rows of the full fit, ``holdout`` for rows that no fit sees. Stacking,
blends, weights and contributions are derived from that table by grouping; nothing is fitted again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..operators.metrics import adaptive_weights, blend_long, regression_metrics
from ..session import cut_lineage
from ..sources.files import SourceMissing, read_parquet
from .prep import key_number
from .search import ROWS_PER_PARTITION

HOLDOUT = -1    # fold of the rows that no fit sees


def ensemble_rows(df: DataFrame, features: str, label: str, key: Sequence[str], folds: int,
                  holdout: Column, seed: int = 42) -> DataFrame:
    """(key, label, features, fold) of the rows with a label, written once.

    ``fold`` is 0..folds-1 by MD5 of the key, or HOLDOUT where ``holdout`` is true.
    """
    fold = F.when(holdout, F.lit(HOLDOUT)).otherwise(F.pmod(key_number(key, seed), F.lit(folds)))
    out = df.select(*key, F.col(label).cast("double").alias("label"), F.col(features).alias("features"),
                    fold.cast("int").alias("fold"))
    out = cut_lineage(out.where(F.col("label").isNotNull()))
    return out.coalesce(max(1, -(-out.count() // ROWS_PER_PARTITION)))


def _written(spark: SparkSession, path: str) -> bool:
    """Has a fit's folder been finished (its marker comes last)?"""
    try:
        read_parquet(spark, f"{path}/done")
    except SourceMissing:
        return False
    return True


def prediction_table(rows: DataFrame, key: Sequence[str], models: Mapping[str, object], folds: int,
                     path: str, parallelism: int = 8) -> DataFrame:
    """The long table of predictions, each fit written to a folder of its own under ``path``.

    A classifier with probabilities gives the probability of label 1, any other model its prediction.
    Fits run several at a time. Started again on the same path, a killed run skips what is finished.
    A fold without rows to train on or to predict adds none.
    """
    spark = rows.sparkSession
    seen, held = F.col("fold") != HOLDOUT, F.col("fold")

    def rows_of(model: object, frame: DataFrame, name: str, kind: Column) -> DataFrame:
        out = model.transform(frame)
        value = vector_to_array("probability")[1] if "probability" in out.columns else F.col("prediction")
        return out.select(*key, "label", "fold", kind.alias("kind"), F.lit(name).alias("model"),
                          value.alias("prediction"))

    def work(name: str, k: int | None) -> None:
        to = f"{path}/{name}/{'all' if k is None else f'fold-{k}'}"
        if _written(spark, to):
            return
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{name}-{k}")
        train = rows.where(seen if k is None else seen & (held != k))
        scored = rows if k is None else rows.where(held == k)
        if train.isEmpty():
            return
        kind = (F.when(seen, "in_sample").otherwise("holdout") if k is None else F.lit("out_of_fold"))
        fitted = models[name].fit(train)
        rows_of(fitted, scored, name, kind).write.mode("overwrite").parquet(f"{to}/rows")
        spark.createDataFrame([(name,)], "model string").coalesce(1).write.mode("overwrite").parquet(f"{to}/done")

    with ThreadPoolExecutor(parallelism) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(work), name, k)
                for name in models for k in (None, *range(folds))]
        for job in jobs:
            job.result()
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in key]
                       + ["label double, fold int, kind string, model string, prediction double"])
    parts = [f"{path}/{name}/{part}" for name in models for part in ("all", *(f"fold-{k}" for k in range(folds)))]
    found = [f"{p}/rows" for p in parts if _written(spark, p)]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def wide_predictions(predictions: DataFrame, key: Sequence[str], models: Sequence[str]) -> DataFrame:
    """(key, label, kind, a column per model)."""
    return predictions.groupBy(*key, "label", "kind").pivot("model", list(models)).agg(F.first("prediction"))


def stacked(predictions: DataFrame, key: Sequence[str], models: Sequence[str],
            learn: str = "out_of_fold") -> DataFrame:
    """(key, label, kind, prediction) of a linear model over the models' predictions.

    It learns from the rows of kind ``learn`` (``in_sample`` for stacking without folds) and answers
    those and the holdout rows.
    """
    wide = cut_lineage(wide_predictions(predictions.where(F.col("kind").isin(learn, "holdout")), key, models))
    x = VectorAssembler(inputCols=list(models), outputCol="features").transform(wide)
    meta = LinearRegression(featuresCol="features", labelCol="label").fit(x.where(F.col("kind") == learn))
    return meta.transform(x).select(*key, "label", "kind", "prediction")


def equal_weights(predictions: DataFrame) -> DataFrame:
    """(model, weight): the same for each model."""
    names = predictions.select("model").distinct()
    return names.withColumn("weight", 1.0 / names.select(F.count(F.lit(1))).scalar())


def error_weights(predictions: DataFrame) -> DataFrame:
    """(model, weight): proportional to 1 / (out-of-fold mean squared error + 1e-8), sum 1."""
    own = predictions.where("kind = 'out_of_fold'")
    return adaptive_weights(regression_metrics(own, "label", "prediction", by=["model"], long=False))


def blended(predictions: DataFrame, weights: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, label, kind, prediction): weighted sums over the models (a row of weights each)."""
    return blend_long(predictions, weights, [*key, "label", "kind"]).withColumnRenamed("blended", "prediction")


def contributions(predictions: DataFrame, weights: DataFrame) -> DataFrame:
    """Each prediction with its model's weight and what it adds to the blend."""
    return predictions.join(F.broadcast(weights), "model").withColumn(
        "contribution", F.col("weight") * F.col("prediction"))
