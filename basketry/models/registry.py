"""Model registry: fitted models with their metric, and the best of each task (W12, E18, IO8).

A row (task, model, metric, value, larger_is_better, path) is written for every model that is
registered; scoring takes the best row of a task and loads that path. Rows go to a folder each, so
several jobs may register at once.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import best_per_group

REGISTRY = "task string, model string, metric string, value double, larger_is_better boolean, path string"


def register(spark: SparkSession, folder: str, task: str, name: str, metric: str, value: float | None,
             model: PipelineModel, larger_is_better: bool = True) -> str:
    """Save the model under ``folder`` and add its row; returns the model's path."""
    path = f"{folder}/models/{name}-{uuid.uuid4().hex}"
    model.write().save(path)
    row = (task, name, metric, None if value is None else float(value), larger_is_better, path)
    spark.createDataFrame([row], REGISTRY).coalesce(1).write.json(f"{folder}/rows/{uuid.uuid4().hex}")
    return path


def registered(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(REGISTRY).option("recursiveFileLookup", "true").json(f"{folder}/rows")


def best_models(models: DataFrame) -> DataFrame:
    """The best row of each task by its metric, whichever way that counts; ties by model name.

    Models without a value are never chosen.
    """
    ranked = models.withColumn("_rank", F.when(F.col("larger_is_better"), F.col("value"))
                               .otherwise(-F.col("value")))
    return best_per_group(ranked, "task", "_rank", tiebreak="model").drop("_rank")


def load_best(spark: SparkSession, folder: str, task: str) -> PipelineModel:
    row = best_models(registered(spark, folder)).where(F.col("task") == task).first()
    if row is None:
        raise ValueError(f"no model is registered for {task}")
    return PipelineModel.load(row["path"])
