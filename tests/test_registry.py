"""The registry picks the better model of each task, whichever way its metric counts."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer

from basketry.models import registry as R
from basketry.plans import jobs as J


def constant(spark, value):
    stage = SQLTransformer(statement=f"SELECT *, {value} AS prediction FROM __THIS__")
    return Pipeline(stages=[stage]).fit(spark.range(1))


@pytest.mark.parametrize("larger", [True, False])
def test_best_model_is_loaded(spark, tmp_path, larger):
    folder = str(tmp_path / "registry")
    R.register(spark, folder, "t", "one", "m", 0.2, constant(spark, 1), larger)
    R.register(spark, folder, "t", "two", "m", 0.7, constant(spark, 2), larger)
    R.register(spark, folder, "t", "none", "m", None, constant(spark, 3), larger)
    R.register(spark, folder, "u", "other", "m", 9.0, constant(spark, 4), larger)
    def prediction(task):
        return R.load_best(spark, folder, task).transform(spark.range(1)).first().prediction
    assert prediction("t") == (2 if larger else 1) and prediction("u") == 4
    # a further model turns the order
    R.register(spark, folder, "t", "three", "m", 0.9 if larger else 0.1, constant(spark, 5), larger)
    assert prediction("t") == 5
    assert R.registered(spark, folder).count() == 5
    with pytest.raises(ValueError):
        R.load_best(spark, folder, "missing")


def test_scoring_uses_the_better_forecast(spark, sf_small, tmp_path):
    folder = str(tmp_path / "jobs")
    got = J.forecast_scoring_job(spark, sf_small, folder=folder).collect()
    rows = {r.model: r for r in R.registered(spark, folder).collect()}
    assert set(rows) == {"linear_regression", "random_forest"} and len(got) > 0
    best = R.best_models(R.registered(spark, folder)).first()
    assert best.value == min(r.value for r in rows.values())
