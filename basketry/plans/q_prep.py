"""Preparation steps with exact answers: scaling, weights, encodings, splits, folds, baselines."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..models import estimators as L
from ..models import prep as Mp
from ..operators import metrics as M
from ..sources.tables import customers
from .q_customers import RFM_CTE, rfm_frame
from .registry import R, S, query, rounded, sigd

_Z = ("frequency", "monetary", "tenure")


@query("customer_zscores", f"""WITH {RFM_CTE}
SELECT customer_id, {", ".join(
    R(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", 6) + f" AS {c}_z" for c in _Z)} FROM rfm""",
       covers=("M1",))
def q_customer_zscores(spark, sf_dir):
    z = Mp.zscore(rfm_frame(spark, sf_dir), list(_Z), suffix="_z")
    return rounded(z.select("customer_id", *[f"{c}_z" for c in _Z]), {f"{c}_z": 6 for c in _Z})


@query("churn_class_weights", f"""WITH {RFM_CTE},
n AS (SELECT churn, count(*) AS nc FROM rfm GROUP BY 1)
SELECT rfm.customer_id, rfm.churn, {R("(SELECT sum(nc) FROM n) / ((SELECT count(*) FROM n) * n.nc)", 6)} AS class_weight
FROM rfm JOIN n ON n.churn = rfm.churn""", covers=("M14",))
def q_churn_class_weights(spark, sf_dir):
    w = Mp.balanced_class_weights(rfm_frame(spark, sf_dir), "churn")
    return rounded(w.select("customer_id", "churn", "class_weight"), {"class_weight": 6})


@query("segment_one_hot", """WITH lv AS (SELECT list(DISTINCT c_mktsegment ORDER BY c_mktsegment DESC) AS l FROM customer)
SELECT c_custkey AS customer_id,
       list_transform(l[1:len(l) - 1], lambda x: CAST(x = c_mktsegment AS DOUBLE)) AS segment
FROM customer, lv""", covers=("M2", "M4"))
def q_segment_one_hot(spark, sf_dir):
    """Indicator per level, the alphabetically first dropped; levels in descending order."""
    from pyspark.ml import Pipeline
    c = customers(spark, sf_dir, with_geo=False)
    out = Pipeline(stages=Mp.one_hot_stages(["c_mktsegment"])).fit(c).transform(c)
    return out.select(F.col("c_custkey").alias("customer_id"),
                      vector_to_array("c_mktsegment_ohe").alias("segment"))


_U = f"{Mp.key_number_sql(['customer_id'], 42)} / 4294967296.0"
_US = f"{Mp.key_number_sql(['customer_id', 'churn'], 42)} / 4294967296.0"


@query("customer_splits", f"""WITH {RFM_CTE}
SELECT customer_id, CASE WHEN {_U} >= 0.2 THEN 'train' ELSE 'test' END AS random_part,
       CASE WHEN {_US} >= 0.2 THEN 'train' ELSE 'test' END AS stratified_part,
       CAST({Mp.key_number_sql(["customer_id"], 42)} % 5 AS INTEGER) AS fold
FROM rfm""", covers=("M10", "M11", "M12"))
def q_customer_splits(spark, sf_dir):
    r = rfm_frame(spark, sf_dir).select("customer_id", "churn")

    def parts(two, name):
        train, test = two
        return (train.select("customer_id", F.lit("train").alias(name))
                .unionByName(test.select("customer_id", F.lit("test").alias(name))))

    folds = r.select("customer_id", Mp.fold_column(["customer_id"], 5).alias("fold"))
    return (parts(Mp.random_split(r, ["customer_id"]), "random_part")
            .join(parts(Mp.stratified_split(r, ["customer_id"], "churn"), "stratified_part"), "customer_id")
            .join(folds, "customer_id"))


@query("customer_baselines", f"""WITH {RFM_CTE},
s AS (SELECT *, {_U} AS u FROM rfm),
b AS (SELECT avg(monetary) AS m, min(churn) FILTER (c = top) AS mode FROM (
        SELECT monetary, churn, c, max(c) OVER () AS top FROM (
          SELECT monetary, churn, count(*) OVER (PARTITION BY churn) AS c FROM s WHERE u >= 0.2))),
t AS (SELECT monetary - m AS r, CAST(churn = mode AS DOUBLE) AS hit FROM s, b WHERE u < 0.2)
SELECT 'mean' AS model, 'mae' AS metric, {S("avg(abs(r))")} AS value FROM t
UNION ALL SELECT 'mean', 'rmse', {S("sqrt(avg(r * r))")} FROM t
UNION ALL SELECT 'most_frequent', 'accuracy', {S("avg(hit)")} FROM t""", covers=("L4", "M10"))
def q_customer_baselines(spark, sf_dir):
    """Mean of the training part for spend, its most frequent label for churn, on the test part."""
    train, test = Mp.random_split(rfm_frame(spark, sf_dir), ["customer_id"])
    reg = M.regression_metrics(L.mean_baseline(train, test, "monetary"), "monetary", "prediction")
    cls = M.classification_metrics(L.mode_baseline(train, test, "churn"), "churn", "prediction")
    out = (reg.where(F.col("metric").isin("mae", "rmse")).withColumn("model", F.lit("mean"))
           .unionByName(cls.where("metric = 'accuracy'").withColumn("model", F.lit("most_frequent"))))
    return sigd(out.select("model", "metric", "value"), ["value"])
