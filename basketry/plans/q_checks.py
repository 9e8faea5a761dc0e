"""Rules of fitted models: Spark counts what breaks them, SQL counts the rows they are about."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models.prep import key_number_sql
from ..sources import files as IO
from ..sources.tables import TABLES, tx_sql
from . import checks as K
from . import jobs as J
from .q_customers import RFM_CTE
from .q_models import _FORECAST_CTE
from .registry import S, query, sigd

_PART = f"{key_number_sql(['customer_id', 'CAST(churn AS DOUBLE)'], 42)} / 4294967296.0"
_MODELS = ("logistic_regression", "random_forest", "gradient_boosting", "decision_tree", "linear_svc")


def _rows(pairs, count: str) -> str:
    return " UNION ALL ".join(f"SELECT '{rule}' AS rule, '{model}' AS model, {count} AS n_rows, 0::BIGINT AS violations FROM c"
                              for rule, model in pairs)


@query("churn_model_checks", f"""WITH {RFM_CTE},
c AS (SELECT count(*) AS n, count(*) FILTER ({_PART} >= 0.2) AS n_train, count(*) FILTER ({_PART} < 0.2) AS n_test FROM rfm)
{_rows([("likelier class", m) for m in _MODELS] + [("probability", m) for m in _MODELS[:4]]
       + [("share of the leaf", "decision_tree")], "n")}
UNION ALL {_rows([("rows train", m) for m in _MODELS] + [
    ("gradient", "logistic_regression"), ("hinge loss", "linear_svc"), ("ranks churners first", "random_forest"),
    ("ranks churners first", "gradient_boosting")], "n_train")}
UNION ALL {_rows([("rows test", m) for m in _MODELS], "n_test")}""", covers=("L5", "L6", "L7", "L8", "L9", "M5", "M6"))
def q_churn_model_checks(spark, sf_dir):
    return K.classifier_checks_job(spark, sf_dir)


@query("segment_checks", f"""WITH {RFM_CTE},
c AS (SELECT count(*) AS n FROM rfm)
{_rows([("nearest centre", "kmeans"), ("cost", "kmeans"), ("silhouette", "kmeans"), ("one cluster", "elbow"),
        ("more clusters cost less", "elbow"), ("explained variance", "pca"), ("uncorrelated", "pca"),
        ("levels rise", "performance")], "n")}""", covers=("L10", "L11", "M7", "E8", "W18", "J12"))
def q_segment_checks(spark, sf_dir):
    return K.segment_checks_job(spark, sf_dir)


@query("importance_checks", f"""SELECT feature, 3::BIGINT AS n_models, 0::BIGINT AS violations FROM (
  SELECT unnest([{", ".join(f"'{c}'" for c in J.CHURN_NUMERIC)}]) AS feature
  UNION ALL SELECT 'market_segment_' || s FROM (
    SELECT DISTINCT coalesce(c_mktsegment, 'Unknown') AS s FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders SEMI JOIN lineitem ON l_orderkey = o_orderkey))
  QUALIFY row_number() OVER (ORDER BY s) > 1)""", covers=("L15", "A38", "T4"))
def q_importance_checks(spark, sf_dir):
    return K.importance_checks_job(spark, sf_dir)


_RFM2_CTE = RFM_CTE.strip().replace("tx AS", "tx2 AS").replace("FROM tx", "FROM tx2")
_TRIED = [("grid churn", "random_forest", 2), ("grid churn", "linear_svc", 1), ("grid forecast", "random_forest", 2),
          ("grid forecast", "gradient_boosting", 1), ("draws churn", "random_forest", 2),
          ("draws churn", "gradient_boosting", 2)]


@query("trial_checks", f"""WITH {_FORECAST_CTE},
{_RFM2_CTE},
x AS (SELECT 'churn' AS task, {key_number_sql(["customer_id"], 42)} % 5 AS fold FROM rfm
      UNION ALL SELECT 'forecast', {key_number_sql(["ds"], 42)} % 5 FROM f),
n AS (SELECT task, h.k AS fold, count(*) FILTER (x.fold <> h.k) AS n_train, count(*) FILTER (x.fold = h.k) AS n_valid
      FROM x, range(5) h(k) GROUP BY 1, 2),
s(study, model, n_settings) AS (VALUES {", ".join(map(str, _TRIED))}),
c AS (SELECT (row_number() OVER (ORDER BY ds) - 1) * 11 // count(*) OVER () AS cut FROM f),
w AS (SELECT h.k AS cut, count(*) FILTER (c.cut < h.k) AS n_train, count(*) FILTER (c.cut = h.k) AS n_valid
      FROM c, range(1, 11) h(k) GROUP BY 1)
SELECT study, model, fold::INTEGER AS fold, n_settings::BIGINT AS n_settings, n_train, n_valid, 0::BIGINT AS violations
FROM s JOIN n ON study LIKE '% ' || task
UNION ALL SELECT 'walk forward', m, cut::INTEGER, 1, n_train, n_valid, 0
FROM w, unnest(['logistic_regression', 'random_forest', 'gradient_boosting']) u(m)""",
       covers=("E9", "E10", "E11", "E12", "IO7", "M12"))
def q_trial_checks(spark, sf_dir):
    return K.trial_checks_job(spark, sf_dir)


@query("scoring_checks", f"""WITH {RFM_CTE},
c AS (SELECT count(*) AS n FROM rfm)
{_rows([("once each", "churn"), ("probability", "churn"), ("tier", "churn"), ("segment", "segments")], "n")}""",
       covers=("E18", "IO8", "P18", "J12"))
def q_scoring_checks(spark, sf_dir):
    return K.scoring_checks_job(spark, sf_dir)


@query("segment_totals", f"""WITH {RFM_CTE},
x AS (SELECT rfm.*, coalesce(c_acctbal, 0) AS account_balance,
        CASE WHEN coalesce(c_acctbal, 0) < 2500 THEN 1 WHEN coalesce(c_acctbal, 0) < 6000 THEN 2 ELSE 3 END AS income_level
      FROM rfm LEFT JOIN customer ON c_custkey = customer_id WHERE recency IS NOT NULL)
{" UNION ALL ".join(f"SELECT count(*) AS n_rows, '{c}' AS feature, {S(f'sum({c})::DOUBLE', 8)} AS total FROM x"
                    for c in J.SEGMENT_NUMERIC)}""", covers=("E21", "A33", "P9", "P19"))
def q_segment_totals(spark, sf_dir):
    """What the clusters' counts and means add up to, whichever cluster a customer is in."""
    return sigd(K.group_totals(J.segmentation_job(spark, sf_dir), "count", {c: f"avg_{c}" for c in J.SEGMENT_NUMERIC}),
                ["total"], 8)


@query("promotion_totals", f"""WITH tx AS ({tx_sql(["transaction_id", "product_id", "total_sales", "quantity",
                                                 "discount_applied"])}),
i AS (SELECT *, sum(quantity) OVER (PARTITION BY transaction_id) AS items FROM tx),
x AS (SELECT product_id, sum(total_sales) AS total_sales, sum(quantity) AS total_quantity,
        avg(discount_applied) AS avg_discount, avg(items) AS avg_items_per_txn
      FROM i WHERE product_id IS NOT NULL GROUP BY 1)
{" UNION ALL ".join(f"SELECT count(*) AS n_rows, '{c}' AS feature, {S(f'sum({c})', 8)} AS total FROM x "
                    f"WHERE {' AND '.join(f'{v} IS NOT NULL' for v in J.PROMO_NUMERIC)}" for c in J.PROMO_NUMERIC)}""",
       covers=("E22", "A6", "A34"))
def q_promotion_totals(spark, sf_dir):
    """What the performance levels' counts and means add up to."""
    return sigd(K.group_totals(J.promotion_job(spark, sf_dir), "product_count",
                               {c: f"mean_{c}" for c in J.PROMO_NUMERIC}), ["total"], 8)


@query("source_inventory", f"""{" UNION ALL ".join(
    f"SELECT '{t}' AS source, TRUE AS present, count(*) AS rows FROM {t}" for t in TABLES)}
UNION ALL SELECT 'suppliers_archive', FALSE, NULL""", covers=("IO5",))
def q_source_inventory(spark, sf_dir):
    """Rows of each source that is there; a source that is missing is reported, not an error."""
    out = []
    for name in (*TABLES, "suppliers_archive"):
        try:
            df = IO.read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
            out.append(df.agg(F.lit(name).alias("source"), F.lit(True).alias("present"),
                              F.count(F.lit(1)).alias("rows")))
        except IO.SourceMissing:
            out.append(spark.range(1).select(F.lit(name).alias("source"), F.lit(False).alias("present"),
                                             F.lit(None).cast("long").alias("rows")))
    return J._union(out)
