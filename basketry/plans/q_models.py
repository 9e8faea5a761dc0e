"""Model-backed queries: Spark ML jobs (rows-only checks) and the exact
nearest-neighbour imputation (SQL oracle by brute force)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models.prep import key_number_sql
from ..models.resample import knn_impute, smote
from ..operators import aggregates as A
from ..operators import windows as Wn
from ..session import cut_lineage
from ..sources.tables import transactions, tx_sql
from . import jobs as J
from .q_customers import RFM_CTE
from .q_time import DAILY_CTE, REGION_DAILY_CTE, region_daily
from .registry import R, S, query, rnd, rounded, sig, sigd

_SAMPLE_COLS = ["transaction_id", "line_number", "product_id", "supplier_id", "quantity",
                "total_sales"]
_KNN_COLS = ["y", "lag_1", "lag_7", "lag_30"]


def _knn_sql(source: str, key: str, cols: list[str], where: str = "") -> str:
    """Per column: donors are the rows that have it; distance over the coordinates both rows have.

    ``source``: CTEs that end in ``f`` with ``key``, ds and ``cols``.
    """
    z = {c: f"z{i}" for i, c in enumerate(cols)}
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    zs = ", ".join(f"({c} - m_{c}) / s_{c} AS {z[c]}" for c in cols)
    both = " + ".join(f"CAST(q.{x} IS NOT NULL AND d.{x} IS NOT NULL AS INTEGER)" for x in z.values())
    sq = " + ".join(f"coalesce((q.{x} - d.{x}) * (q.{x} - d.{x}), 0)" for x in z.values())
    fills = ",\n".join(f"""f_{c} AS (
  SELECT {key}, ds, avg(val) AS fill FROM (
    SELECT q.{key}, q.ds, d.{c} AS val, row_number() OVER (PARTITION BY q.{key}, q.ds ORDER BY
             sqrt(({sq}) * {len(cols)}.0 / ({both})), d.{key}, d.ds) AS rn
    FROM z q, z d WHERE q.{c} IS NULL AND d.{c} IS NOT NULL AND ({both}) > 0)
  WHERE rn <= 5 GROUP BY 1, 2)""" for c in cols)
    joins = " ".join(f"LEFT JOIN f_{c} ON f_{c}.{key} = z.{key} AND f_{c}.ds = z.ds" for c in cols)
    outs = ", ".join(f"{R(f'coalesce(z.{c}, f_{c}.fill, st.m_{c})')} AS {c}" for c in cols)
    return f"""WITH {source},
st AS (SELECT {stats} FROM f),
z AS (SELECT f.*, {zs} FROM f, st),
{fills}
SELECT z.{key}, z.ds, {outs} FROM z CROSS JOIN st {joins} {where}"""


_REGION_LAGS = f"""{REGION_DAILY_CTE},
f AS (SELECT region, ds, y, lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7, lag(y, 30) OVER w AS lag_30
      FROM d WINDOW w AS (PARTITION BY region ORDER BY ds))"""

_CATEGORY_LAGS = f"""tx AS ({tx_sql(["product_category", "transaction_date", "total_sales"])}),
d AS (SELECT product_category, transaction_date AS ds, sum(total_sales) AS y FROM tx
      WHERE product_category IS NOT NULL AND transaction_date IS NOT NULL GROUP BY 1, 2),
f AS (SELECT product_category, ds, y, lag(y, 1) OVER w AS lag_1, lag(y, 2) OVER w AS lag_2,
        lag(y, 3) OVER w AS lag_3, CASE WHEN count(y) OVER r = 3 THEN avg(y) OVER r END AS rolling_mean_3,
        CASE WHEN count(y) OVER r = 3 THEN stddev_samp(y) OVER r END AS rolling_std_3
      FROM d WINDOW w AS (PARTITION BY product_category ORDER BY ds),
        r AS (PARTITION BY product_category ORDER BY ds ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


@query("knn_imputed_lags", _knn_sql(_REGION_LAGS, "region", _KNN_COLS), covers=("P10",))
def q_knn_imputed_lags(spark, sf_dir):
    d = Wn.lag_features(region_daily(spark, sf_dir), "y", [1, 7, 30], order=["ds"],
                        partition=["region"])
    out = knn_impute(d, _KNN_COLS, key=["region", "ds"], k=5)
    return rounded(out.select("region", "ds", *_KNN_COLS), {c: 4 for c in _KNN_COLS})


@query("category_day_gaps_filled", _knn_sql(_CATEGORY_LAGS, "product_category", J.CATEGORY_DAY_NUMERIC,
                                            "WHERE z.lag_3 IS NULL OR z.rolling_std_3 IS NULL"),
       covers=("E28", "P10"))
def q_category_day_gaps_filled(spark, sf_dir):
    """The rows that the fill of the basic feature table changes, as filled."""
    tx = transactions(spark, sf_dir, ["product_category", "transaction_date", "total_sales"])
    daily = cut_lineage(A.daily_sales(tx, keys=["product_category"]))
    gaps = J.category_day_features(daily).where("lag_3 IS NULL OR rolling_std_3 IS NULL")
    out = J.filled_category_days(daily).join(gaps.select("product_category", "ds"),
                                             ["product_category", "ds"], "left_semi")
    return rounded(out.select("product_category", "ds", *J.CATEGORY_DAY_NUMERIC),
                   {c: 4 for c in J.CATEGORY_DAY_NUMERIC})


@query("churn_models", covers=("E19", "L5", "L6", "L7", "M11", "M14", "M2", "M5", "M6",
                               "E3", "E6"))
def q_churn_models(spark, sf_dir):
    return J.churn_job(spark, sf_dir)


@query("churn_models_smote", covers=("M13", "E19"))
def q_churn_models_smote(spark, sf_dir):
    return J.churn_job(spark, sf_dir, models=("logistic_regression",), oversample=True)


@query("smote_class_balance", f"""WITH {RFM_CTE},
c AS (SELECT churn, count(*) AS n FROM rfm GROUP BY churn)
SELECT CAST(churn AS DOUBLE) AS churn, CAST((SELECT max(n) FROM c) AS BIGINT) AS rows FROM c""",
       covers=("M13",))
def q_smote_class_balance(spark, sf_dir):
    from ..models import prep as Mp
    feats = J.churn_features(spark, sf_dir)
    x = Mp.feature_pipeline(J.CHURN_NUMERIC, J.CHURN_CATEGORICAL).fit(feats).transform(feats)
    bal = smote(x, "churn", key="customer_id")
    return bal.groupBy("churn").agg(F.count(F.lit(1)).alias("rows"))


@query("forecast_models", covers=("E20", "L1", "L2", "L3", "L4", "M9", "E1", "F1", "F2", "W3",
                                  "W6"))
def q_forecast_models(spark, sf_dir):
    return J.forecast_job(spark, sf_dir)


@query("customer_segments", covers=("E21", "L10", "M1", "M7", "E8", "A33", "P9", "P19"))
def q_customer_segments(spark, sf_dir):
    return J.segmentation_job(spark, sf_dir)


@query("segment_elbow", covers=("L11",))
def q_segment_elbow(spark, sf_dir):
    return J.elbow_job(spark, sf_dir)


@query("pca_variance", covers=("M7",))
def q_pca_variance(spark, sf_dir):
    return J.pca_variance_job(spark, sf_dir)


@query("promotion_clusters", covers=("E22", "A6", "W18", "A31", "A34", "L10"))
def q_promotion_clusters(spark, sf_dir):
    return J.promotion_job(spark, sf_dir)


_CLV_TERMS = ["transactions_count", "average_spent", "days_since_first_purchase", "days_since_last_purchase",
              "customer_lifetime_value"]


def least_squares_sql(source: str, terms: list[str], label: str) -> tuple[str, str, str]:
    """(CTEs, table, expression) of the least-squares fit of ``label`` on ``terms`` over the rows of
    ``source`` with ``train``, for all its rows.

    Orthogonal columns: each term minus its projections on those before it, one after another; the fit is the
    sum of the label's projections on them.
    """
    onto = lambda c, q: f"sum({c} * {q}) FILTER (train) OVER () / sum({q} * {q}) FILTER (train) OVER () * {q}"
    steps, done, last = [f"ls AS (SELECT *, 1.0::DOUBLE AS q0 FROM {source})"], ["q0"], "ls"
    for i, term in enumerate(terms, start=1):
        left = f"CAST({term} AS DOUBLE)"
        for j, q in enumerate(done):
            steps.append(f"ls{i}_{j} AS (SELECT *, {left} - {onto(left, q)} AS r{i}_{j} FROM {last})")
            last, left = f"ls{i}_{j}", f"r{i}_{j}"
        done.append(left)
    return ", ".join(steps), last, " + ".join(onto(label, q) for q in done)


def _clv_sql() -> str:
    steps, last, fit = least_squares_sql("x", _CLV_TERMS, "future_value")
    u = f"{key_number_sql(['customer_id'], 42)} / 4294967296.0"
    return f"""WITH tx AS ({tx_sql(["customer_id", "transaction_id", "transaction_date", "quantity", "unit_price",
                                    "total_sales"])}),
c AS (SELECT min(transaction_date) + CAST(trunc(date_diff('day', min(transaction_date), max(transaction_date)) * 0.8)
        AS INTEGER) AS cutoff FROM tx),
past AS (SELECT customer_id, count(transaction_id) AS transactions_count, avg(quantity * unit_price) AS average_spent,
    date_diff('day', min(transaction_date), any_value(cutoff)) AS days_since_first_purchase,
    date_diff('day', max(transaction_date), any_value(cutoff)) AS days_since_last_purchase,
    avg(total_sales) * count(transaction_id) * (date_diff('day', min(transaction_date), max(transaction_date)) / 365.0)
      AS customer_lifetime_value
  FROM tx, c WHERE transaction_date <= cutoff AND customer_id IS NOT NULL GROUP BY 1),
future AS (SELECT customer_id, sum(total_sales) AS future_value FROM tx, c WHERE transaction_date > cutoff GROUP BY 1),
x AS (SELECT past.customer_id, {", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _CLV_TERMS)},
    coalesce(future_value, 0.0) AS future_value, {u.replace("customer_id", "past.customer_id")} >= 0.2 AS train
  FROM past LEFT JOIN future ON future.customer_id = past.customer_id),
{steps},
v AS (SELECT customer_id, future_value, {fit} AS predicted FROM {last})
SELECT customer_id, {S("predicted", 8)} AS predicted_clv, {R("future_value")} AS future_value
FROM v ORDER BY predicted DESC, customer_id LIMIT 10"""


@query("clv_top_customers", _clv_sql(), covers=("E23", "A2", "A9", "L1", "T2"))
def q_clv_top_customers(spark, sf_dir):
    return sigd(rounded(J.clv_job(spark, sf_dir), {"future_value": 4}), ["predicted_clv"], 8)


@query("batch_scoring", covers=("E18", "IO8", "P18", "J12"))
def q_batch_scoring(spark, sf_dir):
    return J.scoring_job(spark, sf_dir)


@query("forecast_scoring", covers=("E18", "E31", "IO8", "L1"))
def q_forecast_scoring(spark, sf_dir):
    return J.forecast_scoring_job(spark, sf_dir)


@query("grid_search_trials", covers=("E9", "E11", "M12"))
def q_grid_search_trials(spark, sf_dir):
    return J.grid_search_job(spark, sf_dir)


@query("random_search_trials", covers=("E10", "IO7"))
def q_random_search_trials(spark, sf_dir):
    return J.random_search_job(spark, sf_dir)


@query("walk_forward_validation", covers=("E12",))
def q_walk_forward_validation(spark, sf_dir):
    return J.walk_forward_job(spark, sf_dir)


@query("learning_curve_samples", f"""WITH {DAILY_CTE},
r AS (SELECT ds, row_number() OVER (ORDER BY ds) AS i FROM d),
x AS (SELECT {key_number_sql(["ds"], 42)} % 5 AS fold, {key_number_sql(["ds"], 43)} AS draw FROM r WHERE i > 7)
SELECT p.i / 10.0::DOUBLE AS fraction, h.held::INTEGER AS fold,
  count(*) FILTER (x.fold <> h.held AND x.draw < round(p.i / 10.0::DOUBLE * 4294967296)) AS n_train,
  count(*) FILTER (x.fold = h.held) AS n_valid
FROM x, range(1, 11) p(i), range(5) h(held) GROUP BY 1, 2""", covers=("E13", "M12"))
def q_learning_curve_samples(spark, sf_dir):
    return J.nested_samples_job(spark, sf_dir)


@query("learning_curve", covers=("E13",))
def q_learning_curve(spark, sf_dir):
    return J.learning_curve_job(spark, sf_dir)


@query("feature_importance", covers=("L15", "A38", "T4"))
def q_feature_importance(spark, sf_dir):
    return J.importance_job(spark, sf_dir)


@query("stacked_forecast", covers=("L16", "L17", "L18"))
def q_stacked_forecast(spark, sf_dir):
    return J.stacking_job(spark, sf_dir)


@query("ensemble_checks", f"""WITH {DAILY_CTE},
r AS (SELECT ds, row_number() OVER (ORDER BY ds) AS i FROM d),
x AS (SELECT CASE WHEN i - 8 >= count(*) OVER () * 4 // 5 THEN -1
                  ELSE {key_number_sql(["ds"], 42)} % 5 END AS fold FROM r WHERE i > 7),
c AS (SELECT count(*) AS n, count(*) FILTER (fold >= 0) AS t FROM x),
m AS (SELECT unnest(['linear_regression', 'random_forest', 'gradient_boosting']) AS model),
k AS (SELECT unnest(['in_sample', 'out_of_fold', 'holdout']) AS kind)
SELECT 'rows ' || kind AS rule, model, fold::INTEGER AS fold, count(*) AS n_rows, 0::BIGINT AS violations
FROM x, m, k WHERE (kind = 'holdout') = (fold < 0) GROUP BY 1, 2, 3
UNION ALL SELECT 'within labels', 'random_forest', NULL, n + t, 0 FROM c
UNION ALL SELECT 'residuals cancel', 'linear_regression', NULL, t, 0 FROM c
UNION ALL SELECT 'orthogonal ' || kind, model, NULL, t, 0 FROM c, m, k WHERE kind <> 'holdout'
UNION ALL SELECT 'mean', 'equal_blend', NULL, n - t, 0 FROM c""", covers=("L1", "L2", "L3", "L16", "L17"))
def q_ensemble_checks(spark, sf_dir):
    return J.ensemble_checks_job(spark, sf_dir)


_FORECAST_CTE = f"""{DAILY_CTE},
f AS (SELECT * FROM (
  SELECT ds, y, year(ds) AS year, month(ds) AS month, day(ds) AS day, isodow(ds) - 1 AS day_of_week,
    CAST(isodow(ds) >= 6 AS INTEGER) AS is_weekend, dayofyear(ds) AS day_of_year,
    lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7,
    CASE WHEN count(y) OVER r = 7 THEN avg(y) OVER r END AS rolling_mean_7_lag1,
    CASE WHEN count(y) OVER r = 7 THEN stddev_samp(y) OVER r END AS rolling_std_7_lag1
  FROM d WINDOW w AS (ORDER BY ds), r AS (ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
  WHERE lag_7 IS NOT NULL AND rolling_std_7_lag1 IS NOT NULL)"""


@query("feature_selection", f"""WITH {_FORECAST_CTE},
x AS ({" UNION ALL ".join(f"SELECT ds, y, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM f"
                          for c in J.FORECAST_NUMERIC)}),
b AS (SELECT feature, v, y, (rank() OVER (PARTITION BY feature ORDER BY v) - 1) * 10 // count(*) OVER p AS bx,
        (rank() OVER (PARTITION BY feature ORDER BY y) - 1) * 10 // count(*) OVER p AS b_y
      FROM x WINDOW p AS (PARTITION BY feature)),
c AS (SELECT feature, bx, b_y, count(*) AS n FROM b GROUP BY 1, 2, 3),
e AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature, bx) AS nx, sum(n) OVER (PARTITION BY feature, b_y) AS ny,
        sum(n) OVER (PARTITION BY feature) AS total FROM c),
mi AS (SELECT feature, sum(n / total * ln(n * total / (nx * ny))) AS mi FROM e GROUP BY 1),
r AS (SELECT feature, corr(v, y) AS r FROM x GROUP BY 1)
SELECT feature, {R("mi", 8)} AS mutual_information,
  CAST(row_number() OVER (ORDER BY round(mi, 9) DESC, feature) <= 5 AS INTEGER) AS mi_selected,
  CAST(row_number() OVER (ORDER BY r * r DESC) <= 5 AS INTEGER) AS f_test_selected
FROM mi JOIN r USING (feature)""", covers=("M8",))
def q_feature_selection(spark, sf_dir):
    return rounded(J.feature_selection_job(spark, sf_dir), {"mutual_information": 8})


@query("category_sales_quartiles", f"""WITH tx AS ({tx_sql(["product_category", "total_sales"])})
{" UNION ALL ".join(f"""SELECT product_category, {q}::DOUBLE AS quantile,
  {R(f"quantile_cont(total_sales, {q})")} AS value FROM tx WHERE total_sales IS NOT NULL GROUP BY 1"""
  for q in (0.25, 0.5, 0.75))}""", covers=("A28", "P13"))
def q_category_sales_quartiles(spark, sf_dir):
    """Exact quartiles of an unbounded column, whatever the size of a category."""
    from ..operators.quantiles import exact_quantiles
    tx = transactions(spark, sf_dir, ["product_category", "total_sales"])
    return rounded(exact_quantiles(tx, "total_sales", [0.25, 0.5, 0.75], ["product_category"]), {"value": 4})


_SCORES = ["recency", "frequency", "monetary", "tenure"]


@query("churn_score_auc", f"""WITH {RFM_CTE},
x AS ({" UNION ALL ".join(f"SELECT '{c}' AS model, CAST({c} AS DOUBLE) AS score, churn FROM rfm" for c in _SCORES)}),
k AS (SELECT model, churn, rank() OVER (PARTITION BY model ORDER BY score)
        + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS mid FROM x),
t AS (SELECT model, sum(mid) FILTER (churn = 1) AS s, count(*) FILTER (churn = 1) AS n_pos,
        count(*) FILTER (churn = 0) AS n_neg FROM k GROUP BY 1)
SELECT model, {R("(s - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg)", 9)} AS roc_auc, n_pos, n_neg FROM t""",
       covers=("E6",))
def q_churn_score_auc(spark, sf_dir):
    """Area under ROC of several scores of every customer, all in one pass."""
    from ..operators.metrics import roc_auc
    from .q_customers import rfm_frame
    stack = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in _SCORES)
    long = rfm_frame(spark, sf_dir).selectExpr("churn", f"stack({len(_SCORES)}, {stack}) AS (model, score)")
    return rounded(roc_auc(long, "churn", "score", by=["model"]), {"roc_auc": 9})


_LINE = ["transaction_id", "line_number", "product_id", "supplier_id"]


@query("line_residual_ranks", f"""WITH tx AS ({tx_sql([*_LINE, "region", "quantity", "total_sales"])}),
x AS (SELECT *, {R("total_sales")} - {R("avg(total_sales) OVER (PARTITION BY product_id)")} AS raw FROM tx
      WHERE total_sales IS NOT NULL AND product_id IS NOT NULL),
r AS (SELECT *, round(raw, 4) AS residual FROM x)
SELECT region, transaction_id, line_number, product_id, supplier_id, residual,
  CAST(row_number() OVER (PARTITION BY region ORDER BY {", ".join(_LINE)}, quantity, residual) - 1 AS INTEGER) AS index,
  CAST(row_number() OVER (PARTITION BY region ORDER BY residual, {", ".join(_LINE)}, quantity) AS INTEGER)
    AS residual_rank
FROM r""", covers=("E15",))
def q_line_residual_ranks(spark, sf_dir):
    """Residuals of all lines against their product's mean, ranked within each region."""
    from ..operators.metrics import residual_table
    tx = transactions(spark, sf_dir, [*_LINE, "region", "quantity", "total_sales"])
    # joined once: the means, their join and the number of rows read what is written
    tx = cut_lineage(tx.where("total_sales IS NOT NULL AND product_id IS NOT NULL"))
    mean = tx.groupBy("product_id").agg(rnd(F.avg("total_sales")).alias("mean"))
    d = tx.join(mean, "product_id").select(
        "region", *_LINE, "quantity", F.lit(0.0).alias("zero"),
        F.round(rnd(F.col("total_sales").cast("double")) - F.col("mean"), 4).alias("gap"))
    out = residual_table(d, "gap", "zero", order=[*_LINE, "quantity", "gap"], by=["region"], size=tx.count())
    return out.select("region", *_LINE, "residual", "index", "residual_rank")


@query("basic_feature_table", covers=("E28", "F1", "A10", "A9", "W8", "A12", "A11", "P10", "M1",
                                      "W2", "W5"))
def q_basic_feature_table(spark, sf_dir):
    return J.basic_features_job(spark, sf_dir)


@query("advanced_feature_table", covers=("E29", "F1", "F2", "F3", "F4", "W1", "W4", "A7", "A8",
                                         "F10", "F11"))
def q_advanced_feature_table(spark, sf_dir):
    return J.advanced_features_job(spark, sf_dir)


_STRATUM = f"{key_number_sql(['customer_id', 'CAST(churn AS DOUBLE)'], 42)} / 4294967296.0"


@query("model_matrix", f"""WITH {RFM_CTE},
x AS (SELECT CASE WHEN {_STRATUM} >= 0.2 THEN 'train' ELSE 'test' END AS split, CAST(churn AS DOUBLE) AS churn,
        coalesce(c_mktsegment, 'Unknown') AS segment
      FROM rfm LEFT JOIN customer ON c_custkey = customer_id)
SELECT split, churn, count(*) AS rows,
  CAST((SELECT {len(J.CHURN_NUMERIC)} + count(DISTINCT segment) - 1 FROM x WHERE split = 'train') AS INTEGER)
    AS feature_width
FROM x GROUP BY 1, 2""", covers=("E30", "M2", "M5", "M6", "M11"))
def q_model_matrix(spark, sf_dir):
    return J.model_matrix_job(spark, sf_dir)


_ERRORS = {"mae": "avg(abs(r))", "mse": "avg(r * r)", "rmse": "sqrt(avg(r * r))",
           "r2": "1 - sum(r * r) / (var_pop(y) * count(y))", "mape": "avg(abs(r / (y + 1e-8))) * 100",
           "max_error": "max(abs(r))", "mean_residual": "avg(r)", "std_residual": "stddev_pop(r)"}


def metric_sql(v: str, digits: int = 10) -> str:
    """Shares and coefficients by decimals, errors of any magnitude by significant digits."""
    return f"CASE WHEN abs({v}) < 1 THEN {R(v, digits - 1)} ELSE {S(v, digits)} END"


def metric_rounded(df, digits: int = 10):
    return df.withColumn("value", F.when(F.abs("value") < 1, rnd("value", digits - 1)).otherwise(sig("value", digits)))


def _hits_sql(tp="tp", fp="fp", fn="fn", tn="tn") -> dict[str, str]:
    """Classification metrics from the four counts; a ratio without cases is 0."""
    div = lambda a, b: f"coalesce(({a}) / nullif(({b})::DOUBLE, 0), 0)"
    f1 = lambda p, r: div(f"2 * {p} * {r}", f"{p} + {r}")
    p1, r1, p0, r0 = div(tp, f"{tp} + {fp}"), div(tp, f"{tp} + {fn}"), div(tn, f"{tn} + {fn}"), div(tn, f"{tn} + {fp}")
    mean = lambda one, zero: div(f"{one} * ({tp} + {fn}) + {zero} * ({tn} + {fp})",
                                 f"{tp} + {fp} + {fn} + {tn}")
    return {"accuracy": div(f"{tp} + {tn}", f"{tp} + {fp} + {fn} + {tn}"), "precision": p1, "recall": r1,
            "f1": f1(p1, r1), "specificity": r0, "balanced_accuracy": f"({r1} + {r0}) / 2",
            "weighted_precision": mean(p1, p0), "weighted_recall": mean(r1, r0),
            "weighted_f1": mean(f1(p1, r1), f1(p0, r0))}


@query("baseline_models", f"""WITH {_FORECAST_CTE},
i AS (SELECT ds, y, row_number() OVER (ORDER BY ds) <= floor(count(*) OVER () * 0.8::DOUBLE) AS train FROM f),
e AS (SELECT y, y - (SELECT avg(y) FROM i WHERE train) AS r FROM i WHERE NOT train),
g AS (SELECT {", ".join(f"{x} AS {n}" for n, x in _ERRORS.items())} FROM e),
{RFM_CTE.strip().replace("tx AS", "tx2 AS").replace("FROM tx", "FROM tx2")},
s AS (SELECT churn, {_STRATUM} >= 0.2 AS train FROM rfm),
p AS (SELECT churn, (SELECT churn FROM s WHERE train GROUP BY 1 ORDER BY count(*) DESC, churn LIMIT 1) AS mode
      FROM s WHERE NOT train),
k AS (SELECT count(*) FILTER (churn = 1 AND mode = 1) AS tp, count(*) FILTER (churn = 0 AND mode = 1) AS fp,
        count(*) FILTER (churn = 1 AND mode = 0) AS fn, count(*) FILTER (churn = 0 AND mode = 0) AS tn FROM p)
{" UNION ALL ".join([f"SELECT 'forecast' AS task, 'mean_baseline' AS model, '{n}' AS metric, {metric_sql(n)} AS value FROM g"
                     for n in _ERRORS] +
                    [f"SELECT 'churn', 'most_frequent', '{n}', {metric_sql('v')} FROM (SELECT {x} AS v FROM k)"
                     for n, x in _hits_sql().items()])}""", covers=("L4", "M9", "M11", "E1", "E3", "E4", "E5"))
def q_baseline_models(spark, sf_dir):
    return metric_rounded(J.baseline_job(spark, sf_dir))


def _linear_forecast_sql() -> str:
    steps, last, fit = least_squares_sql("i", J.FORECAST_NUMERIC, "y")
    each = lambda model: " UNION ALL ".join(
        f"SELECT 'forecast' AS task, '{model}' AS model, '{n}' AS metric, {metric_sql('v', 6)} AS value "
        f"FROM (SELECT {x} AS v FROM {model})" for n, x in _ERRORS.items())
    return f"""WITH {_FORECAST_CTE},
i AS (SELECT *, row_number() OVER (ORDER BY ds) <= floor(count(*) OVER () * 0.8::DOUBLE) AS train FROM f),
{steps},
v AS (SELECT y, train, {fit} AS fitted FROM {last}),
linear_regression AS (SELECT y, y - fitted AS r FROM v WHERE NOT train),
mean_baseline AS (SELECT y, y - (SELECT avg(y) FROM i WHERE train) AS r FROM i WHERE NOT train)
{each("linear_regression")} UNION ALL {each("mean_baseline")}"""


@query("forecast_linear", _linear_forecast_sql(), covers=("E20", "L1", "L4", "M9", "E1", "E2"))
def q_forecast_linear(spark, sf_dir):
    """The forecast pipeline with its exact model: every metric can be had from SQL."""
    return metric_rounded(J.forecast_job(spark, sf_dir, models=("linear_regression",)), 6)


@query("sampled_lines", f"""WITH tx AS ({tx_sql(_SAMPLE_COLS)})
SELECT transaction_id, line_number, product_id, supplier_id, {R("quantity")} AS quantity, {R("total_sales")} AS total_sales
FROM tx ORDER BY md5(concat_ws('|', transaction_id, line_number, product_id, supplier_id, '42')),
         transaction_id, line_number, product_id, supplier_id LIMIT 1000""", covers=("P14", "T6"))
def q_sampled_lines(spark, sf_dir):
    """A deterministic 1,000-line sample (hash order); the limit is the feature."""
    from ..operators.clean import sample_rows
    tx = transactions(spark, sf_dir, _SAMPLE_COLS)
    out = sample_rows(tx, 1000, ["transaction_id", "line_number", "product_id", "supplier_id"])
    return rounded(out, {"quantity": 4, "total_sales": 4})


def _cubic_sql() -> str:
    """Cubic fit by orthogonal polynomials: each is the last times u, made orthogonal to the two before."""
    steps = ["p1 AS (SELECT *, 1.0::DOUBLE AS q0, u - avg(u) OVER () AS q1 FROM u)"]
    for k in (2, 3):
        steps.append(f"""p{k} AS (SELECT *, (u - sum(u * q{k-1} * q{k-1}) OVER () / sum(q{k-1} * q{k-1}) OVER ()) * q{k-1}
  - sum(q{k-1} * q{k-1}) OVER () / sum(q{k-2} * q{k-2}) OVER () * q{k-2} AS q{k} FROM p{k-1})""")
    fit = " + ".join(f"sum(sales * q{k}) OVER () / sum(q{k} * q{k}) OVER () * q{k}" for k in range(4))
    return f"""WITH tx AS ({tx_sql(["transaction_date", "total_sales"])}),
m AS (SELECT month, sales, row_number() OVER (ORDER BY month) - 1 AS t FROM (
  SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month,
    CAST(sum(CAST(total_sales AS DECIMAL(18,4))) AS DOUBLE) AS sales
  FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1)),
u AS (SELECT *, (2.0 * t - min(t) OVER () - max(t) OVER ()) / (max(t) OVER () - min(t) OVER ()) AS u FROM m),
{", ".join(steps)},
v AS (SELECT month, t, sales, {fit} AS trend FROM p3)
SELECT month, CAST(t AS INTEGER) AS time_index, {R("sales")} AS sales, {S("trend", 8)} AS cubic_trend FROM v"""


@query("cubic_demand_trend", _cubic_sql(), covers=("A40", "A27"))
def q_cubic_demand_trend(spark, sf_dir):
    return sigd(rounded(J.cubic_trend_job(spark, sf_dir), {"sales": 4}), ["cubic_trend"], 8)


@query("series_forecasts", covers=("L12", "E26"))
def q_series_forecasts(spark, sf_dir):
    return J.series_forecasts_job(spark, sf_dir)


@query("series_forecast_moments", f"""WITH tx AS ({tx_sql([*J.SERIES, "transaction_date", "total_sales"])}),
d AS (SELECT region, market_segment, transaction_date AS ds, sum(total_sales) AS y FROM tx
      WHERE region IS NOT NULL AND market_segment IS NOT NULL AND transaction_date IS NOT NULL GROUP BY 1, 2, 3),
t AS (SELECT *, CAST(date_diff('day', min(ds) OVER (), ds) AS DOUBLE) AS t FROM d)
SELECT region, market_segment, count(*) AS n_days, {S("avg(y)", 6)} AS mean_fit, {S("avg(y * t)", 6)} AS trend_moment,
  {R("avg(y * sin(2 * pi() * t / 7)) / avg(y)", 5)} AS week_moment,
  {R("avg(y * cos(2 * pi() * t / 365.25)) / avg(y)", 5)} AS year_moment
FROM t GROUP BY 1, 2""", covers=("L12",))
def q_series_forecast_moments(spark, sf_dir):
    """What least squares must keep: the fit's moments with its own terms are those of the data."""
    f = J.series_forecasts_job(spark, sf_dir).where("y IS NOT NULL")
    t = F.datediff("ds", f.select(F.min("ds")).scalar()).cast("double")
    mean = F.avg("yhat")
    out = f.withColumn("t", t).groupBy(*J.SERIES).agg(
        F.count(F.lit(1)).alias("n_days"), mean.alias("mean_fit"), F.avg(F.col("yhat") * F.col("t")).alias("trend_moment"),
        (F.avg(F.col("yhat") * F.sin(2 * F.pi() * F.col("t") / 7)) / mean).alias("week_moment"),
        (F.avg(F.col("yhat") * F.cos(2 * F.pi() * F.col("t") / 365.25)) / mean).alias("year_moment"))
    return rounded(sigd(out, ["mean_fit", "trend_moment"], 6), {"week_moment": 5, "year_moment": 5})


_LINE_PART = f"{key_number_sql(['transaction_id', 'line_number', 'product_id', 'supplier_id'], 42)} / 4294967296.0"


@query("unknown_level_encoding", f"""WITH tx AS ({tx_sql(["transaction_id", "line_number", "product_id", "supplier_id",
                                                       "product_brand"])}),
x AS (SELECT product_brand, {_LINE_PART} >= 0.2 AS train FROM tx),
k AS (SELECT DISTINCT product_brand FROM x WHERE train AND product_brand IS NOT NULL)
SELECT CASE WHEN k.product_brand IS NULL THEN 'unknown' ELSE 'known' END AS level_kind, count(*) AS rows,
  CAST((SELECT count(*) FROM k) + 1 AS INTEGER) AS width
FROM x LEFT JOIN k USING (product_brand) WHERE NOT train GROUP BY 1""", covers=("M3", "M10"))
def q_unknown_level_encoding(spark, sf_dir):
    return J.unknown_level_job(spark, sf_dir)


@query("high_demand_tree", covers=("L8",))
def q_high_demand_tree(spark, sf_dir):
    return J.high_demand_job(spark, sf_dir)


@query("churn_svm_and_tree", covers=("L9", "L8", "E19"))
def q_churn_svm_and_tree(spark, sf_dir):
    return J.churn_job(spark, sf_dir, models=("linear_svc", "decision_tree"))
