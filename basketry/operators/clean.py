"""Projection, typing, filling and filtering.

All column work is expressed with built-in functions; data-wide values
(means, percentiles) are single aggregations that Spark evaluates once as
scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The four column groups of the wide retail table.
CUSTOMER_COLS = ["customer_id", "age", "gender", "income_bracket", "loyalty_program",
                 "membership_years", "churn", "marital_status", "number_of_children",
                 "education_level", "occupation", "transactions_count", "average_spent",
                 "days_since_last_purchase", "email_subscriptions", "app_usage",
                 "website_visits", "social_media_engagement"]
PRODUCT_COLS = ["product_id", "product_category", "unit_price", "product_name", "product_brand",
                "product_rating", "product_review_count", "product_stock",
                "product_return_rate", "product_size", "product_weight", "product_color",
                "product_material", "product_manufacture_date", "product_expiry_date",
                "product_shelf_life"]
STORE_COLS = ["store_zip_code", "store_city", "store_state", "distance_to_store",
              "holiday_season", "season", "weekend"]
# the transaction slice is every remaining column of the wide table


def split_tables(df: DataFrame, dedupe: bool = True) -> dict[str, DataFrame]:
    """Customer / product / transaction / store projections of a wide table.

    Only the columns present are kept; ``dedupe`` makes real dimensions
    (one row per key) with ``dropDuplicates``.
    """
    have = set(df.columns)
    cust = [c for c in CUSTOMER_COLS if c in have]
    prod = [c for c in PRODUCT_COLS if c in have]
    store = [c for c in STORE_COLS if c in have]
    dims = set(cust) | set(prod) | set(store)
    txn = [c for c in df.columns if c not in dims or c in ("customer_id", "product_id")]
    out = {"customer": df.select(*cust), "product": df.select(*prod),
           "transaction": df.select(*txn), "store": df.select(*store)}
    if dedupe:
        if "customer_id" in cust:
            out["customer"] = out["customer"].dropDuplicates(["customer_id"])
        if "product_id" in prod:
            out["product"] = out["product"].dropDuplicates(["product_id"])
    return out


def yes_no_flag(col) -> Column:
    """'Yes' → 1, anything else → 0."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == "Yes", 1).otherwise(0)


def clean_types(df: DataFrame, double_cols: Sequence[str] = (), date_cols: Sequence[str] = (),
                date_format: str = "M-d-yyyy") -> DataFrame:
    """Cast to double and parse text dates; bad values become null."""
    cols = {c: F.col(c).try_cast("double") for c in double_cols if c in df.columns}
    cols.update({c: F.try_to_date(F.col(c).cast("string"), date_format)
                 for c in date_cols if c in df.columns})
    return df.withColumns(cols)


def convert_date_format(df: DataFrame, date_cols: Sequence[str], source: str = "M-d-yyyy",
                        target: str = "yyyy-MM-dd") -> DataFrame:
    """Reformat text dates (P4); unparseable text becomes null."""
    return df.withColumns({c: F.date_format(F.try_to_date(F.col(c), source), target)
                           for c in date_cols if c in df.columns})


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of numeric columns (P15), schema-driven."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def impute_mean(df: DataFrame, cols: Sequence[str] | None = None, suffix: str = "_imputed") -> DataFrame:
    """Add ``<c>_imputed`` = c with null / NaN replaced by the column mean (P5).

    One column: the mean is a scalar subquery. Several columns: one
    aggregation whose summary row (one mean per column) becomes literals.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    if not cols:
        return df
    means = df.agg(*[F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c)))
                     .alias(c) for c in cols])
    row = means.first() if len(cols) > 1 else None
    out = {}
    for c in cols:
        m = means.select(c).scalar() if row is None else F.lit(row[c])
        missing = F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
        out[f"{c}{suffix}"] = F.when(missing, m).otherwise(F.col(c).cast("double"))
    return df.withColumns(out)


def fit_mean_imputer(train: DataFrame, cols: Sequence[str], suffix: str = "_imputed"):
    """Spark ML Imputer fitted on train only; apply ``.transform`` to test."""
    imp = Imputer(strategy="mean", inputCols=list(cols),
                  outputCols=[f"{c}{suffix}" for c in cols])
    return imp.fit(train.withColumns({c: F.col(c).cast("double") for c in cols}))


def fill_unknown(df: DataFrame, cols: Sequence[str] | None = None, value: str = "Unknown") -> DataFrame:
    """Constant fill for string columns."""
    cols = list(cols) if cols is not None else string_columns(df)
    return df.na.fill(value, subset=cols) if cols else df


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Numeric nulls → 0."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return df.na.fill(0, subset=cols) if cols else df


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with any null in ``subset`` (all columns by default) removed."""
    return df.dropna(subset=list(subset) if subset else None)


def range_filter(df: DataFrame, bounds: Mapping[str, float]) -> DataFrame:
    """Keep rows with every column ≤ its bound."""
    cond = F.lit(True)
    for c, hi in bounds.items():
        cond = cond & (F.col(c) <= hi)
    return df.where(cond)


def quantile_bounds(df: DataFrame, col: str, low: float = 0.01, high: float = 0.99,
                    exact: bool = False, accuracy: int = 100000) -> tuple[Column, Column]:
    """Two quantiles of a column as scalar-subquery columns.

    ``exact`` uses ``percentile`` (linear interpolation like pandas); its
    buffer is a map of distinct value → count, so use it on bounded-domain
    columns. Otherwise ``percentile_approx`` keeps a fixed-size sketch.
    """
    if exact:
        q = F.percentile(col, F.array(F.lit(low), F.lit(high)))
    else:
        q = F.percentile_approx(col, [low, high], accuracy)
    row = df.select(q.alias("q"))
    return row.select(F.col("q")[0]).scalar(), row.select(F.col("q")[1]).scalar()


def winsorize(df: DataFrame, cols: Sequence[str], low: float = 0.01, high: float = 0.99,
              exact: bool = False) -> DataFrame:
    """Clip each column to its [low, high] quantiles."""
    out = {}
    for c in cols:
        lo, hi = quantile_bounds(df, c, low, high, exact=exact)
        out[c] = F.least(F.greatest(F.col(c), lo), hi)
    return df.withColumns(out)


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Deterministic sample of n rows: smallest MD5 of the key.

    Spark plans ``orderBy(...).limit(n)`` as a per-partition top-n followed
    by a merge of n rows per partition (TakeOrderedAndProject).
    """
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    return df.orderBy(h, *key).limit(n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(col).distinct()


def risk_tier(p) -> Column:
    """> 0.7 High, > 0.3 Medium, else Low."""
    c = F.col(p) if isinstance(p, str) else p
    return F.when(c > 0.7, "High").when(c > 0.3, "Medium").when(c.isNotNull(), "Low")


def ordinal_level(col, levels: Sequence[str] = ("Low", "Medium", "High")) -> Column:
    """Level i (1-based) of ``levels``, anything else 0."""
    c = F.col(col) if isinstance(col, str) else col
    e = F.lit(0)
    for i, lv in reversed(list(enumerate(levels, start=1))):
        e = F.when(c == lv, i).otherwise(e)
    return e


# Model quality targets (metric → minimum value).
QUALITY_TARGETS = {"r2": 0.85, "f1": 0.85, "accuracy": 0.90, "precision": 0.85,
                   "recall": 0.85, "silhouette": 0.6}


# Error metrics and the largest value that passes.
QUALITY_LIMITS = {"rmse": 0.15}


def quality_gate(metrics: DataFrame, targets: Mapping[str, float] | None = None,
                 metric: str = "metric", value: str = "value",
                 at_most: bool = False) -> DataFrame:
    """Join a long metrics table with thresholds; flag pass / fail (P20).

    Thresholds are minimum values, or with ``at_most`` (error metrics) maximum values. The
    thresholds table is a handful of fixed rows, broadcast.
    """
    t = targets or (QUALITY_LIMITS if at_most else QUALITY_TARGETS)
    spark = metrics.sparkSession
    th = spark.createDataFrame([(k, float(v)) for k, v in t.items()],
                               "metric string, threshold double").withColumnRenamed("metric", metric)
    return (metrics.join(F.broadcast(th), metric, "inner")
                   .withColumn("passed", ((F.col(value) <= F.col("threshold")) if at_most else
                                          (F.col(value) >= F.col("threshold"))).cast("int")))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """coalesce(c, default) per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def rename_drop(df: DataFrame, rename: Mapping[str, str] | None = None,
                drop: Sequence[str] = ()) -> DataFrame:
    """Rename and drop columns."""
    out = df.withColumnsRenamed(dict(rename or {}))
    return out.drop(*drop) if drop else out


def series_with_min_length(df: DataFrame, keys: Sequence[str], min_points: int,
                           value: str | None = None) -> DataFrame:
    """Rows of series with at least ``min_points`` observations.

    Count per series is a partial aggregation; the kept keys are applied
    with a semi join, so no series is held in one window partition.
    """
    keys = list(keys)
    cnt = F.count(value) if value else F.count(F.lit(1))
    ok = df.groupBy(*keys).agg(cnt.alias("_n")).where(F.col("_n") >= min_points).select(*keys)
    return df.join(ok, keys, "left_semi")
