"""File sources and sinks.

CSV is read with an explicit schema (no inference pass over the data);
a missing source fails fast with a clear message; results are written with
``DataFrame.write`` to the shared storage the cluster names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()

# The wide retail transaction file (one row per transaction).
# Dates stay text here; ``operators.clean.clean_types`` parses them.
RETAIL_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("customer_id", _S), ("age", _I), ("gender", _S), ("income_bracket", _S),
    ("loyalty_program", _S), ("membership_years", _I), ("churn", _S), ("marital_status", _S),
    ("number_of_children", _I), ("education_level", _S), ("occupation", _S),
    ("transaction_id", _S), ("transaction_date", _S), ("product_id", _S),
    ("product_category", _S), ("quantity", _D), ("unit_price", _D), ("discount_applied", _D),
    ("payment_method", _S), ("store_location", _S), ("transaction_hour", _I),
    ("day_of_week", _S), ("week_of_year", _I), ("month_of_year", _I),
    ("avg_purchase_value", _D), ("purchase_frequency", _S), ("last_purchase_date", _S),
    ("avg_discount_used", _D), ("preferred_store", _S), ("online_purchases", _I),
    ("in_store_purchases", _I), ("avg_items_per_transaction", _D), ("avg_transaction_value", _D),
    ("total_returned_items", _I), ("total_returned_value", _D), ("total_sales", _D),
    ("total_transactions", _I), ("total_items_purchased", _D), ("total_discounts_received", _D),
    ("avg_spent_per_category", _D), ("max_single_purchase_value", _D),
    ("min_single_purchase_value", _D), ("product_name", _S), ("product_brand", _S),
    ("product_rating", _D), ("product_review_count", _I), ("product_stock", _I),
    ("product_return_rate", _D), ("product_size", _S), ("product_weight", _D),
    ("product_color", _S), ("product_material", _S), ("product_manufacture_date", _S),
    ("product_expiry_date", _S), ("product_shelf_life", _I), ("promotion_id", _S),
    ("promotion_type", _S), ("promotion_start_date", _S), ("promotion_end_date", _S),
    ("promotion_effectiveness", _S), ("promotion_channel", _S), ("promotion_target_audience", _S),
    ("customer_zip_code", _S), ("customer_city", _S), ("customer_state", _S),
    ("store_zip_code", _S), ("store_city", _S), ("store_state", _S), ("economic_indicator", _S),
    ("weather_conditions", _S), ("local_events", _S), ("holiday_season", _S), ("season", _S),
    ("weekend", _S), ("customer_support_calls", _I), ("email_subscriptions", _S),
    ("app_usage", _S), ("website_visits", _I), ("social_media_engagement", _S),
    ("days_since_last_purchase", _I), ("distance_to_store", _D)]])


def schema_for(columns: Sequence[str], base: T.StructType = RETAIL_SCHEMA) -> T.StructType:
    """The declared types of ``columns``, in file order (CSV binds by position)."""
    by_name = {f.name: f for f in base.fields}
    return T.StructType([by_name[c] for c in columns])


class SourceMissing(FileNotFoundError):
    pass


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, date_format: str | None = None) -> DataFrame:
    """CSV with a declared schema (IO1–IO3); no inference scan."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if date_format:
        r = r.option("dateFormat", date_format)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
    return _checked(lambda: r.csv(path), path)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet scan (IO4); filters and projections push down to the reader."""
    paths = [path] if isinstance(path, str) else list(path)
    return _checked(lambda: spark.read.parquet(*paths), ", ".join(paths))


def _checked(load, path: str) -> DataFrame:
    """Existence check (IO5): a missing source is a clear error at load time."""
    try:
        return load()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SourceMissing(f"data source not found: {path}") from e
        raise


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), header: bool = True) -> str:
    """Write a result table (IO6, IO7) as parquet, csv or json."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", header).csv(path)
    elif fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt}")
    return path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the cluster's shared checkpoint folder (never machine-local)."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])
