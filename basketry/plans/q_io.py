"""Source / sink and streaming queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.clean import rename_drop
from ..sources import files as IO
from ..sources.tables import transactions, tx_sql
from ..streaming.channel_stream import run_to_files, utc_text
from .registry import R, query, rounded

_TX = tx_sql(["product_category", "channel", "quantity", "total_sales"])


@query("csv_roundtrip_category_sales", f"""WITH tx AS ({_TX})
SELECT product_category, channel, {R("sum(quantity)")} AS quantity, {R("sum(total_sales)")} AS sales
FROM tx GROUP BY 1, 2""", covers=("IO1", "IO2", "IO3", "IO5", "IO6", "P22"))
def q_csv_roundtrip_category_sales(spark, sf_dir):
    """Write transaction lines as CSV to shared storage, read them back with an
    explicit schema, rename and drop columns, aggregate."""
    tx = transactions(spark, sf_dir, ["product_category", "channel", "quantity", "total_sales",
                                      "unit_price"])
    path = IO.shared_path(spark, "io", f"tx-{uuid.uuid4().hex}")
    IO.write_table(tx, path, fmt="csv")
    schema = ("product_category string, channel string, quantity double, total_sales double, "
              "unit_price double")
    from pyspark.sql.types import _parse_datatype_string
    back = IO.read_csv(spark, path, schema=_parse_datatype_string(schema))
    back = rename_drop(back, {"total_sales": "sales"}, drop=["unit_price"])
    out = back.groupBy("product_category", "channel").agg(
        F.sum("quantity").alias("quantity"), F.sum("sales").alias("sales"))
    return rounded(out, {"quantity": 4, "sales": 4})


@query("parquet_roundtrip_daily_sales", f"""WITH tx AS ({tx_sql(["transaction_date", "total_sales"])})
SELECT CAST(year(transaction_date) AS INTEGER) AS year, transaction_date AS ds,
       {R("sum(total_sales)")} AS y FROM tx WHERE transaction_date IS NOT NULL GROUP BY 1, 2""",
       covers=("IO4", "IO6"))
def q_parquet_roundtrip_daily_sales(spark, sf_dir):
    """Daily sales written as parquet partitioned by year, read back with a
    partition filter-free scan."""
    from ..operators.aggregates import daily_sales
    d = daily_sales(transactions(spark, sf_dir, ["transaction_date", "total_sales"]))
    d = d.withColumn("year", F.year("ds"))
    path = IO.shared_path(spark, "io", f"daily-{uuid.uuid4().hex}")
    IO.write_table(d, path, fmt="parquet", partition_by=["year"])
    back = IO.read_parquet(spark, path)
    return rounded(back.select(F.col("year").cast("int").alias("year"), "ds", "y"), {"y": 4})


@query("streaming_hourly_event_sales", f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
       {R("sum(value)")} AS sales, CAST(count(*) AS BIGINT) AS events
FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2""", covers=("A15",))
def q_streaming_hourly_event_sales(spark, sf_dir):
    """Replay the events file through the Structured Streaming query."""
    name = f"hourly_{uuid.uuid4().hex[:12]}"
    ckpt = IO.shared_path(spark, "streams", name)
    t = run_to_files(spark, sf_dir, ckpt, IO.shared_path(spark, "io", name), glob="events.parquet")
    out = t.select(utc_text(spark, F.col("w.start")).alias("window_start"),
                   "event_type", "sales", "events")
    return rounded(out, {"sales": 4})
