"""Joins beyond plain equi-joins.

* Range join (J8, distance to the nearest holiday within N days) is an
  equi-join on a month bucket plus a filter: each distinct date is paired
  with the holidays of its own and neighbouring months only, never with the
  whole holiday table.
* The holiday dimension is bounded by the calendar span and broadcast.
* Per-date results are computed on distinct dates, then joined back to
  the rows on the date key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _month_no(d):
    return F.year(d) * 12 + F.month(d)


def holiday_distance(dates: DataFrame, holidays: DataFrame, date: str = "ds",
                     max_days: int = 30, out: str = "days_to_holiday") -> DataFrame:
    """Per distinct date: min |date − holiday| over holidays within ``max_days``,
    else ``max_days``.

    Bucket equi-join: a date meets holidays in the months that can lie within
    ``max_days`` (span = ceil(max_days/28) months each side).
    """
    span = -(-max_days // 28)
    d = dates.select(date).where(F.col(date).isNotNull()).distinct()
    cand = d.withColumn("_m", F.explode(F.sequence(_month_no(F.col(date)) - span,
                                                   _month_no(F.col(date)) + span)))
    h = holidays.select(F.col("holiday_date"), _month_no(F.col("holiday_date")).alias("_m"))
    near = (cand.join(F.broadcast(h), "_m")
                .select(date, F.abs(F.datediff(F.col(date), F.col("holiday_date"))).alias("_dist"))
                .where(F.col("_dist") <= max_days)
                .groupBy(date).agg(F.min("_dist").alias("_dist")))
    return (d.join(near, date, "left")
             .select(date, F.coalesce(F.col("_dist"), F.lit(max_days)).alias(out)))


def holiday_flag(df: DataFrame, holidays: DataFrame, date: str,
                 out: str = "is_holiday") -> DataFrame:
    """Rows with 1 when their date is a holiday (left join to the broadcast dim)."""
    h = holidays.select(F.col("holiday_date").alias("_hd")).distinct()
    j = df.join(F.broadcast(h), F.col(date) == F.col("_hd"), "left")
    return j.withColumn(out, F.col("_hd").isNotNull().cast("int")).drop("_hd")


def asof_fill(spine: DataFrame, values: DataFrame, date: str, columns: Sequence[str],
              partition: Sequence[str] = ()) -> DataFrame:
    """Regular date grid with each column forward-filled from the last known value.

    ``spine`` holds every date of the grid; ``values`` has values on some
    dates. Forward fill is ``last(ignorenulls=True)`` over the date order
    (as-of by date, not by row order).
    """
    keys = [*partition, date]
    grid = spine.join(values.select(*keys, *columns), keys, "left")
    w = (W.partitionBy(*partition) if partition else W.partitionBy()).orderBy(date) \
        .rowsBetween(W.unboundedPreceding, 0)
    return grid.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def attach_by_date(df: DataFrame, daily: DataFrame, date: str, daily_date: str = "ds") -> DataFrame:
    """Rows ⟕ a day-grain table (one row per date: bounded by the calendar, so broadcast)."""
    d = daily.withColumnRenamed(daily_date, "_jd")
    return df.join(F.broadcast(d), F.col(date) == F.col("_jd"), "left").drop("_jd")
