"""Calendar columns, date spines and the US federal holiday dimension.

All of these are built-in Catalyst expressions (codegen, no Python). The
holiday dimension is generated from a year range with date rules, so it is
bounded by the calendar span (about 11–13 rows per year) — safe to broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- F1, F2, F5
def date_parts(date) -> dict[str, Column]:
    """year, month, day, quarter, day of year, ISO week, weekday (Mon=0), weekend."""
    d = _c(date)
    wd = F.weekday(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "quarter": F.quarter(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "day_of_week": wd,
        "is_weekend": F.when(wd >= 5, 1).when(wd.isNotNull(), 0),
    }


# ---------------------------------------------------------------- F3
def period_flags(date) -> dict[str, Column]:
    d = _c(date)
    as_int = lambda c: c.cast("int")
    return {
        "is_month_start": as_int(d == F.trunc(d, "month")),
        "is_month_end": as_int(d == F.last_day(d)),
        "is_quarter_start": as_int(d == F.trunc(d, "quarter")),
        "is_quarter_end": as_int(d == F.date_sub(F.add_months(F.trunc(d, "quarter"), 3), 1)),
    }


# ---------------------------------------------------------------- F4
def cyclic(value, period: float, name: str) -> dict[str, Column]:
    v = _c(value)
    ang = v * (2.0 * math.pi / period)
    return {f"{name}_sin": F.sin(ang), f"{name}_cos": F.cos(ang)}


def cyclic_calendar(date) -> dict[str, Column]:
    """sin/cos of month (12) and weekday (7)."""
    d = _c(date)
    return {**cyclic(F.month(d), 12, "month"), **cyclic(F.weekday(d), 7, "day_of_week")}


def cyclic_hour(ts) -> dict[str, Column]:
    """sin/cos of the hour of the day (24)."""
    return cyclic(F.hour(_c(ts)), 24, "hour")


# ---------------------------------------------------------------- F7, F8
def black_friday(year: Column) -> Column:
    """Day after the fourth Thursday of November."""
    return F.date_add(F.next_day(F.make_date(year, F.lit(10), F.lit(31)), "THU"), 22)


def season_flags(date) -> dict[str, Column]:
    d = _c(date)
    m, day = F.month(d), F.dayofmonth(d)
    return {
        "is_christmas_season": ((m == 12) & (day >= 15)).cast("int"),
        "is_new_year": ((m == 1) & (day <= 7)).cast("int"),
        "is_black_friday": (d == black_friday(F.year(d))).cast("int"),
    }


# ---------------------------------------------------------------- F9
def _nth_weekday(year: Column, month: int, weekday: str, n: int) -> Column:
    first = F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1), weekday)
    return F.date_add(first, 7 * (n - 1))


def _last_weekday(year: Column, month: int, last_day: int, weekday: str) -> Column:
    return F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(last_day)), 7), weekday)


def _observed(d: Column) -> Column:
    """Saturday → Friday before, Sunday → Monday after."""
    wd = F.weekday(d)
    return (F.when(wd == 5, F.date_sub(d, 1)).when(wd == 6, F.date_add(d, 1)).otherwise(d))


# US federal holidays (name, rule) as used by the US calendar.
_FIXED = [("New Year's Day", 1, 1, None), ("Juneteenth National Independence Day", 6, 19, 2021),
          ("Independence Day", 7, 4, None), ("Veterans Day", 11, 11, None),
          ("Christmas Day", 12, 25, None)]
_FLOATING = [("Martin Luther King Jr. Day", 1, "MON", 3, 1986),
             ("Washington's Birthday", 2, "MON", 3, None),
             ("Labor Day", 9, "MON", 1, None), ("Columbus Day", 10, "MON", 2, None),
             ("Thanksgiving", 11, "THU", 4, None)]


def us_holidays(years: DataFrame, year: str = "year") -> DataFrame:
    """US federal holidays (actual and observed dates) for each year in ``years``.

    ``years`` is a one-column frame of years (e.g. derived from the data's
    date range). Output: (holiday_date date, holiday string).
    """
    y = F.col(year)
    parts = []
    for name, m, d, since in _FIXED:
        actual = F.make_date(y, F.lit(m), F.lit(d))
        cond = F.lit(True) if since is None else (y >= since)
        parts.append(F.when(cond, F.struct(actual.alias("holiday_date"), F.lit(name).alias("holiday"))))
        parts.append(F.when(cond & (_observed(actual) != actual),
                            F.struct(_observed(actual).alias("holiday_date"),
                                     F.lit(f"{name} (observed)").alias("holiday"))))
    for name, m, wd, n, since in _FLOATING:
        cond = F.lit(True) if since is None else (y >= since)
        parts.append(F.when(cond, F.struct(_nth_weekday(y, m, wd, n).alias("holiday_date"),
                                           F.lit(name).alias("holiday"))))
    parts.append(F.struct(_last_weekday(y, 5, 31, "MON").alias("holiday_date"),
                          F.lit("Memorial Day").alias("holiday")))
    exploded = years.select(F.explode(F.array(*parts)).alias("h")).where(F.col("h").isNotNull())
    return exploded.select("h.holiday_date", "h.holiday").distinct()


def years_of(df: DataFrame, date: str, pad: int = 1) -> DataFrame:
    """Years spanned by ``df[date]`` (± pad) as a one-column frame, from min/max."""
    lo = df.select(F.min(F.year(date))).scalar()
    hi = df.select(F.max(F.year(date))).scalar()
    spark = df.sparkSession
    return spark.range(1).select(F.explode(F.sequence(lo - pad, hi + pad)).alias("year"))


# ---------------------------------------------------------------- spines
def date_spine(df: DataFrame, date: str, step: str = "day", out: str = "ds") -> DataFrame:
    """Every day / month start / week (Monday) between the min and max of ``df[date]``.

    The bounds are scalar subqueries; the sequence length is the calendar
    span, independent of the data volume.
    """
    unit = {"day": "day", "month": "month", "week": "week"}[step]
    lo = F.date_trunc(unit, df.select(F.min(date)).scalar()).cast("date")
    hi = F.date_trunc(unit, df.select(F.max(date)).scalar()).cast("date")
    interval = {"day": F.expr("INTERVAL 1 DAY"), "month": F.expr("INTERVAL 1 MONTH"),
                "week": F.expr("INTERVAL 7 DAYS")}[step]
    return df.sparkSession.range(1).select(F.explode(F.sequence(lo, hi, interval)).alias(out))


def week_ending_sunday(date) -> Column:
    """Sunday on or after the date (label of a W-SUN weekly bin)."""
    return F.next_day(F.date_sub(_c(date), 1), "SUN")
