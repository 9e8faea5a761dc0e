"""Registry of named queries: a Spark builder and (optionally) its SQL oracle.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
given tables. The oracle is DuckDB SQL over the same tables, with the same
column names and the same rounding.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, covers: tuple[str, ...] = ()):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, covers)
        return fn
    return deco


# Values are rounded for comparison with the SQL oracle. Averages of
# fixed-point money values often land exactly on a rounding tie, where the
# last-bit noise of a different summation order decides the direction. A
# nudge away from zero of min(|x|·1e-11, 1e-7) — far above that noise, far
# below the 5e-5 margin of an exact 4-decimal sum — makes both engines round
# ties the same way without disturbing exact sums of any magnitude.
NUDGE = 1.00000000001


def _nudged(col: Column) -> Column:
    return col + F.signum(col) * F.least(F.abs(col) * F.lit(1e-11), F.lit(1e-7))


def rnd(c, digits: int = 4) -> Column:
    """Round a double column (oracles use ``R()``, the same formula)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(_nudged(col), digits)


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: rnd(c, d) for c, d in digits.items()})


def R(expr: str, digits: int = 4) -> str:
    """SQL text of ``rnd``."""
    return f"ROUND(({expr}) + sign({expr}) * least(abs({expr}) * 1e-11, 1e-7), {digits})"


def sig(c, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits (for metrics of any magnitude)."""
    col = F.col(c) if isinstance(c, str) else c
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(col))))
    return F.when(col == 0, F.lit(0.0)).otherwise(
        F.round(col / scale * F.lit(NUDGE), digits - 1) * scale)


def sigd(df: DataFrame, cols, digits: int = 10) -> DataFrame:
    return df.withColumns({c: sig(c, digits) for c in cols})


def S(expr: str, digits: int = 10) -> str:
    """SQL text of ``sig``."""
    scale = f"pow(10.0, floor(log10(abs({expr}))))"
    return (f"CASE WHEN ({expr}) = 0 THEN 0.0 ELSE "
            f"ROUND(({expr}) / {scale} * CAST({NUDGE!r} AS DOUBLE), {digits - 1}) * {scale} END")
