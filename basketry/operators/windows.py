"""Order-based features.

Ordered windows always run per series key (customer, product, category,
…) over data that was first aggregated to the series grain (one row per
series and day), so a window partition holds at most one row per calendar
day of one series. A window with no series key (one global daily series)
runs in a single task; it is only applied to day-grain aggregates, whose
size is bounded by the calendar span, never to raw rows.

Every ordered window has a total order (the caller's order columns plus
tie-breakers), so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage


def _window(partition: Sequence[str], order: Sequence[str]):
    w = W.partitionBy(*partition) if partition else W.partitionBy()
    return w.orderBy(*order)


SPREAD, SPREAD_OVER = "_spread", 1024


def laid_out(df: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
    """Rows dealt by ``key``, and the columns that windows per ``key`` are to be partitioned by.

    Rows without a key belong to no group; they are spread over the tasks by a hash of the row.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD_OVER))).otherwise(F.lit(0))
    by = [key, SPREAD]
    return df.withColumn(SPREAD, spread.cast("int")).repartition(*by), by


# ---------------------------------------------------------------- W1–W3
def lag_features(df: DataFrame, value: str, lags: Sequence[int], order: Sequence[str],
                 partition: Sequence[str] = (), prefix: str = "lag") -> DataFrame:
    w = _window(partition, order)
    return df.withColumns({f"{prefix}_{n}": F.lag(value, n).over(w) for n in lags})


# ---------------------------------------------------------------- W4–W7
_STATS = {
    "mean": lambda c: F.avg(c),
    "std": lambda c: F.stddev_samp(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "median": lambda c: F.percentile(c, F.lit(0.5)),
    "sum": lambda c: F.sum(c),
}


def rolling_stats(df: DataFrame, value: str, windows: Sequence[int], order: Sequence[str],
                  partition: Sequence[str] = (), stats: Sequence[str] = ("mean", "std"),
                  shift: int = 0, prefix: str = "rolling") -> DataFrame:
    """Trailing n-row statistics, null until the window holds n non-null values.

    ``shift=1`` ends the window at the previous row (features that must not
    see the current target).
    """
    base = _window(partition, order)
    cols = {}
    for n in windows:
        frame = base.rowsBetween(-(n - 1) - shift, -shift)
        full = F.count(value).over(frame) == n
        for s in stats:
            name = f"{prefix}_{s}_{n}" if not shift else f"{prefix}_{s}_{n}_lag{shift}"
            cols[name] = F.when(full, _STATS[s](value).over(frame))
    return df.withColumns(cols)


def moving_average_signal(df: DataFrame, value: str, order: Sequence[str], n: int = 30,
                          partition: Sequence[str] = ()) -> DataFrame:
    """n-row moving average and volatility, plus ``value > MA`` as 0/1.

    Comparing with a null average (first n-1 rows) gives 0.
    """
    frame = _window(partition, order).rowsBetween(-(n - 1), 0)
    full = F.count(value).over(frame) == n
    out = df.withColumns({
        f"ma_{n}": F.when(full, F.avg(value).over(frame)),
        f"volatility_{n}": F.when(full, F.stddev_samp(value).over(frame)),
    })
    return out.withColumn("sentiment", F.coalesce((F.col(value) > F.col(f"ma_{n}")).cast("int"),
                                                  F.lit(0)))


# ---------------------------------------------------------------- W8
def days_between_purchases(df: DataFrame, customer="customer_id", date="transaction_date",
                           order: Sequence[str] = ("transaction_id",),
                           out: str = "days_between_purchases", by: Sequence[str] = ()) -> DataFrame:
    """Days since the customer's previous purchase day; 0 for the first purchase
    for further rows on the same day, and for rows without a customer or a date.

    Skew-safe form: rows are first reduced to distinct (customer, day) with the
    first row of each day (``min`` of a struct of the order columns, a partial
    aggregation). The lag runs over distinct days of one customer (bounded by
    the calendar), and the result is joined back on (customer, day). Rows that ``laid_out`` has dealt by
    ``by`` stay where they are: windows over ``by`` take the place of the join.
    """
    key = F.struct(*[F.col(c) for c in order])
    if by:
        first = (F.col(customer).isNotNull() & F.col(date).isNotNull()
                 & (key == F.min(key).over(W.partitionBy(*by, date))))
        keys = ", ".join(f"`{c}`" for c in by)
        earlier = F.expr(f"max(`{date}`) OVER (PARTITION BY {keys} ORDER BY `{date}` "
                         "RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '1' DAY PRECEDING)")
        return df.withColumn(out, F.when(first, F.coalesce(F.datediff(F.col(date), earlier), F.lit(0)))
                             .otherwise(F.lit(0)))
    days = (df.where(F.col(customer).isNotNull() & F.col(date).isNotNull())
              .groupBy(customer, date).agg(F.min(key).alias("_first")))
    w = W.partitionBy(customer).orderBy(date)
    days = days.withColumn("_gap", F.datediff(F.col(date), F.lag(date).over(w)))
    joined = df.join(days, [customer, date], "left")
    first = key == F.col("_first")
    return joined.withColumn(
        out, F.when(first, F.coalesce(F.col("_gap"), F.lit(0))).otherwise(F.lit(0))
    ).drop("_first", "_gap")


# ---------------------------------------------------------------- W10
def time_index(df: DataFrame, order: Sequence[str], partition: Sequence[str] = (),
               out: str = "time_index") -> DataFrame:
    """Contiguous 0-based index in order (``row_number() - 1``)."""
    return df.withColumn(out, F.row_number().over(_window(partition, order)) - 1)


# ---------------------------------------------------------------- W11
def top_n_per_group(df: DataFrame, group: str, value: str, n: int,
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows ranked 1..n by ``value`` desc within each group.

    Spark plans ``row_number() <= n`` as a per-partition group limit
    (WindowGroupLimit) before the shuffle, so only n rows per group and
    input partition cross the network, even for a hot group.
    """
    w = W.partitionBy(group).orderBy(F.desc(value), *[F.asc(c) for c in tiebreak])
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


# ---------------------------------------------------------------- W12
def best_per_group(df: DataFrame, group: str, metric: str, larger_is_better: bool = True,
                   tiebreak: str | None = None) -> DataFrame:
    """The row with the best metric per group, as a partial aggregation.

    ``max_by`` / ``min_by`` over a struct of all columns combines map-side,
    so a hot group never gathers in one task.
    """
    others = [c for c in df.columns if c != group]
    # the least of (metric, negated when larger is better; tiebreak; all other columns)
    m = -F.col(metric) if larger_is_better else F.col(metric)
    order = F.struct(m.alias("m"), *([F.col(tiebreak).alias("t")] if tiebreak else []),
                     *[c for c in others if c != tiebreak])
    best = (df.where(F.col(group).isNotNull() & F.col(metric).isNotNull())
              .groupBy(group).agg(F.min_by(F.struct(*others), order).alias("_best")))
    return best.select(group, *[F.col("_best")[c].alias(c) for c in others])


# ---------------------------------------------------------------- W13
def normalize_by_max(df: DataFrame, column: str, lower_is_better: bool = False,
                     out: str | None = None) -> DataFrame:
    """x / max(x), or 1 - x / max(x) for error metrics (max is a scalar subquery)."""
    out = out or f"{column}_norm"
    top = df.select(F.max(column)).scalar()
    ratio = F.try_divide(F.col(column), top)  # null when the maximum is 0
    return df.withColumn(out, (1 - ratio) if lower_is_better else ratio)


# ---------------------------------------------------------------- W16
def sliding_sequences(df: DataFrame, value: str, length: int, order: Sequence[str],
                      partition: Sequence[str] = ()) -> DataFrame:
    """(previous ``length`` values → current value) pairs; incomplete windows dropped."""
    frame = _window(partition, order).rowsBetween(-length, -1)
    seq = F.collect_list(value).over(frame)
    return (df.withColumn("sequence", seq)
              .where(F.size("sequence") == length)
              .withColumnRenamed(value, "target"))


# ---------------------------------------------------------------- W17
def min_max_scale(df: DataFrame, column: str, partition: Sequence[str] = (),
                  out: str | None = None) -> DataFrame:
    """(x - min) / (max - min), per series when ``partition`` is given.

    Per-series min/max are an aggregate joined back; the global form uses
    scalar subqueries.
    """
    out = out or f"{column}_scaled"
    if partition:
        keys = list(partition)
        mm = df.groupBy(*keys).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
        d = df.join(mm, keys, "left")
        lo, hi = F.col("_lo"), F.col("_hi")
    else:
        d = df
        lo = df.select(F.min(column)).scalar()
        hi = df.select(F.max(column)).scalar()
    scaled = F.when(hi == lo, F.lit(0.0)).otherwise((F.col(column) - lo) / (hi - lo))
    d = d.withColumn(out, scaled)
    return d.drop("_lo", "_hi") if partition else d


ROWS_PER_BUCKET = 500_000


def prefix_sums(df: DataFrame, order: str, values: Sequence[str], buckets: int | None = None,
                prefix: str = "cum", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Exclusive running sums of ``values`` in ascending ``order``, distributed.

    A running sum over a global order would put every row in one window
    partition. Instead rows are cut into ``buckets`` ranges of ``order`` by
    approximate quantiles (one scalar array); per-bucket totals (``buckets``
    rows) get their own running offset; each bucket then runs a local window.
    Rows with equal ``order`` values fall in the same bucket; the order must
    be unique per row for the running sum to be unambiguous (callers pass
    distinct keys, e.g. distinct scores) or ``tiebreak`` columns must make it so.
    Without ``buckets`` their number follows the row count, so a bucket stays a task's size.
    """
    if buckets is None:
        buckets = max(64, -(-df.count() // ROWS_PER_BUCKET))
    qs = [i / buckets for i in range(1, buckets)]
    # bucket bounds: a fixed-size quantile summary (``buckets`` - 1 numbers)
    bounds = sorted(set(df.approxQuantile(order, qs, 1.0 / (4 * buckets))))
    if not bounds:
        bucket = F.lit(0)
    else:
        arr = F.array(*[F.lit(float(b)) for b in bounds])
        bucket = F.size(F.filter(arr, lambda b: b < F.col(order).cast("double")))
    d = df.withColumn("_bk", bucket)
    tot = d.groupBy("_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    wb = W.orderBy("_bk").rowsBetween(W.unboundedPreceding, -1)
    off = tot.select("_bk", *[F.coalesce(F.sum(f"_t_{v}").over(wb), F.lit(0)).alias(f"_o_{v}")
                              for v in values])
    # at most ``buckets`` rows: a bounded broadcast
    d = d.join(F.broadcast(off), "_bk", "left")
    wl = W.partitionBy("_bk").orderBy(order, *tiebreak).rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumns({f"{prefix}_{v}": F.col(f"_o_{v}") + F.coalesce(F.sum(v).over(wl), F.lit(0))
                       for v in values})
    return d.drop("_bk", *[f"_o_{v}" for v in values])


def segmented_prefix_sums(df: DataFrame, by: Sequence[str], order: Sequence[str], values: Sequence[str],
                          prefix: str = "cum", rows: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exclusive running sums of ``values`` within each group of ``by``, in the order of ``order``.

    Rows are dealt by ranges of (by, order), so a group of any size spans as many tasks as it
    needs; each task adds up its own part of a group, and the parts' totals give the offsets. ``order``
    must be unique within a group for the sums to be unambiguous; it decides where ranges are cut, so
    equal rows stay together. Null is a group. Windows never see more than one range.
    """
    by, order = list(by), list(order)
    n = max(1, -(-df.count() // rows))
    d = cut_lineage(df.repartitionByRange(n, *by, *order).withColumn("_part", F.spark_partition_id()))
    totals = d.groupBy(*by, "_part").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"_b_{c}") for c in by], F.col("_part").alias("_p"),
                            *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}")
                              for v in values])
    same = F.col("_part") == F.col("_p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    local = W.partitionBy(*by, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = d.join(offsets, same).withColumns({
        f"{prefix}_{v}": F.col(f"_o_{v}") + F.coalesce(F.sum(v).over(local), F.lit(0)) for v in values})
    return out.drop("_part", "_p", *[f"_b_{c}" for c in by], *[f"_o_{v}" for v in values])


BROADCAST_RUNS = 100_000


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_RUNS) -> DataFrame:
    """``df`` written once, and broadcast if it has at most ``most`` rows."""
    df = cut_lineage(df)
    return F.broadcast(df) if df.count() <= most else df


def group_places(df: DataFrame, by: Sequence[str], orders: Mapping[str, Sequence[str]],
                 rows: int = ROWS_PER_BUCKET, size: int | None = None) -> DataFrame:
    """0-based place of every row in its group of ``by``, a column per named order.

    For each order the rows are dealt by ranges of (by, order) and numbered in their sorted range, so a group
    of any size spans as many tasks as it needs. The numbered rows are written once, after the last order;
    rows of a group in earlier ranges and the first number in the own range turn numbers
    into places. Null is a group. ``order`` must be unique within a group; ``size`` is the number of rows if known.
    """
    by = list(by)
    n = max(1, -(-(df.count() if size is None else size) // rows))
    d = df
    for name, order in orders.items():
        d = d.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order).withColumn(
            f"_no_{name}", F.monotonically_increasing_id())
    d = numbered = cut_lineage(d)
    for name in orders:
        no = F.col(f"_no_{name}")
        part = F.shiftright(no, 33)  # the range's number, above the row's number in it
        runs = numbered.groupBy(*by, part.alias("_part")).agg(
            F.min(no).alias("_first"), F.count(F.lit(1)).alias("_n"))
        before = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
        starts = runs.select(*[F.col(c).alias(f"_b_{c}") for c in by], "_part", (
            F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
        same = part == F.col("_part")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
        d = d.join(broadcast_if_small(starts), same).withColumn(name, no + F.col("_shift")).drop(
            "_part", "_shift", f"_no_{name}", *[f"_b_{c}" for c in by])
    return d
