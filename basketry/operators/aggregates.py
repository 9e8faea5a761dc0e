"""Grouped aggregations.

Every operator takes a DataFrame and column names and returns a lazy
DataFrame. Rules followed throughout:

* one ``groupBy().agg()`` per key, never several aggregations joined back
  (Spark does map-side partial aggregation, so a hot key is pre-combined
  on every mapper before the shuffle);
* null group keys are dropped before grouping (pandas ``groupby`` drops
  them), aggregates skip nulls;
* a data-wide scalar (max date, global count) is a scalar subquery
  (``DataFrame.scalar()``), evaluated once and inlined as a literal, not a
  ``collect()`` on the driver and not a cross join;
* "rows with a group value attached" use aggregate-then-join, so a hot key
  is combined map-side rather than held as one window partition; the
  joined aggregate has one row per key and AQE splits a skewed fact side.
  Operators with ``by`` also serve rows that are dealt by that key already: there a window saves
  moving every line once more, and a hot key is one (spilling) window partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage


def _keys_not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def scalar_of(df: DataFrame, expr: Column) -> Column:
    """A one-value aggregate of ``df`` usable as a column anywhere."""
    return df.select(expr).scalar()


def _mean_of_sums(name: str) -> Column:
    """Mean of values that were added up before, as ``name`` (sum) and ``<name>_n`` (count)."""
    return F.try_divide(F.sum(name).cast("double"), F.sum(f"{name}_n"))


def attach_group_stats(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Rows of ``df`` with per-group aggregates added (left join back)."""
    keys = list(keys)
    stats = _keys_not_null(df, keys).groupBy(*keys).agg(*aggs)
    return df.join(stats, on=keys, how="left")


def _group_values(df: DataFrame, key: str, by: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Aggregates per ``key``; with ``by`` all rows, dealt by ``windows.laid_out``, with those of their key (null
    for rows without it)."""
    if not by:
        return _keys_not_null(df, [key]).groupBy(key).agg(*[v.alias(n) for n, v in values.items()])
    w = W.partitionBy(*by)
    return df.withColumns({n: F.when(F.col(key).isNotNull(), v.over(w)) for n, v in values.items()})


# ---------------------------------------------------------------- A1, P17
def rfm(df: DataFrame, customer="customer_id", date="transaction_date",
        amount="total_sales", txn="transaction_id", churn_days=90,
        line_count: str | None = None, as_of: Column | None = None,
        extra: Sequence[Column] = ()) -> DataFrame:
    """Recency, frequency, monetary, tenure and a recency churn label.

    ``line_count`` lets a caller pass pre-aggregated rows (e.g. one row per
    order with its number of lines) — frequency is then its sum.
    ``as_of`` defaults to the latest date in the data: the customer-grain result is written
    once, and the date is taken from it, so the rows are read once. ``extra`` aggregates join
    the same pass.
    """
    freq = F.sum(line_count) if line_count else F.count(txn)
    g = df.groupBy(customer).agg(
        F.max(date).alias("last_purchase"),
        F.min(date).alias("first_purchase"),
        freq.cast("long").alias("frequency"),
        F.sum(amount).cast("double").alias("monetary"), *extra)
    if as_of is None:
        g = cut_lineage(g)
        as_of = scalar_of(g, F.max("last_purchase"))  # rows without a customer count, too
    ref, g = as_of, _keys_not_null(g, [customer])
    return (g.withColumn("recency", F.datediff(ref, F.col("last_purchase")))
             .withColumn("tenure", F.datediff(ref, F.col("first_purchase")))
             .withColumn("churn", F.when(F.col("recency") > churn_days, 1).otherwise(0)))


# ---------------------------------------------------------------- A2
def customer_metrics(df: DataFrame, customer="customer_id", date="transaction_date",
                     quantity="quantity", price="unit_price", txn="transaction_id",
                     as_of: Column | None = None, line_count: str | None = None,
                     spent: str | None = None) -> DataFrame:
    """Transactions count, mean spend per line, days since first and last purchase.

    ``line_count`` and ``spent`` (with ``<spent>_n``) let a caller pass rows that were added up per order.
    """
    ref = as_of if as_of is not None else scalar_of(df, F.max(date))
    mean = _mean_of_sums(spent) if spent else F.avg(F.col(quantity) * F.col(price))
    return (_keys_not_null(df, [customer]).groupBy(customer).agg(
        (F.sum(line_count) if line_count else F.count(txn)).alias("transactions_count"),
        mean.alias("average_spent"),
        F.datediff(ref, F.min(date)).alias("days_since_first_purchase"),
        F.datediff(ref, F.max(date)).alias("days_since_last_purchase")))


# ---------------------------------------------------------------- A3
def monthly_sales(df: DataFrame, date="transaction_date", quantity="quantity",
                  price="unit_price") -> DataFrame:
    month = F.date_format(date, "yyyy-MM")
    return (df.where(F.col(date).isNotNull()).groupBy(month.alias("month"))
              .agg(F.sum(F.col(quantity) * F.col(price)).alias("sales"))
              .orderBy("month"))


# ---------------------------------------------------------------- A4
def basket_size(df: DataFrame, txn="transaction_id", quantity="quantity",
                price="unit_price", formula="product_of_sums") -> DataFrame:
    """Mean basket size over transactions.

    ``product_of_sums`` is sum(q)·sum(p) per transaction (as the reference
    computes it); ``sum_of_products`` is sum(q·p).
    """
    if formula == "product_of_sums":
        per = F.sum(quantity) * F.sum(price)
    elif formula == "sum_of_products":
        per = F.sum(F.col(quantity) * F.col(price))
    else:
        raise ValueError(formula)
    per_txn = _keys_not_null(df, [txn]).groupBy(txn).agg(per.alias("basket"))
    return per_txn.agg(F.avg("basket").alias("avg_basket_size"))


# ---------------------------------------------------------------- A5
def product_metrics(df: DataFrame, product="product_id", quantity="quantity",
                    price="unit_price") -> DataFrame:
    return (_keys_not_null(df, [product]).groupBy(product).agg(
        F.sum(quantity).alias("total_quantity_sold"),
        F.sum(F.col(quantity) * F.col(price)).alias("total_revenue"),
        F.avg(price).alias("avg_price")))


# ---------------------------------------------------------------- A6
def items_per_transaction(df: DataFrame, txn="transaction_id", quantity="quantity",
                          name="avg_items_per_transaction") -> DataFrame:
    """Rows with the item count of their transaction attached."""
    return attach_group_stats(df, [txn], [F.sum(quantity).alias(name)])


def product_promo_metrics(df: DataFrame, product="product_id", sales="total_sales",
                          quantity="quantity", discount="discount_applied",
                          items="avg_items_per_transaction") -> DataFrame:
    """Per product: total sales, quantity, mean discount, mean items per txn.

    Products with any null metric are dropped (as ``dropna`` does).
    """
    out = (_keys_not_null(df, [product]).groupBy(product).agg(
        F.sum(sales).alias("total_sales"),
        F.sum(quantity).alias("total_quantity"),
        F.avg(discount).alias("avg_discount"),
        F.avg(items).alias("avg_items_per_txn")))
    return out.dropna()


# ---------------------------------------------------------------- A7
def customer_feature_stats(df: DataFrame, customer="customer_id", sales="total_sales",
                           quantity="quantity", discount="discount_applied",
                           date="transaction_date", by: Sequence[str] = ()) -> DataFrame:
    """Per customer stats. With ``by`` the rows, dealt by ``windows.laid_out``, get those of their customer."""
    p = "customer_"
    g = _group_values(df, customer, by, {
        f"{p}total_sales_sum": F.sum(sales),
        f"{p}total_sales_mean": F.avg(sales),
        f"{p}total_sales_std": F.stddev_samp(sales),
        f"{p}total_sales_count": F.count(sales),
        f"{p}quantity_sum": F.sum(quantity),
        f"{p}quantity_mean": F.avg(quantity),
        f"{p}discount_applied_mean": F.avg(discount),
        f"{p}discount_applied_max": F.max(discount),
        f"{p}transaction_date_min": F.min(date),
        f"{p}transaction_date_max": F.max(date)})
    life = F.datediff(F.col(f"{p}transaction_date_max"), F.col(f"{p}transaction_date_min"))
    return (g.withColumn(f"{p}lifetime_days", life)
             .withColumn(f"{p}purchase_frequency",
                         F.col(f"{p}total_sales_count") / (F.col(f"{p}lifetime_days") + 1)))


# ---------------------------------------------------------------- A8
def product_feature_stats(df: DataFrame, product="product_id", sales="total_sales",
                          quantity="quantity", price="unit_price",
                          discount="discount_applied", by: Sequence[str] = (),
                          counted: DataFrame | None = None) -> DataFrame:
    """Per product stats; popularity = count / max(count) over products.

    The max over products is a scalar subquery over the (small, per
    product) aggregate — not a single-partition window. With ``by`` the rows, dealt by
    ``windows.laid_out``, get the stats of their product; ``counted`` are the same rows before they were dealt.
    """
    p = "product_"
    g = _group_values(df, product, by, {
        f"{p}total_sales_sum": F.sum(sales),
        f"{p}total_sales_mean": F.avg(sales),
        f"{p}total_sales_count": F.count(sales),
        f"{p}quantity_sum": F.sum(quantity),
        f"{p}quantity_mean": F.avg(quantity),
        f"{p}unit_price_mean": F.avg(price),
        f"{p}unit_price_std": F.stddev_samp(price),
        f"{p}discount_applied_mean": F.avg(discount),
        f"{p}discount_applied_count": F.count(discount)})
    n = f"{p}total_sales_count"
    per_product = g if not by else _group_values(df if counted is None else counted, product, (), {n: F.count(sales)})
    top = scalar_of(per_product, F.max(n))
    return (g.withColumn(f"{p}popularity_score", F.col(n) / top)
             .withColumn(f"{p}discount_frequency",
                         F.col(f"{p}discount_applied_count") / F.col(f"{p}total_sales_count")))


# ---------------------------------------------------------------- A9
def customer_lifetime_value(df: DataFrame, customer="customer_id", sales="total_sales",
                            txn="transaction_id", date="transaction_date",
                            line_count: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """AOV × purchase frequency × lifespan_days / 365, in one pass.

    With ``line_count`` rows are sums per order: ``sales`` over ``<sales>_n`` lines. With ``by`` the rows, dealt
    by ``windows.laid_out``, get the values of their customer.
    """
    g = _group_values(df, customer, by, {
        "avg_order_value": _mean_of_sums(sales) if line_count else F.avg(sales),
        "purchase_frequency": F.sum(line_count) if line_count else F.count(txn),
        "_first_day": F.min(date), "_last_day": F.max(date)})
    g = g.withColumn("lifespan_days", F.datediff("_last_day", "_first_day")).drop("_first_day", "_last_day")
    return g.withColumn("customer_lifetime_value",
                        F.col("avg_order_value") * F.col("purchase_frequency")
                        * (F.col("lifespan_days") / 365.0))


# ---------------------------------------------------------------- A10, A11
def monthly_trend_feature(df: DataFrame, date="transaction_date", sales="total_sales") -> DataFrame:
    """Rows with the total sales of their calendar month attached."""
    d = df.withColumn("year_month", F.date_format(date, "yyyy-MM"))
    # one row per calendar month: broadcast by size bound
    stats = (_keys_not_null(d, ["year_month"]).groupBy("year_month")
             .agg(F.sum(sales).alias("monthly_sales_trends")))
    return d.join(F.broadcast(stats), "year_month", "left")


def seasonal_trend_feature(df: DataFrame, date="transaction_date", sales="total_sales") -> DataFrame:
    """Rows with the mean sales of their month-of-year attached."""
    d = df.withColumn("month", F.month(date))
    # month-of-year has 12 values: the aggregate is broadcast by size bound
    stats = (d.where(F.col("month").isNotNull()).groupBy("month")
              .agg(F.avg(sales).alias("seasonal_sales_trends")))
    return d.join(F.broadcast(stats), "month", "left")


# ---------------------------------------------------------------- A12
def category_variety(df: DataFrame, customer="customer_id", category="product_category",
                     quantity="quantity", by: Sequence[str] = ()) -> DataFrame:
    """Rows with ``quantity × distinct categories of the customer``.

    Distinct windows are not supported; distinct (customer, category) pairs
    are counted with two partial aggregations and joined back. Rows that ``windows.laid_out`` has dealt
    by ``by`` stay where they are: the size of a set of categories per window is the count.
    """
    if by:
        n = F.size(F.collect_set(category).over(W.partitionBy(*by))).cast("long")
        out = df.withColumn("product_variety", F.when(F.col(customer).isNotNull() & (n > 0), n))
        return out.withColumn("average_basket_size",
                              F.col(quantity) * F.coalesce(F.col("product_variety"), F.lit(0)))
    pairs = _keys_not_null(df, [customer, category]).select(customer, category).distinct()
    variety = pairs.groupBy(customer).agg(F.count(F.lit(1)).alias("product_variety"))
    out = df.join(variety, customer, "left")
    return out.withColumn("average_basket_size",
                          F.col(quantity) * F.coalesce(F.col("product_variety"), F.lit(0)))


# ---------------------------------------------------------------- A13, J11
def channel_sales(df: DataFrame, channel="channel", sales="total_sales",
                  customer="customer_id", approx: bool = False) -> DataFrame:
    """Per channel: total sales, line count, mean basket, distinct customers."""
    distinct = (F.approx_count_distinct(customer) if approx
                else F.count_distinct(customer))
    return (_keys_not_null(df, [channel]).groupBy(channel).agg(
        F.sum(sales).alias("total_sales"),
        F.count(F.lit(1)).alias("transactions"),
        (F.sum(sales) / F.count(F.lit(1))).alias("avg_basket"),
        distinct.alias("unique_customers")))


# ---------------------------------------------------------------- A14
def channel_monthly_sales(df: DataFrame, channel="channel", date="transaction_date",
                          sales="total_sales") -> DataFrame:
    m = F.trunc(date, "month").alias("month")
    return (_keys_not_null(df, [channel, date]).groupBy(channel, m)
              .agg(F.sum(sales).cast("double").alias("sales")))


# ---------------------------------------------------------------- A15
def channel_hourly_sales(df: DataFrame, channel="event_type", ts="ts", value="value") -> DataFrame:
    return (_keys_not_null(df, [channel, ts]).groupBy(channel, F.hour(ts).alias("hour"))
              .agg(F.sum(value).alias("sales"), F.count(F.lit(1)).alias("events")))


# ---------------------------------------------------------------- A16
def sales_by_period(df: DataFrame, grain: str, date="transaction_date",
                    sales="total_sales") -> DataFrame:
    """Sum per period start; weeks start on Monday."""
    unit = {"week": "week", "month": "month", "year": "year", "quarter": "quarter",
            "day": "day"}[grain]
    start = F.date_trunc(unit, F.col(date)).cast("date").alias("period_start")
    return (df.where(F.col(date).isNotNull()).groupBy(start)
              .agg(F.sum(sales).cast("double").alias("sales"))
              .withColumn("grain", F.lit(grain)))


def sales_by_periods(df: DataFrame, grains: Sequence[str], date="transaction_date",
                     sales="total_sales") -> DataFrame:
    """Sums per period start at several grains: rows are added up to days once, the days rolled up."""
    days = (df.where(F.col(date).isNotNull()).groupBy(F.col(date).alias("_d"))
              .agg(F.sum(sales).alias("_s")))
    each = F.explode(F.array(*[F.struct(
        F.lit(g).alias("grain"), F.date_trunc(g, F.col("_d")).cast("date").alias("period_start"))
        for g in grains]))
    return (days.select(each.alias("_p"), "_s").groupBy("_p.period_start", "_p.grain")
                .agg(F.sum("_s").cast("double").alias("sales"))
                .select("period_start", "sales", "grain"))


# ---------------------------------------------------------------- A17
def sales_by_month_and_week(df: DataFrame, date="transaction_date", sales="total_sales") -> DataFrame:
    """Sums per month of the year and per ISO week, rolled up from days."""
    days = (df.where(F.col(date).isNotNull()).groupBy(F.col(date).alias("_d"))
              .agg(F.sum(sales).alias("_s")))
    each = F.explode(F.array(
        F.struct(F.lit("month").alias("kind"), F.month("_d").alias("period")),
        F.struct(F.lit("iso_week").alias("kind"), F.weekofyear("_d").alias("period"))))
    return (days.select(each.alias("_p"), "_s").groupBy("_p.kind", "_p.period")
                .agg(F.sum("_s").alias("sales")).select("period", "sales", "kind"))


# ---------------------------------------------------------------- A21
def daily_sales(df: DataFrame, date="transaction_date", sales="total_sales",
                keys: Sequence[str] = ()) -> DataFrame:
    keys = list(keys)
    return (_keys_not_null(df, [date, *keys]).groupBy(*keys, F.col(date).alias("ds"))
              .agg(F.sum(sales).cast("double").alias("y")))


# ---------------------------------------------------------------- A22
def month_of_year_profile(daily: DataFrame, ds="ds", y="y") -> DataFrame:
    """From a daily series: per month-of-year sum, mean and count of days."""
    return (daily.groupBy(F.month(ds).alias("month")).agg(
        F.sum(y).alias("sum_sales"), F.avg(y).alias("mean_sales"),
        F.count(y).alias("n_days")))


# ---------------------------------------------------------------- A23
def sales_by_category(df: DataFrame, category="product_category", sales="total_sales") -> DataFrame:
    return (_keys_not_null(df, [category]).groupBy(category)
              .agg(F.sum(sales).cast("double").alias("sales")).orderBy(F.desc("sales")))


# ---------------------------------------------------------------- A24
def class_share(df: DataFrame, label: str) -> DataFrame:
    """Count and share of each label value (share of non-null labels)."""
    counts = _keys_not_null(df, [label]).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = scalar_of(counts, F.sum("count"))
    return counts.withColumn("share", F.col("count") / total)


# ---------------------------------------------------------------- A25
def avg_by_value(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return (_keys_not_null(df, [key]).groupBy(key).agg(F.avg(value).alias(name))
              .orderBy(F.desc(name)))


# ---------------------------------------------------------------- A26
def cross_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return _keys_not_null(df, [a, b]).groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------- A27
def product_demand_by_month(df: DataFrame, date="transaction_date", sales="total_sales",
                            discount="discount_applied", price="unit_price") -> DataFrame:
    """Per month: sales, mean discount, mean price, and a 0-based time index.

    The time index is a global row_number over the monthly aggregate (one
    row per month — a few hundred rows at most), not over raw rows.
    """
    m = (df.where(F.col(date).isNotNull())
           .groupBy(F.trunc(date, "month").alias("month")).agg(
               F.sum(sales).alias("sales"), F.avg(discount).alias("avg_discount"),
               F.avg(price).alias("avg_price")))
    return m.withColumn("time_index", F.row_number().over(W.orderBy("month")) - 1)


# ---------------------------------------------------------------- A28
def box_stats(df: DataFrame, group: str, value: str, exact: bool = False) -> DataFrame:
    """Quartiles, IQR whiskers (1.5·IQR, clipped to data) and sort order by median.

    Default: ``percentile_approx`` (a fixed-size sketch per group, merged
    map-side). ``exact`` uses ``percentile`` (linear, like pandas), whose
    buffer is a map of distinct value → count: for bounded-domain values.
    """
    if exact:
        q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    else:
        q = F.percentile_approx(value, [0.25, 0.5, 0.75], 10000)
    g = _keys_not_null(df, [group]).groupBy(group).agg(
        q.alias("_q"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.count(value).alias("count"))
    g = g.select(group, "min", "max", "count",
                 F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return (g.withColumn("whisker_low", F.greatest(F.col("min"), F.col("q1") - 1.5 * iqr))
             .withColumn("whisker_high", F.least(F.col("max"), F.col("q3") + 1.5 * iqr))
             .orderBy(F.desc("median")))


# ---------------------------------------------------------------- A29
def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram between min and max; last bin closed on the right.

    min / max are scalar subqueries; every row maps to a bin index on its
    own task, and the count is a partial aggregation over ``bins`` keys.
    """
    lo = scalar_of(df, F.min(value))
    hi = scalar_of(df, F.max(value))
    width = (hi - lo) / bins
    idx = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((F.col(value) - lo) / width).cast("int") + 1, F.lit(bins)))
    counts = (df.where(F.col(value).isNotNull()).groupBy(idx.alias("bin"))
                .agg(F.count(F.lit(1)).alias("count")))
    return (counts.withColumn("bin_start", lo + (F.col("bin") - 1) * width)
                  .withColumn("bin_end", lo + F.col("bin") * width))


# ---------------------------------------------------------------- A30, A31
def correlation(df: DataFrame, a: str, b: str, group: str | None = None,
                digits: int | None = None) -> DataFrame:
    c = F.corr(a, b)
    if digits is not None:
        c = F.round(c, digits)
    if group is None:
        return df.agg(c.alias("correlation"))
    return _keys_not_null(df, [group]).groupBy(group).agg(c.alias("correlation"))


# ---------------------------------------------------------------- A32
def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long-form Pearson matrix: one pass computes every pair's ``corr``."""
    cols = list(columns)
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', `{i}`" for i, (a, b) in enumerate(pairs))
    return row.selectExpr(f"stack({len(pairs)}, {stack}) AS (column_a, column_b, correlation)")


# ---------------------------------------------------------------- A33
def group_profile(df: DataFrame, group: str, numeric: Sequence[str],
                  categorical: Sequence[str] = ()) -> DataFrame:
    """Mean of numerics, most frequent categorical (ties → smallest), count."""
    aggs = [F.avg(c).alias(f"avg_{c}") for c in numeric]
    aggs += [F.mode(c, True).alias(f"mode_{c}") for c in categorical]
    aggs.append(F.count(F.lit(1)).alias("count"))
    return _keys_not_null(df, [group]).groupBy(group).agg(*aggs)


# ---------------------------------------------------------------- A34
def conditional_means(df: DataFrame, level: str, levels: Sequence[str],
                      values: Sequence[str]) -> DataFrame:
    """One row: mean of each value within each level (``avg(when(...))``)."""
    aggs = []
    for lv in levels:
        for v in values:
            name = f"{lv}_{v}".lower().replace(" ", "_").replace("-", "_")
            aggs.append(F.avg(F.when(F.col(level) == lv, F.col(v))).alias(f"avg_{name}"))
    return df.agg(*aggs)


# ---------------------------------------------------------------- A35
def frequency_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Replace a value by its share of non-null rows (null stays null)."""
    out = out or f"{column}_freq"
    counts = _keys_not_null(df, [column]).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    total = scalar_of(counts, F.sum("_n"))
    shares = counts.select(column, (F.col("_n") / total).alias(out))
    return df.join(shares, column, "left")


def frequency_encode_wide(df: DataFrame, columns: Sequence[str], min_distinct: int = 50,
                          approx_first: bool = True) -> DataFrame:
    """Frequency-encode the columns with more than ``min_distinct`` values.

    The distinct counts for every column are gathered in one aggregation: approximate first
    (1% error per sigma), then exact for those within 10% (ten sigmas) of the gate.
    """
    cols = list(columns)
    if not cols:
        return df
    if approx_first:
        row = df.agg(*[F.approx_count_distinct(c, 0.01).alias(c) for c in cols]).first()
        close = [c for c in cols if abs(row[c] - min_distinct) <= 0.1 * min_distinct + 2]
        exact = df.agg(*[F.count_distinct(c).alias(c) for c in close]).first() if close else {}
        counts = {c: (exact[c] if c in close else row[c]) for c in cols}
    else:
        row = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
        counts = {c: row[c] for c in cols}
    for c in cols:
        if counts[c] > min_distinct:
            df = frequency_encode(df, c, out=f"_{c}_freq").drop(c).withColumnRenamed(f"_{c}_freq", c)
    return df


# ---------------------------------------------------------------- A36
def pivot_mean(df: DataFrame, row: str, column: str, value: str,
               values: Sequence | None = None) -> DataFrame:
    """Pivot with mean; pass ``values`` to skip the distinct-values job."""
    g = _keys_not_null(df, [row]).groupBy(row)
    p = g.pivot(column, list(values)) if values is not None else g.pivot(column)
    return p.agg(F.avg(value))


# ---------------------------------------------------------------- A37
def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column in one pass, long form (column, nulls)."""
    cols = df.columns
    row = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(f"c{i}")
                   for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return row.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, nulls)")


# ---------------------------------------------------------------- A39, F17
def linear_fit(df: DataFrame, y: str, x: str, group: str | None = None) -> DataFrame:
    """Ordinary least squares of y on one x: slope, intercept, R², trend label."""
    aggs = [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
            F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n")]
    out = (df.agg(*aggs) if group is None
           else _keys_not_null(df, [group]).groupBy(group).agg(*aggs))
    return out.withColumn("trend", trend_label(F.col("slope")))


def trend_label(slope: Column) -> Column:
    return (F.when(slope > 0, "upward").when(slope < 0, "downward")
            .when(slope.isNotNull(), "flat"))


def with_linear_fit(df: DataFrame, y: str, x: str, out="fitted") -> DataFrame:
    """Rows with the fitted value of a one-variable regression attached."""
    slope = scalar_of(df, F.regr_slope(y, x))
    icpt = scalar_of(df, F.regr_intercept(y, x))
    return df.withColumn(out, icpt + slope * F.col(x))


# ---------------------------------------------------------------- A41, J10
def top_n_keys(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The n keys with the largest total (ties broken by key)."""
    totals = _keys_not_null(df, [key]).groupBy(key).agg(F.sum(value).alias("_total"))
    return totals.orderBy(F.desc("_total"), F.asc(key)).limit(n).select(key)


def top_products_by_month(df: DataFrame, product="product_id", date="transaction_date",
                          sales="total_sales", n: int = 10) -> DataFrame:
    """Month-of-year × product sums for the top-n products (semi join)."""
    top = top_n_keys(df, product, sales, n)
    return (df.join(F.broadcast(top), product, "left_semi")
              .where(F.col(date).isNotNull())
              .groupBy(product, F.month(date).alias("month"))
              .agg(F.sum(sales).alias("sales")))
