"""Star-schema tables and the canonical retail transaction view.

The canonical view has one row per line item (a "transaction line") with the
column names the analytics operators use (see FIXTURES.md §2). It is built
lazily and joins only the dimensions whose columns are requested, so an
operator that needs ``customer_id`` and ``total_sales`` scans two fact
tables and nothing else. All dimension joins are left joins from the fact
side, so pruning an unused dimension never changes the row set.

Join strategy at scale: ``lineitem`` ⋈ ``orders`` is a shuffle join on the
order key (both sides grow with the data). ``part`` and ``customer`` also
grow with the data, so no broadcast is forced; AQE turns the join into a
broadcast at runtime only when the measured side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``. ``nation`` (25 rows) and
``region`` (5 rows) are fixed-size code tables and are always broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

# Channel mapping and income cut points for the test schema.
ONLINE_PRIORITIES = ("1-URGENT", "2-HIGH")
INCOME_LOW_BELOW = 2500.0
INCOME_MEDIUM_BELOW = 6000.0


# Money: every line amount has at most 4 decimals; sums of money run as
# DECIMAL(18,4) (exact, integer arithmetic inside) and become DOUBLE once at the
# end, so a total is the same number whatever the partitioning or summation order.
MONEY = "decimal(18,4)"


def money(col) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def money_sum(col) -> Column:
    """Exact sum of a money column, as DOUBLE."""
    return F.sum(money(col)).cast("double")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def income_bracket(acctbal: Column) -> Column:
    return (F.when(acctbal < INCOME_LOW_BELOW, "Low")
            .when(acctbal < INCOME_MEDIUM_BELOW, "Medium")
            .when(acctbal.isNotNull(), "High"))


def channel_of(priority: Column) -> Column:
    """Online for urgent / high priority orders, in store otherwise; null if unknown."""
    return F.when(priority.isin(*ONLINE_PRIORITIES), "online").when(priority.isNotNull(), "in_store")


def line_prices(price="extended_price", discount="discount", quantity="quantity") -> dict[str, Column]:
    """Canonical columns that follow from a line's price, discount (a share) and quantity."""
    p, d, q = F.col(price), F.col(discount), F.col(quantity)
    return {"unit_price": F.try_divide(p, q), "discount_applied": F.try_divide(p * d, q),
            "total_sales": p * (1.0 - d)}


_SOURCE_PRICES = ("l_extendedprice", "l_discount", "l_quantity")

# canonical column -> (source group, expression)
_LINE = {
    "transaction_id": lambda: F.col("l_orderkey"),
    "line_number": lambda: F.col("l_linenumber"),
    "product_id": lambda: F.col("l_partkey"),
    "supplier_id": lambda: F.col("l_suppkey"),
    "quantity": lambda: F.col("l_quantity"),
    "unit_price": lambda: line_prices(*_SOURCE_PRICES)["unit_price"],
    "discount_applied": lambda: line_prices(*_SOURCE_PRICES)["discount_applied"],
    "discount": lambda: F.col("l_discount"),
    "discount_pct": lambda: F.col("l_discount") * 100.0,
    "total_sales": lambda: line_prices(*_SOURCE_PRICES)["total_sales"],
    # quantity × unit price, the "sales" of the channel, trend and seasonality reports
    "gross_sales": lambda: F.col("l_quantity") * F.try_divide(F.col("l_extendedprice"),
                                                             F.col("l_quantity")),
    "extended_price": lambda: F.col("l_extendedprice"),
    "return_flag": lambda: F.col("l_returnflag"),
    "ship_date": lambda: F.col("l_shipdate").cast("date"),
}
_ORDER = {
    "customer_id": lambda: F.col("o_custkey"),
    "transaction_date": lambda: F.col("o_orderdate").cast("date"),
    "channel": lambda: channel_of(F.col("o_orderpriority")),
    "order_priority": lambda: F.col("o_orderpriority"),
    "order_status": lambda: F.col("o_orderstatus"),
}
_CUSTOMER = {
    "customer_name": lambda: F.col("c_name"),
    "account_balance": lambda: F.col("c_acctbal"),
    "income_bracket": lambda: income_bracket(F.col("c_acctbal")),
    "market_segment": lambda: F.col("c_mktsegment"),
}
_GEO = {
    "store_state": lambda: F.col("n_name"),
    "region": lambda: F.col("r_name"),
}
_PART = {
    "product_category": lambda: F.col("p_type"),
    "product_brand": lambda: F.col("p_brand"),
    "product_name": lambda: F.col("p_name"),
    "product_size": lambda: F.col("p_size"),
    "retail_price": lambda: F.col("p_retailprice"),
}
CANONICAL = {**_LINE, **_ORDER, **_CUSTOMER, **_GEO, **_PART}


def customers(spark: SparkSession, sf_dir: str, with_geo: bool = True) -> DataFrame:
    """Customer dimension with nation / region names (broadcast code tables)."""
    c = table(spark, sf_dir, "customer")
    if not with_geo:
        return c
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
             .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left"))


def transactions(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """Canonical transaction-line view restricted to ``columns``.

    ``columns=None`` returns every canonical column (all joins).
    """
    cols = list(CANONICAL) if columns is None else list(columns)
    unknown = [c for c in cols if c not in CANONICAL]
    if unknown:
        raise ValueError(f"not canonical columns: {unknown}")
    need = set(cols)
    need_geo = bool(need & set(_GEO))
    need_cust = need_geo or bool(need & set(_CUSTOMER))
    need_order = need_cust or bool(need & set(_ORDER))
    need_part = bool(need & set(_PART))

    df = table(spark, sf_dir, "lineitem")
    if need_order:
        o = table(spark, sf_dir, "orders")
        if need_cust:
            o = o.join(customers(spark, sf_dir, with_geo=need_geo),
                       o.o_custkey == F.col("c_custkey"), "left")
        df = df.join(o, df.l_orderkey == o.o_orderkey, "left")
    if need_part:
        p = table(spark, sf_dir, "part")
        df = df.join(p, df.l_partkey == p.p_partkey, "left")
    return df.select(*[CANONICAL[c]().alias(c) for c in cols])


def order_lines(spark: SparkSession, sf_dir: str, with_geo: bool = False) -> DataFrame:
    """Order-grain facts: line items pre-aggregated per order, then joined.

    Eager aggregation: Spark does not push an aggregation below a join, so
    reports keyed by an order or customer attribute (channel, date, region)
    first reduce ``lineitem`` to one row per order (a partial aggregation,
    about 4:1), and only that crosses the join. The aggregate's hash
    partitioning on the order key is reused by the join. Additive measures
    only: line count, quantity, net and gross sales (exact DECIMAL sums).
    """
    li = table(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("items"),
        F.sum(money(F.col("l_extendedprice") * (1.0 - F.col("l_discount")))).alias("order_sales"),
        F.sum(money(CANONICAL["gross_sales"]())).alias("order_gross_sales"))
    o = table(spark, sf_dir, "orders")
    geo = []
    if with_geo:
        o = o.join(customers(spark, sf_dir), o.o_custkey == F.col("c_custkey"), "left")
        geo = [F.col("r_name").alias("region"), F.col("n_name").alias("store_state")]
    return per_order.join(o, per_order.l_orderkey == o.o_orderkey, "left").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        channel_of(F.col("o_orderpriority")).alias("channel"),
        *geo, "n_lines", "items", "order_sales", "order_gross_sales")


def order_totals(spark: SparkSession, sf_dir: str, totals: Mapping[str, str | Column],
                 columns: Sequence[str]) -> DataFrame:
    """Canonical order ``columns`` with sums over the order's lines, a row per order (and order row).

    ``totals`` maps a name to a line expression over canonical line columns; it becomes ``name`` (sum)
    and ``name_n`` (lines that have it), so means at any coarser grain follow from sums. ``n_lines``
    counts the lines with an order key. Lines are added up before they meet ``orders``.
    """
    li = table(spark, sf_dir, "lineitem").select(*[f().alias(c) for c, f in _LINE.items()])
    each = [a for name, e in totals.items() for x in [F.expr(e) if isinstance(e, str) else e]
            for a in (F.sum(x).alias(name), F.count(x).alias(f"{name}_n"))]
    per_order = li.groupBy("transaction_id").agg(F.count("transaction_id").alias("n_lines"), *each)
    o = table(spark, sf_dir, "orders")
    return per_order.join(o, per_order.transaction_id == o.o_orderkey, "left").select(
        "transaction_id", *[_ORDER[c]().alias(c) for c in columns], "n_lines",
        *[c for name in totals for c in (name, f"{name}_n")])


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-grain facts: line items pre-aggregated per part, then joined to
    ``part`` (eager aggregation, about 30 lines per part)."""
    li = table(spark, sf_dir, "lineitem")
    per_part = li.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("quantity"),
        F.sum(money(F.col("l_extendedprice") * (1.0 - F.col("l_discount")))).alias("sales"))
    p = table(spark, sf_dir, "part")
    return per_part.join(p, per_part.l_partkey == p.p_partkey, "left").select(
        F.col("l_partkey").alias("product_id"), F.col("p_type").alias("product_category"),
        F.col("p_brand").alias("product_brand"), "n_lines", "quantity", "sales")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# --------------------------------------------------------------------------
# SQL text of the same view for DuckDB oracles (driver pre-registers tables).
# --------------------------------------------------------------------------
_SQL_EXPR = {
    "transaction_id": "l.l_orderkey",
    "line_number": "l.l_linenumber",
    "product_id": "l.l_partkey",
    "supplier_id": "l.l_suppkey",
    "quantity": "l.l_quantity",
    "unit_price": "l.l_extendedprice / NULLIF(l.l_quantity, 0)",
    "discount_applied": "l.l_extendedprice * l.l_discount / NULLIF(l.l_quantity, 0)",
    "discount": "l.l_discount",
    "discount_pct": "l.l_discount * 100.0",
    "total_sales": "l.l_extendedprice * (1.0 - l.l_discount)",
    "gross_sales": "l.l_quantity * (l.l_extendedprice / NULLIF(l.l_quantity, 0))",
    "extended_price": "l.l_extendedprice",
    "return_flag": "l.l_returnflag",
    "ship_date": "CAST(l.l_shipdate AS DATE)",
    "customer_id": "o.o_custkey",
    "transaction_date": "CAST(o.o_orderdate AS DATE)",
    "channel": ("CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'online' "
                "WHEN o.o_orderpriority IS NOT NULL THEN 'in_store' END"),
    "order_priority": "o.o_orderpriority",
    "order_status": "o.o_orderstatus",
    "customer_name": "c.c_name",
    "account_balance": "c.c_acctbal",
    "income_bracket": ("CASE WHEN c.c_acctbal < 2500 THEN 'Low' WHEN c.c_acctbal < 6000 THEN 'Medium' "
                       "WHEN c.c_acctbal IS NOT NULL THEN 'High' END"),
    "market_segment": "c.c_mktsegment",
    "store_state": "n.n_name",
    "region": "r.r_name",
    "product_category": "p.p_type",
    "product_brand": "p.p_brand",
    "product_name": "p.p_name",
    "product_size": "p.p_size",
    "retail_price": "p.p_retailprice",
}


def tx_sql(columns) -> str:
    """SELECT for the canonical view in DuckDB SQL (same joins, same names)."""
    cols = list(columns)
    need = set(cols)
    need_geo = bool(need & set(_GEO))
    need_cust = need_geo or bool(need & set(_CUSTOMER))
    need_order = need_cust or bool(need & set(_ORDER))
    need_part = bool(need & set(_PART))
    sql = "SELECT " + ", ".join(f"{_SQL_EXPR[c]} AS {c}" for c in cols) + " FROM lineitem l"
    if need_order:
        sql += " LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey"
    if need_cust:
        sql += " LEFT JOIN customer c ON o.o_custkey = c.c_custkey"
    if need_geo:
        sql += (" LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"
                " LEFT JOIN region r ON n.n_regionkey = r.r_regionkey")
    if need_part:
        sql += " LEFT JOIN part p ON l.l_partkey = p.p_partkey"
    return sql
