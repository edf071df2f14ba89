"""Projection, filter, join and subquery operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tradewind.functions import columns as C
from tradewind.session import stage


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def cast(df: DataFrame, mapping: Mapping[str, str | DataType], lenient: bool = False) -> DataFrame:
    """Change column types; ``lenient`` turns values that do not fit into NULL."""
    if lenient:
        return df.withColumns({c: F.col(c).try_cast(t) for c, t in mapping.items()})
    return df.withColumns({c: F.col(c).cast(t) for c, t in mapping.items()})


def with_total_amount(
    df: DataFrame, price: str = "initial_price", discount: str = "discount",
    name: str = "total_amount",
) -> DataFrame:
    """price - discount; NULL if either is NULL."""
    return df.withColumn(name, F.col(price) - F.col(discount))


def with_profit_flag(df: DataFrame, profit: str, name: str = "profit_flag") -> DataFrame:
    return df.withColumn(name, C.profit_flag(profit))


def with_profit_margin(
    df: DataFrame, profit: str = "profit", sales: str = "sales", name: str = "profit_margin",
    scale: float = 100.0, digits: int = 2,
) -> DataFrame:
    """Profit as a share of sales. ``scale=10`` with ``sales=profit`` is the constant 10.0."""
    return df.withColumn(name, C.ratio(profit, sales, scale, digits))


def with_effective_price(
    df: DataFrame, final: str = "final_price", initial: str = "initial_price",
    name: str = "final_price",
) -> DataFrame:
    """The final price, or the initial one where it is empty."""
    return df.withColumn(name, F.coalesce(F.col(final), F.col(initial)))


def active_orders(orders: DataFrame, status: str = "status") -> DataFrame:
    """Orders that were not cancelled; an unknown status is dropped, as in SQL."""
    return orders.filter(F.col(status) != "CANCELLED")


def in_period(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows between the start of day ``start`` and the end of day ``end``."""
    return df.filter(C.in_days(column, start, end))


def last_months(df: DataFrame, column: str, months: int = 12) -> DataFrame:
    """Rows from ``months`` months before the newest date in the data on."""
    newest = df.agg(F.max(column)).scalar()
    return df.filter(F.col(column) >= C.months_before(newest, months))


def above_average(df: DataFrame, column: str) -> DataFrame:
    """Rows above the mean of the whole column."""
    mean = df.agg(F.avg(column)).scalar()
    return df.filter(F.col(column) > mean)


def max_rows_per_key(df: DataFrame, key: str, column: str) -> DataFrame:
    """Rows that equal their key's maximum; ties all stay.

    The join is on (key, value), so the rows of a hot key spread by value, and
    rows below the maximum find no partner.
    """
    best = df.groupBy(key).agg(F.max(column).alias("_best")).withColumnRenamed(key, "_key")
    on = (F.col(key) == F.col("_key")) & (F.col(column) == F.col("_best"))
    return df.join(best, on, "left_semi")


def with_share_of_total(df: DataFrame, column: str, name: str = "share") -> DataFrame:
    """Percent of the column's grand total, taken as a scalar subquery."""
    total = df.agg(F.sum(column)).scalar()
    return df.withColumn(name, C.ratio(F.col(column), total))


def with_group_average(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """A detail table joined back to its own per-key mean.

    An aggregate and a join instead of a window: the aggregate shrinks a hot key
    before the shuffle. It is staged because Spark splits a hot key in a join only
    if both sides come straight out of a shuffle.
    """
    means = stage(df.groupBy(key).agg(
        C.mean_of(F.sum(column), F.count(column), 6).alias(name)), "means")
    return df.join(means, key)


def present_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``key IN (SELECT key FROM other)``."""
    return df.join(other.select(key), key, "left_semi")


def absent_from(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``key NOT IN (SELECT key FROM other)`` for a key that is never NULL."""
    return df.join(other.select(key), key, "left_anti")


def same_period_last_year(
    monthly: DataFrame, value: str, year: str = "year", month: str = "month",
    name: str = "prev",
) -> DataFrame:
    """Left join of a monthly table with itself, one year back."""
    before = monthly.select(
        (F.col(year) + 1).alias(year), F.col(month), F.col(value).alias(name))
    return monthly.join(before, [year, month], "left")


def star_join(
    items: DataFrame, orders: DataFrame, products: DataFrame, columns: Sequence[str | Column]
) -> DataFrame:
    """items joined with their order and their product."""
    return items.join(orders, "order_id").join(products, "product_id").select(*columns)


def order_revenue(items: DataFrame, name: str = "revenue") -> DataFrame:
    """Net revenue per order.

    Summed before any join: the shuffle on ``order_id`` then carries one partial
    sum per order and task, however many lines an order has, and the following
    join on ``order_id`` reuses that partitioning.
    """
    return items.groupBy("order_id").agg(F.sum(C.net_revenue()).alias(name))


def product_revenue(
    items: DataFrame, orders: DataFrame, extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Net revenue per product over the given orders.

    Summed by product before the product table is joined, so a best seller
    reaches that join as one row.
    """
    lines = items.join(orders.select("order_id"), "order_id")
    sums = {"revenue": F.sum(C.net_revenue()), **(extra or {})}
    return lines.groupBy("product_id").agg(*[e.alias(n) for n, e in sums.items()])
