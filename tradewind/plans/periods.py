"""Calendar questions and the period report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as C
from tradewind.operators import ordering
from tradewind.operators import relational as R


def monthly_orders(orders: DataFrame, months: int = 12) -> DataFrame:
    """Orders per month over the last ``months`` months of data, any status."""
    return (
        R.last_months(orders, "order_date", months)
        .groupBy(C.month_key("order_date").alias("order_month"))
        .agg(F.count_distinct("order_id").alias("order_count"))
        .orderBy(F.col("order_month").desc())
    )


def monthly_revenue(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Exact net revenue per (year, month); cancelled orders do not count."""
    active = R.active_orders(orders).select(
        "order_id", F.year("order_date").alias("year"), F.month("order_date").alias("month"))
    return (
        R.order_revenue(items).join(active, "order_id")
        .groupBy("year", "month").agg(F.sum("revenue").alias("_revenue"))
    )


def yoy_revenue(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Each month against the same month of the year before."""
    both = R.same_period_last_year(monthly_revenue(items, orders), "_revenue", name="_before")
    growth = C.ratio(F.col("_revenue") - F.col("_before"), "_before")
    return (
        both.withColumn("growth_percent", growth)
        .select(
            "year", "month", C.money("_revenue").alias("revenue"),
            C.money("_before").alias("prev_year_revenue"), "growth_percent",
            F.coalesce(C.percent_text("growth_percent"), F.lit("N/A")).alias("yoy_growth_percent"))
        .orderBy(F.col("year").desc(), F.col("month").desc())
    )


def period_breakdown(
    items: DataFrame, orders: DataFrame, kind: str, start: str, end: str
) -> DataFrame:
    """Orders, revenue and customers per day, week or month of a period.

    Summed per order first, so only the customers need a distinct count.
    """
    active = R.in_period(R.active_orders(orders), "order_date", start, end).select(
        "order_id", "customer_id", C.period_key("order_date", kind).alias("period_key"))
    return (
        R.order_revenue(items).join(active, "order_id")
        .groupBy("period_key")
        .agg(F.count("order_id").alias("total_orders"),
             C.money(F.sum("revenue")).alias("revenue"),
             F.count_distinct("customer_id").alias("unique_customers"))
        .orderBy("period_key")
    )


def previous_period(start: str, end: str) -> tuple[str, str]:
    """The equally long period that ends the day before ``start``."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if first > last:
        raise ValueError("start is after end")
    days = (last - first).days + 1
    return str(first - dt.timedelta(days=days)), str(first - dt.timedelta(days=1))


def period_summary(items: DataFrame, orders: DataFrame, start: str, end: str) -> DataFrame:
    """(metric, current_period, previous_period, change) for three metrics.

    Orders and customers count every status, revenue leaves out cancelled
    orders. Both periods come from one pass over the orders.
    """
    was_start, was_end = previous_period(start, end)
    wanted = R.in_period(orders, "order_date", was_start, end).select(
        "order_id", "customer_id",
        F.coalesce(F.col("status") != "CANCELLED", F.lit(False)).alias("_active"),
        C.in_days("order_date", start, end).alias("_now"))
    revenue = F.sum(F.when(F.col("_active"), F.col("revenue")))
    per_period = (
        wanted.join(R.order_revenue(items), "order_id", "left")
        .groupBy("_now")
        .agg(F.count("order_id").cast("decimal(28,2)").alias("orders"),
             C.money(revenue).alias("revenue"),
             F.count_distinct("customer_id").cast("decimal(28,2)").alias("customers"))
    )

    def of(metric: str, now: bool):
        hit = F.col("_now") if now else ~F.col("_now")
        return F.coalesce(F.max(F.when(hit, F.col(metric))), F.lit(0).cast("decimal(28,2)"))

    # The labels of the report.
    labels = {"Total Orders": "orders", "Total Revenue ($)": "revenue",
              "Unique Customers": "customers"}
    rows = [
        F.struct(F.lit(label).alias("metric"), of(m, True).alias("current_period"),
                 of(m, False).alias("previous_period"))
        for label, m in labels.items()]
    return (
        per_period.agg(F.array(*rows).alias("_all")).select(F.inline("_all"))
        .withColumn("change", C.change_text("current_period", "previous_period"))
    )


def period_top_products(
    items: DataFrame, orders: DataFrame, products: DataFrame, start: str, end: str, k: int = 3
) -> DataFrame:
    """The ``k`` best products of a period by revenue, returns deducted.

    Lines of unknown products do not count. Names are looked up for the ``k`` winners only.
    """
    order = [F.col("total_revenue").desc(), F.col("product_id").asc()]
    active = R.in_period(R.active_orders(orders), "order_date", start, end)
    sold = R.product_revenue(
        items, active, {"total_qty": F.sum(F.col("quantity").cast("long"))})
    sold = sold.join(products.select("product_id"), "product_id", "left_semi")
    best = ordering.top_k(
        sold.select("product_id", "total_qty", C.money("revenue").alias("total_revenue")),
        order, k)
    return (
        products.select("product_id", "product_name").join(F.broadcast(best), "product_id")
        .orderBy(*order)
    )


def monthly_sales_trend(line_sales: DataFrame) -> DataFrame:
    """Sales per calendar month."""
    return (
        line_sales.groupBy(C.month_key("order_date").alias("order_month"))
        .agg(F.sum("sales").cast("decimal(28,4)").alias("total_sales"))
        .orderBy("order_month")
    )
