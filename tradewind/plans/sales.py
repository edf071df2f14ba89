"""Revenue, product and region questions over customers, products, orders, items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import columns as C
from tradewind.operators import aggregates, ordering
from tradewind.operators import relational as R
from tradewind.session import stage


def revenue_by_category(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Net revenue per category; cancelled orders do not count."""
    sold = R.product_revenue(items, R.active_orders(orders))
    return (
        sold.join(products.select("product_id", "category"), "product_id")
        .groupBy("category").agg(C.money(F.sum("revenue")).alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), "category")
    )


def customer_revenue(items: DataFrame, orders: DataFrame, name: str = "revenue") -> DataFrame:
    """Exact net revenue per customer; cancelled orders do not count."""
    active = R.active_orders(orders).select("order_id", "customer_id")
    return (
        R.order_revenue(items).join(active, "order_id")
        .groupBy("customer_id").agg(F.sum("revenue").alias(name))
    )


def top_customers(
    items: DataFrame, orders: DataFrame, customers: DataFrame, k: int = 10
) -> DataFrame:
    """The ``k`` customers with the highest order value.

    Orders of unknown customers do not count. Names are looked up for the ``k`` winners only.
    """
    order = [F.col("total_order_value").desc(), F.col("customer_id").asc()]
    value = customer_revenue(items, orders).select(
        "customer_id", C.money("revenue").alias("total_order_value"))
    value = value.join(customers.select("customer_id"), "customer_id", "left_semi")
    best = F.broadcast(ordering.top_k(value, order, k))
    return (
        customers.select("customer_id", "customer_name").join(best, "customer_id")
        .select("customer_id", "customer_name", "total_order_value").orderBy(*order)
    )


def more_returned_than_bought(items: DataFrame, products: DataFrame) -> DataFrame:
    """Products with more returned than bought units, whatever the order status."""
    totals = aggregates.signed_quantities(items, "product_id").filter(
        F.col("total_returned") > F.col("total_purchased"))
    return totals.join(products.select("product_id", "product_name"), "product_id").select(
        "product_id", "product_name", "total_purchased", "total_returned")


def return_rate_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Returned units as a share of bought units, whatever the order status."""
    per_product = aggregates.signed_quantities(items, "product_id")
    rate = C.ratio("total_returned", "total_purchased")
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("total_purchased").alias("total_purchased"),
             F.sum("total_returned").alias("total_returned"))
        .withColumn("return_percent", rate)
        .withColumn("return_rate", C.percent_text("return_percent"))
    )


def daily_revenue_by_region(items: DataFrame, orders: DataFrame) -> DataFrame:
    """(region_code, order_date, daily_revenue), rounded per day."""
    active = R.active_orders(orders).select("order_id", "region_code", "order_date")
    return (
        R.order_revenue(items).join(active, "order_id")
        .groupBy("region_code", F.to_date("order_date").alias("order_date"))
        .agg(C.money(F.sum("revenue")).alias("daily_revenue"))
    )


def running_total_by_region(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Daily revenue and its running total per region.

    After the daily aggregate a region has one row per calendar day, so its
    window stays small however many orders it has.
    """
    w = (Window.partitionBy("region_code").orderBy("order_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily_revenue_by_region(items, orders).withColumn(
        "running_total", C.money(F.sum("daily_revenue").over(w)))


def revenue_by_product_name(
    items: DataFrame, orders: DataFrame, products: DataFrame
) -> DataFrame:
    """Net revenue per category and product *name*: same-named products are one."""
    sold = R.product_revenue(items, R.active_orders(orders))
    return (
        sold.join(products.select("product_id", "product_name", "category"), "product_id")
        .groupBy("category", "product_name")
        .agg(C.money(F.sum("revenue")).alias("total_revenue"))
    )


def product_rank_in_category(
    items: DataFrame, orders: DataFrame, products: DataFrame
) -> DataFrame:
    """DENSE_RANK by rounded revenue inside each category, of any size.

    A ranking reads its input twice, so the aggregate is staged first.
    """
    revenue = stage(revenue_by_product_name(items, orders, products), "product_revenue")
    return ordering.rank_in_group(revenue, ["category"], "total_revenue", "rank_in_category")


def top_products_per_category(
    items: DataFrame, orders: DataFrame, products: DataFrame, n: int = 3
) -> DataFrame:
    """The names with the ``n`` highest revenues of each category."""
    revenue = stage(revenue_by_product_name(items, orders, products), "product_revenue")
    return ordering.top_n_per_group(
        revenue, ["category"], "total_revenue", n, "rank_in_category")


def revenue_concentration(items: DataFrame, orders: DataFrame) -> DataFrame:
    """How much of all revenue the best customers make up, best first.

    Customers with equal revenue share their cumulative value.
    """
    revenue = stage(customer_revenue(items, orders), "customer_revenue")
    total = revenue.agg(F.sum("revenue")).scalar()
    ranked = ordering.global_cumulative(
        revenue.withColumn("_part_of", F.col("revenue")), "revenue", "_part_of", "_upto")
    return ranked.select(
        "customer_id",
        C.money("revenue").alias("revenue"),
        C.money("_upto").alias("cumulative_revenue"),
        C.ratio(F.col("_upto"), total).alias("cumulative_share"),
    ).withColumn("cumulative_percent", C.percent_text("cumulative_share"))


# --- the flat sales listing ------------------------------------------------

def rank_customers(line_sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with their names, total sales and RANK."""
    totals = stage(
        aggregates.sum_by_key(line_sales, "customer_id", "sales", "total_sales"), "totals")
    ranked = ordering.global_rank(totals, "total_sales", "customer_rank")
    return ranked.join(customers.select("customer_id", "customer_name"), "customer_id").select(
        "customer_id", "customer_name", "total_sales", "customer_rank")


def extreme_customers(line_sales: DataFrame, k: int = 10, best: bool = True) -> DataFrame:
    """The ``k`` customers with the highest (or lowest) total sales."""
    totals = aggregates.sum_by_key(line_sales, "customer_id", "sales", "total_sales")
    by = F.col("total_sales").desc_nulls_last() if best else F.col("total_sales").asc_nulls_first()
    return ordering.top_k(totals, [by, F.col("customer_id").asc()], k)


def above_average_customers(line_sales: DataFrame) -> DataFrame:
    """Customers whose total is above the mean of all totals."""
    totals = aggregates.sum_by_key(line_sales, "customer_id", "sales", "total_sales")
    return R.above_average(totals, "total_sales")


def top_by_sales(df: DataFrame, keys: list[str], k: int, name: str = "total_sales") -> DataFrame:
    """The ``k`` key combinations with the highest sales.

    The combination is one key, so that a join below on one of its columns can be split.
    """
    totals = (
        df.groupBy(F.struct(*keys).alias("_key")).agg(F.sum("sales").cast("decimal(28,4)").alias(name))
        .select("_key.*", name)
    )
    return ordering.top_k(totals, [F.col(name).desc(), *[F.col(c).asc() for c in keys]], k)


def profit_by_region(df: DataFrame) -> DataFrame:
    """Rounded profit and order lines per region, best first."""
    return (
        df.groupBy("region")
        .agg(C.money(F.sum("profit")).alias("total_profit"),
             F.count("order_id").alias("order_count"))
        .orderBy(F.col("total_profit").desc(), "region")
    )
