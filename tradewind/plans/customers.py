"""Customer questions: delivery, gaps, tiers, lifetime value, cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as C
from tradewind.operators import ordering
from tradewind.operators import relational as R
from tradewind.plans import sales


def never_delivered_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with orders of whom none was delivered.

    One aggregate instead of an IN and a NOT IN over the orders.
    """
    waiting = (
        orders.groupBy("customer_id")
        .agg(F.bool_or(F.coalesce(F.col("status") == "DELIVERED", F.lit(False))).alias("_got"))
        .filter(~F.col("_got"))
    )
    return R.present_in(customers, waiting, "customer_id").select("customer_id", "customer_name")


def _gap_parts(orders: DataFrame) -> DataFrame:
    """Orders sorted by customer and date, each with the gap to the one before."""
    active = R.active_orders(orders).select("customer_id", "order_date", "order_id")
    parts = ordering.sorted_parts(active.filter(F.col("customer_id").isNotNull()), [
        F.col("customer_id").asc(), F.col("order_date").asc(), F.col("order_id").asc()])
    lagged = ordering.lag_in_parts(parts, ["customer_id"], "order_date", "previous_order_date")
    return lagged.withColumn("days_gap", C.days_between("order_date", "previous_order_date"))


def order_gap_risk(orders: DataFrame) -> DataFrame:
    """Every order with its gap; customers ordering less than monthly are at risk."""
    gaps = ordering.with_group_values(
        _gap_parts(orders), ["customer_id"], {"_mean": F.avg("days_gap")})
    return gaps.select(
        "customer_id", "order_date", "previous_order_date", "days_gap",
        C.risk_flag("_mean").alias("risk_flag"))


def reorder_risk_by_customer(orders: DataFrame) -> DataFrame:
    """Mean gap per customer; customers with a single order are left out."""
    return (
        _gap_parts(orders).groupBy("customer_id").agg(F.avg("days_gap").alias("_mean"))
        .filter(F.col("_mean").isNotNull())
        .select("customer_id", F.round("_mean", 2).alias("avg_days_gap"),
                C.risk_flag("_mean").alias("risk_flag"))
    )


def customer_tier_counts(
    items: DataFrame, orders: DataFrame, high: float = 10000, low: float = 5000
) -> DataFrame:
    """Customers per month and spending tier."""
    active = R.active_orders(orders).select(
        "order_id", "customer_id", C.month_key("order_date").alias("order_month"))
    monthly = (
        R.order_revenue(items).join(active, "order_id")
        .groupBy("customer_id", "order_month").agg(F.sum("revenue").alias("revenue"))
    )
    return (
        monthly.groupBy("order_month", C.tier("revenue", high, low).alias("category"))
        .agg(F.count("customer_id").alias("customer_count"))
    )


def ltv_quartiles(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers in four equal groups by lifetime value, best first."""
    value = sales.customer_revenue(items, orders, "_value")
    tiles = ordering.global_ntile(
        value, [F.col("_value").desc_nulls_last(), F.col("customer_id").asc()], 4, "quartile")
    return tiles.select(
        "customer_id", C.money("_value").alias("total_value"), "quartile",
        C.quartile_label("quartile").alias("quartile_label"))


def category_shift(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """First and last category each customer bought.

    First and last dates come from the orders that have lines, by a hash aggregate.
    Lines are then joined with the orders of those days only, and ``min_by`` and
    ``max_by`` over (date, item) decide between them; the products are looked up for
    two lines of a customer.
    """
    active = R.active_orders(orders).select("order_id", "customer_id", "order_date")
    filled = R.present_in(active, items, "order_id")
    edge = ordering.at_ends(filled, ["customer_id"], "order_date")
    bought = items.select("order_id", "item_id", "product_id").join(edge, "order_id")
    when = F.struct("order_date", "item_id")
    ends = bought.groupBy("customer_id").agg(
        F.min_by("product_id", when).alias("_first"), F.max_by("product_id", when).alias("_last"))
    first = products.select(
        F.col("product_id").alias("_first"), F.col("category").alias("first_category"))
    last = products.select(
        F.col("product_id").alias("_last"), F.col("category").alias("last_category"))
    return (
        ends.join(first, "_first").join(last, "_last")
        .select("customer_id", "first_category", "last_category", F.when(
            F.col("first_category") == F.col("last_category"), F.lit("No"))
            .otherwise(F.lit("Yes")).alias("category_shift"))
    )


def cohort_retention(orders: DataFrame, customers: DataFrame, months: int = 3) -> DataFrame:
    """Share of each registration month still ordering 0 to ``months`` months on.

    Only months with activity appear; orders before registration do not count.
    """
    cohort = customers.select(
        "customer_id", "registration_date", C.month_key("registration_date").alias("cohort_month"))
    sizes = cohort.groupBy("cohort_month").agg(F.count("customer_id").alias("cohort_size"))
    # one row per customer and month of activity before anything is joined
    active = (
        R.active_orders(orders)
        .select("customer_id", F.trunc(F.to_date("order_date"), "month").alias("_month"))
        .distinct()
    )
    since = C.month_distance("_month", "registration_date")
    retained = (
        active.join(cohort, "customer_id").withColumn("month_number", since)
        .filter(F.col("month_number").between(0, months))
        .groupBy("cohort_month", "month_number")
        .agg(F.count_distinct("customer_id").alias("retained_customers"))
    )
    return (
        retained.join(sizes, "cohort_month")
        .withColumn("retention_percent", C.ratio("retained_customers", "cohort_size"))
        .select("cohort_month", "cohort_size", "month_number", "retained_customers",
                "retention_percent", C.percent_text("retention_percent").alias("retention_rate"))
    )
