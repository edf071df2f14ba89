"""Cleaning of the four e-commerce tables, with a report of what was found."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as C
from tradewind.operators import quality as Q
from tradewind.session import stage


def clean_products(products: DataFrame) -> DataFrame:
    return products.withColumn("product_name", C.title_case("product_name"))


def clean_customers(customers: DataFrame) -> DataFrame:
    """Bad emails are only reported; an unreadable registration date drops the row."""
    return Q.normalise_date(customers, "registration_date")


def parsed_orders(orders: DataFrame) -> DataFrame:
    """Orders with a parsed date, and what the report asks of the text: ``_keyed`` and ``_day_first``."""
    return orders.withColumns({
        "_keyed": ~C.is_blank("customer_id"),
        "_day_first": F.coalesce(F.col("order_date").rlike(C.DAY_FIRST_PATTERN), F.lit(False)),
        "order_date": C.parse_timestamp("order_date")})


def clean_orders(orders: DataFrame, as_of: Column) -> DataFrame:
    """Known customer, readable date, not in the future."""
    keyed = parsed_orders(orders).filter("_keyed").drop("_keyed", "_day_first")
    return Q.drop_future(keyed, "order_date", as_of)


def clean_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Existing order and product, no zero quantities, discounts within 0..100."""
    known = Q.keep_referenced(items, orders, "order_id")
    known = Q.keep_referenced(known, products, "product_id")
    return Q.reset_out_of_range(Q.drop_zero_quantity(known), "discount_percent")


def _metrics(df: DataFrame, table: str, counts: Mapping[str, Column]) -> DataFrame:
    """One aggregate, turned into (table_name, metric, value) rows."""
    rows = [
        F.struct(F.lit(table).alias("table_name"), F.lit(m).alias("metric"),
                 F.coalesce(c, F.lit(0)).cast("long").alias("value"))
        for m, c in counts.items()]
    return df.agg(F.array(*rows).alias("_all")).select(F.inline("_all"))


def _report(raw: Mapping[str, DataFrame], parsed: DataFrame, orders: DataFrame, as_of: Column) -> DataFrame:
    """(table_name, metric, value) in the order of the cleaning steps.

    One pass per raw table: each rule becomes a flag and all flags of a table are
    counted together. Order dates are parsed once, in ``parsed``. Items meet the keys of
    orders and products in outer joins, whose hot keys Spark can split, and are read once.
    """
    name = F.col("product_name")
    product_rows = _metrics(raw["products"], "products", {
        "names_normalized": F.count_if(~name.eqNullSafe(C.title_case(name))),
        "total_products_cleaned": F.count(F.lit(1)),
    })
    customer_rows = _metrics(raw["customers"], "customers", {
        "invalid_emails": F.count_if(C.invalid_email("email")),
    })

    keyed, at = F.col("_keyed"), F.col("order_date")
    kept = orders.agg(F.count(F.lit(1))).scalar()
    order_rows = _metrics(parsed, "orders", {
        "null_customer_ids_dropped": F.count_if(~keyed),
        "wrong_date_formats_fixed": F.count_if(keyed & F.col("_day_first")),
        "unreadable_dates_dropped": F.count_if(keyed & at.isNull()),
        "future_dates_dropped": F.count_if(keyed & (at > as_of)),
        "missing_customer_orders_dropped": F.count_if(keyed & (at <= as_of)) - kept,
        "total_orders_cleaned": kept,
    })

    # staged: Spark splits a hot key in a join only if both sides come straight
    # out of a shuffle, not out of a distinct
    def keys(of: DataFrame, key: str) -> DataFrame:
        return stage(of.select(key).distinct(), f"{key}_keys").withColumn(f"_{key}", F.lit(True))

    flagged = (
        raw["order_items"].join(keys(orders, "order_id"), "order_id", "left")
        .join(keys(raw["products"], "product_id"), "product_id", "left")
        .withColumns({"_ordered": F.col("_order_id").isNotNull(),
                      "_kept": F.col("_order_id").isNotNull() & F.col("_product_id").isNotNull(),
                      "_zero": F.col("quantity").eqNullSafe(0)})
    )
    discount = F.col("discount_percent")
    item_rows = _metrics(flagged, "order_items", {
        "orphaned_items_dropped": F.count_if(~F.col("_ordered")),
        "zero_quantity_dropped": F.count_if(F.col("_kept") & F.col("_zero")),
        "invalid_discounts_reset": F.count_if(
            F.col("_kept") & ~F.col("_zero") & ((discount < 0) | (discount > 100))),
        "total_items_cleaned": F.count_if(F.col("_kept") & ~F.col("_zero")),
    })
    return reduce(DataFrame.unionByName, [product_rows, customer_rows, order_rows, item_rows])


class Cleaned:
    """The four cleaned tables and the report, each worked out when first asked for.

    Customers and orders are staged: both feed the tables below them and the
    report.
    """

    def __init__(self, raw: Mapping[str, DataFrame], as_of: Column):
        self.raw, self.as_of = raw, as_of

    @cached_property
    def products(self) -> DataFrame:
        return clean_products(self.raw["products"])

    @cached_property
    def customers(self) -> DataFrame:
        return stage(clean_customers(self.raw["customers"]), "customers")

    @cached_property
    def _parsed(self) -> DataFrame:
        return stage(parsed_orders(self.raw["orders"]), "parsed_orders")

    @cached_property
    def orders(self) -> DataFrame:
        keyed = self._parsed.filter("_keyed").drop("_keyed", "_day_first")
        orders = Q.drop_future(keyed, "order_date", self.as_of)
        return stage(Q.keep_referenced(orders, self.customers, "customer_id"), "orders")

    @cached_property
    def order_items(self) -> DataFrame:
        return clean_items(self.raw["order_items"], self.orders, self.products)

    @cached_property
    def report(self) -> DataFrame:
        return _report(self.raw, self._parsed, self.orders, self.as_of)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers, "products": self.products,
            "orders": self.orders, "order_items": self.order_items}


def clean_ecommerce(raw: Mapping[str, DataFrame], as_of: Column) -> Cleaned:
    """Clean products, customers, orders and items, in that order.

    ``raw`` holds ``customers``, ``products``, ``orders`` and ``order_items`` with
    dates as text; ``as_of`` is the moment that counts as now.
    """
    return Cleaned(raw, as_of)
