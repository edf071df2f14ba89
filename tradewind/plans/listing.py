"""End-to-end jobs over the flat sales listing, and its split into a star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as C
from tradewind.operators import aggregates, quality
from tradewind.operators import relational as R
from tradewind.session import stage

# Headers of the delivered file and the names used here.
HEADERS = {
    "Order ID": "order_id", "Customer Name": "customer_name", "Product Name": "product_name",
    "Sub-Category": "sub_category", "Postal Code": "postal_code", "Order Date": "order_date",
}
CUSTOMER_ATTRIBUTES = (
    "customer_name", "segment", "country", "city", "state", "postal_code", "region")
PRODUCT_ATTRIBUTES = ("product_name", "category", "sub_category")


def sales_above(raw: DataFrame, minimum: float = 50) -> DataFrame:
    """Distinct complete rows above ``minimum``, summed by region and category."""
    complete = quality.drop_null_rows(quality.drop_duplicates(raw))
    kept = complete.filter(F.col("sales") > minimum)
    return aggregates.sales_summary(kept, ["region", "category"])


def transform_listing(df: DataFrame) -> DataFrame:
    """Plain column names, postal codes as text, parsed order date and its year."""
    named = R.cast(R.rename(df, HEADERS), {"postal_code": "string"})
    return (
        named.withColumn("order_date_parsed", C.parse_date_text("order_date"))
        .withColumn("order_year", F.year("order_date_parsed"))
    )


def profitable_in_region(raw: DataFrame, region: str) -> DataFrame:
    """Profitable lines of one region, ready for export."""
    filled = quality.fill_nulls(raw, {"discount": 0})
    named = R.cast(
        R.rename(filled, {"sales": "total_sales", "profit": "net_profit"}),
        {"net_profit": "double"})
    flagged = R.with_profit_flag(named, "net_profit")
    return flagged.filter((F.col("region") == region) & (F.col("net_profit") > 0)).select(
        "order_id", "customer_name", "region", "category", "product_name", "quantity",
        "total_sales", "net_profit", "profit_flag")


def category_view(df: DataFrame, category: str) -> DataFrame:
    """One category, four columns, profit under its report name."""
    return R.rename(
        df.filter(F.col("category") == category)
        .select("order_id", "customer_name", "product_name", "profit"),
        {"profit": "net_profit"})


def split_listing(raw: DataFrame, policy: str = "first") -> dict[str, DataFrame]:
    """``star_schema`` for a caller that uses all three tables: the listing is worked out once and staged."""
    needed = dict.fromkeys(["row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id", "sales",
                            "quantity", "discount", "profit", *CUSTOMER_ATTRIBUTES, *PRODUCT_ATTRIBUTES])
    return star_schema(stage(raw.select(*needed), "listing", "zstd"), policy, quality.drop_few_duplicates)


def star_schema(
    raw: DataFrame, policy: str = "first", distinct: Callable[[DataFrame], DataFrame] = quality.drop_duplicates
) -> dict[str, DataFrame]:
    """Split the flat listing into customers, products and orders.

    Dates become dates, amounts two-decimal numbers. ``policy`` says what happens
    to a customer or product listed with several attribute combinations (see
    ``quality.build_dimension``), ``distinct`` drops the copies of an order line.
    """
    amounts = {"sales": "decimal(10,2)", "discount": "decimal(5,2)", "profit": "decimal(10,2)"}
    orders = raw.select(
        "row_id", "order_id", C.parse_date_text("order_date").alias("order_date"),
        C.parse_date_text("ship_date").alias("ship_date"), "ship_mode", "customer_id",
        "product_id", F.col("sales").cast(amounts["sales"]).alias("sales"), "quantity",
        F.col("discount").cast(amounts["discount"]).alias("discount"),
        F.col("profit").cast(amounts["profit"]).alias("profit"))
    orders = distinct(orders)
    return {
        "customers": quality.build_dimension(raw, "customer_id", CUSTOMER_ATTRIBUTES, policy),
        "products": quality.build_dimension(raw, "product_id", PRODUCT_ATTRIBUTES, policy),
        "orders": orders,
    }
