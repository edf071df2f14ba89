"""Table layouts and the constraints declared on them."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
PERCENT = T.DecimalType(5, 2)

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("customer_name", T.StringType(), False),
    T.StructField("email", T.StringType()),
    T.StructField("registration_date", T.DateType(), False),
    T.StructField("customer_type", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("subcategory", T.StringType(), False),
    T.StructField("cost_price", MONEY),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("order_date", T.TimestampNTZType(), False),
    T.StructField("status", T.StringType()),
    T.StructField("region_code", T.StringType()),
])

ORDER_ITEMS = T.StructType([
    T.StructField("item_id", T.StringType(), False),
    T.StructField("order_id", T.StringType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY),
    T.StructField("discount_percent", PERCENT),
])

# The flat sales listing as delivered: dates are M/d/yyyy text.
SALES_RAW = T.StructType([
    T.StructField("row_id", T.IntegerType()),
    *[T.StructField(c, T.StringType()) for c in (
        "order_id", "order_date", "ship_date", "ship_mode", "customer_id",
        "customer_name", "segment", "country", "city", "state", "postal_code",
        "region", "product_id", "category", "sub_category", "product_name")],
    T.StructField("sales", T.DecimalType(12, 4)),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount", T.DecimalType(5, 4)),
    T.StructField("profit", T.DecimalType(12, 4)),
])

CUSTOMER_BATCH = T.StructType([
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("updated_at", T.DateType()),
])

SCHEMAS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
}

PRIMARY_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "item_id",
}

# child table, column, parent table
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
]

# Rule name to SQL condition, per table. As with an SQL CHECK, an unknown
# (NULL) outcome passes.
CHECKS = {
    "customers": {"customer_type": "customer_type IN ('REGULAR', 'PREMIUM', 'VIP')"},
    "products": {"cost_price": "cost_price >= 0"},
    "orders": {
        "status": "status IN ('PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')",
    },
    "order_items": {
        "quantity": "quantity <> 0",
        "unit_price": "unit_price >= 0",
        "discount_percent": "discount_percent >= 0 AND discount_percent <= 100",
    },
}


def required_columns(schema: T.StructType) -> list[str]:
    """The NOT NULL columns of a layout."""
    return [f.name for f in schema.fields if not f.nullable]
