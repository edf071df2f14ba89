"""Scalar functions, each over every row of a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.catalog.entry import Entry
from tradewind.catalog.sql import money, percent_text, ratio
from tradewind.functions import columns as C


def _on_orders(out: Callable[[], Column]):
    return lambda r: r.orders.select("order_id", out().alias("result"))


def _on_items(out: Callable[[], Column]):
    return lambda r: r.items.select("item_id", out().alias("result"))


def _orders(sql: str) -> str:
    return f"SELECT order_id, {sql} AS result FROM shop_orders"


def _items(sql: str) -> str:
    return f"SELECT item_id, {sql} AS result FROM shop_items"


DATE = "order_date"

ENTRIES = [
    Entry("SC-01", "trim_text",
          lambda r: r.dirty["products"].select(
              "product_id", C.strip("product_name").alias("result")),
          "SELECT product_id, trim(product_name) AS result FROM dirty_products"),
    Entry("SC-02", "title_text",
          lambda r: r.customers.select("customer_id", C.title_case("email").alias("result")),
          """SELECT customer_id, array_to_string(list_transform(
               regexp_extract_all(lower(email), '[a-z]+|[^a-z]+'),
               lambda w: upper(w[1]) || w[2:]), '') AS result FROM shop_customers"""),
    Entry("SC-03", "regex_match",
          lambda r: r.customers.select("customer_id", C.invalid_email("email").alias("result")),
          r"""SELECT customer_id, NOT regexp_full_match(email, '[^@]+@[^@]+\.[^@]+') AS result
              FROM shop_customers"""),
    Entry("SC-04", "month_text", _on_orders(lambda: C.month_key(DATE)),
          _orders("strftime(order_date, '%Y-%m')")),
    Entry("SC-05", "year_and_month_number", _on_orders(lambda: F.year(DATE) * 100 + F.month(DATE)),
          _orders("year(order_date) * 100 + month(order_date)")),
    Entry("SC-06", "monday_week_text", _on_orders(lambda: C.week_key(DATE)),
          _orders("strftime(order_date, '%Y-W%W')")),
    Entry("SC-07", "date_of_timestamp",
          lambda r: r.table("events").select("event_id", F.to_date("ts").alias("result")),
          "SELECT event_id, CAST(ts AS DATE) AS result FROM events"),
    Entry("SC-08", "a_year_before", _on_orders(lambda: C.months_before(DATE, 12)),
          _orders("CAST(date_trunc('month', order_date) - INTERVAL 12 MONTH AS DATE) + CAST(day(order_date) - 1 AS INT)")),
    Entry("SC-09", "fractional_days",
          lambda r: r.table("events").select(
              "event_id", C.days_between("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
              .alias("result")),
          """SELECT event_id, CAST(ROUND(CAST(date_diff('second', date_trunc('day', ts), ts)
             / 86400.0 AS DECIMAL(18,6)), 2) AS DOUBLE) AS result FROM events"""),
    Entry("SC-10", "text_to_date",
          lambda r: r.orders.select("order_id", C.parse_date_text(
              F.date_format("order_date", "M/d/yyyy")).alias("result")),
          _orders("CAST(order_date AS DATE)")),
    Entry("SC-11", "year_of_date", _on_orders(lambda: F.year(DATE)), _orders("year(order_date)")),
    Entry("SC-12", "month_distance",
          lambda r: r.orders.join(r.customers, "customer_id").select(
              "order_id", C.month_distance("order_date", "registration_date").alias("result")),
          """SELECT order_id, (year(order_date) - year(registration_date)) * 12
             + month(order_date) - month(registration_date) AS result
             FROM shop_orders o JOIN shop_customers c ON o.customer_id = c.customer_id"""),
    Entry("SC-13", "rounded", _on_items(lambda: C.money(C.net_revenue())), _items(money("net"))),
    Entry("SC-14", "absolute", _on_items(lambda: F.abs("quantity")), _items("ABS(quantity)")),
    Entry("SC-15", "safe_division",
          lambda r: r.product_listing.select(
              "product_id", C.ratio("discount", "rating", 1).alias("result")),
          f"SELECT product_id, {ratio('discount', 'rating', '1')} AS result FROM product_listing"),
    Entry("SC-16", "searched_case", _on_items(lambda: C.tier(C.net_revenue(), 100000, 50000)),
          _items("CASE WHEN net > 100000 THEN 'High' WHEN net BETWEEN 50000 AND 100000 "
                 "THEN 'Medium' ELSE 'Low' END")),
    Entry("SC-17", "percent_text", _on_items(lambda: C.percent_text("discount_percent")),
          _items(percent_text("discount_percent"))),
    Entry("SC-18", "casts", _on_items(lambda: F.col("unit_price").cast("int").cast("string")),
          _items("CAST(CAST(FLOOR(unit_price) AS INT) AS VARCHAR)")),
    Entry("SC-19", "is_missing",
          lambda r: r.product_listing.select("product_id", F.col("discount").isNull()
                                             .alias("result")),
          "SELECT product_id, discount IS NULL AS result FROM product_listing"),
    Entry("SC-20", "signed_change",
          lambda r: r.items.select("item_id", C.change_text(
              "quantity", "discount_percent").alias("result")),
          _items("""CASE WHEN discount_percent = 0
                 THEN CASE WHEN quantity > 0 THEN '+100.00%' ELSE '0.00%' END
                 ELSE concat(CASE WHEN quantity > discount_percent THEN '+' ELSE '' END,
                   printf('%.2f', (CAST(quantity AS DOUBLE) - CAST(discount_percent AS DOUBLE))
                     / CAST(discount_percent AS DOUBLE) * 100), '%') END""")),
    Entry("SC-21", "shifted_date",
          _on_orders(lambda: F.date_sub(F.to_date(DATE), F.datediff(F.to_date(DATE),
                                                            F.lit("1995-01-01").cast("date")))),
          _orders("CAST(order_date AS DATE) - date_diff('day', DATE '1995-01-01', "
                  "CAST(order_date AS DATE))::INT")),
]
