"""Window functions over whole tables and over groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.catalog.entry import Entry
from tradewind.catalog.sql import money
from tradewind.catalog.views import Retail
from tradewind.functions import columns as C
from tradewind.operators import ordering


def _lines(r: Retail) -> DataFrame:
    return r.sales(order=True).select("row_id", "customer_id", "sales")


def _running(r: Retail) -> DataFrame:
    """Running order value per status: a handful of groups with very many rows."""
    orders = r.orders.join(
        r.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("price")), "order_id")
    total = ordering.running_total(
        orders, ["status"], [F.col("order_date").asc(), F.col("order_id").asc()],
        "price", "_total")
    return total.select("status", "order_id", "price", C.money("_total").alias("running_total"))


ENTRIES = [
    Entry("WN-01", "global_row_number",
          lambda r: ordering.global_row_number(
              _lines(r), [F.col("sales").desc_nulls_last(), F.col("row_id").asc()], "row_num"),
          """SELECT row_id, customer_id, sales,
             ROW_NUMBER() OVER (ORDER BY sales DESC, row_id) AS row_num FROM sales_lines"""),
    Entry("WN-02", "global_rank",
          lambda r: ordering.global_rank(_lines(r), "sales", "sales_rank"),
          """SELECT row_id, customer_id, sales, RANK() OVER (ORDER BY sales DESC) AS sales_rank
             FROM sales_lines"""),
    Entry("WN-03", "global_dense_rank",
          lambda r: ordering.global_dense_rank(_lines(r), "sales", "dense_rank_no"),
          """SELECT row_id, customer_id, sales,
             DENSE_RANK() OVER (ORDER BY sales DESC) AS dense_rank_no FROM sales_lines"""),
    Entry("WN-04", "rank_in_group",
          lambda r: ordering.rank_in_group(
              r.sales(product=True).select("row_id", "category", "sales"),
              ["category"], "sales", "rank_in_category"),
          """SELECT row_id, category, sales, DENSE_RANK() OVER (
             PARTITION BY category ORDER BY sales DESC) AS rank_in_category FROM sales_lines"""),
    Entry("WN-05", "running_total", _running,
          f"""SELECT status, order_id, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
              {money('''SUM(CAST(o_totalprice AS DECIMAL(12,2))) OVER (PARTITION BY status
                ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING)''')} AS running_total
              FROM shop_orders JOIN orders ON order_id = o_orderkey"""),
    Entry("WN-06", "global_cumulative",
          lambda r: ordering.global_cumulative(
              r.items.select("item_id", "unit_price", F.col("quantity").cast("long")
                             .alias("quantity")), "unit_price", "quantity", "upto"),
          """SELECT item_id, unit_price, CAST(quantity AS BIGINT) AS quantity,
             CAST(SUM(quantity) OVER (ORDER BY unit_price DESC) AS BIGINT) AS upto
             FROM all_items"""),
    Entry("WN-07", "lag_per_key",
          lambda r: ordering.lag_in_group(
              r.orders.select("customer_id", "order_id", "order_date"), ["customer_id"],
              [F.col("order_date").asc(), F.col("order_id").asc()], "order_date",
              "previous_order_date"),
          """SELECT customer_id, order_id, order_date, LAG(order_date) OVER (
             PARTITION BY customer_id ORDER BY order_date, order_id) AS previous_order_date
             FROM shop_orders"""),
    Entry("WN-08", "ntile_global",
          lambda r: ordering.global_ntile(
              r.table("orders").select("o_orderkey", "o_totalprice"),
              [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()], 7, "tile"),
          """SELECT o_orderkey, o_totalprice,
             NTILE(7) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS tile FROM orders"""),
    Entry("WN-09", "first_last_per_key",
          lambda r: ordering.first_last(
              r.orders, ["customer_id"], ["order_date", "order_id"], "status",
              "first_status", "last_status"),
          """SELECT customer_id, MAX(status) FILTER (WHERE a = 1) AS first_status,
             MAX(status) FILTER (WHERE d = 1) AS last_status FROM (
               SELECT customer_id, status,
                 ROW_NUMBER() OVER (PARTITION BY customer_id
                   ORDER BY order_date, order_id) AS a,
                 ROW_NUMBER() OVER (PARTITION BY customer_id
                   ORDER BY order_date DESC, order_id DESC) AS d FROM shop_orders)
             GROUP BY customer_id"""),
    Entry("WN-10", "top_n_per_group",
          lambda r: ordering.top_n_per_group(
              r.sales(product=True).select("row_id", "category", "sales"),
              ["category"], "sales", 3, "rank_in_category"),
          """SELECT * FROM (SELECT row_id, category, sales, DENSE_RANK() OVER (
             PARTITION BY category ORDER BY sales DESC) AS rank_in_category FROM sales_lines)
             WHERE rank_in_category <= 3"""),
]
