"""Projections, filters, joins, subqueries, aggregates, sorting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.catalog.entry import Entry
from tradewind.catalog.sql import mean, money, ratio
from tradewind.catalog.views import Retail
from tradewind.functions import columns as C
from tradewind.operators import aggregates, baskets, ordering, quality
from tradewind.operators import relational as R
from tradewind.plans import customers, periods, sales

LINE = ["row_id", "order_id", "sales"]


def _star(r: Retail) -> DataFrame:
    return R.star_join(r.items, r.orders, r.products, [
        "item_id", "order_id", "customer_id", "category", "status",
        C.net_revenue().cast("decimal(28,6)").alias("net")])


def _one_sided(r: Retail) -> DataFrame:
    """An equality, a range and a date predicate on one table."""
    o = r.table("orders")
    return o.filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)
        & (F.col("o_orderdate") >= F.lit("1997-01-01").cast("date").cast("timestamp_ntz"))
    ).select("o_orderkey", "o_orderdate", "o_totalprice")


def _guard(r: Retail) -> DataFrame:
    """A branch for NULL before the other cases."""
    d = F.col("discount")
    label = F.when(d.isNull(), "unknown").when(d > 20, "high").otherwise("low")
    return r.product_listing.select("product_id", label.alias("discount_class"))


PROJECTIONS = [
    Entry("PR-01", "select_columns",
          lambda r: r.table("orders").select("o_orderkey", "o_custkey", "o_totalprice"),
          "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"),
    Entry("PR-02", "rename_columns",
          lambda r: R.rename(r.table("customer").select("c_custkey", "c_name", "c_acctbal"), {
              "c_name": "customer_name", "c_acctbal": "balance", "absent": "nothing"}),
          "SELECT c_custkey, c_name AS customer_name, c_acctbal AS balance FROM customer"),
    Entry("PR-03", "cast_columns",
          lambda r: R.cast(r.table("orders").select("o_orderkey", "o_custkey", "o_totalprice"), {
              "o_custkey": "string", "o_totalprice": "decimal(12,2)"}),
          """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
             CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice FROM orders"""),
    Entry("PR-04", "derive_difference",
          lambda r: R.with_total_amount(r.product_listing).select(
              "product_id", F.round("total_amount", 2).alias("total_amount")),
          """SELECT product_id, ROUND(initial_price - discount, 2) AS total_amount
             FROM product_listing"""),
    Entry("PR-05", "profit_flag",
          lambda r: R.with_profit_flag(r.sales(product=True), "profit").select(
              "row_id", "profit", "profit_flag"),
          """SELECT row_id, profit, CASE WHEN profit > 0 THEN 'Profitable' ELSE 'Loss' END
             AS profit_flag FROM sales_lines"""),
    Entry("PR-06", "profit_margin",
          lambda r: R.with_profit_margin(r.sales(product=True)).select("row_id", "profit_margin"),
          f"SELECT row_id, {ratio('profit', 'sales')} AS profit_margin FROM sales_lines"),
    Entry("PR-07", "net_revenue",
          lambda r: r.items.select("item_id", C.net_revenue().alias("net")),
          "SELECT item_id, net FROM shop_items"),
    Entry("PR-08", "filter_eq",
          lambda r: r.sales(product=True).filter(F.col("category") == "ECONOMY").select(LINE),
          "SELECT row_id, order_id, sales FROM sales_lines WHERE category = 'ECONOMY'"),
    Entry("PR-09", "filter_range",
          lambda r: r.product_listing.filter(F.col("initial_price") > 910).select(
              "product_id", "initial_price"),
          "SELECT product_id, initial_price FROM product_listing WHERE initial_price > 910"),
    Entry("PR-10", "filter_and",
          lambda r: r.sales(region=True, product=True).filter(
              (F.col("category") == "PROMO") & (F.col("region") == "ASIA")
              & (F.col("sales") > 100)).select(LINE),
          """SELECT row_id, order_id, sales FROM sales_lines
             WHERE category = 'PROMO' AND region = 'ASIA' AND sales > 100"""),
    Entry("PR-11", "filter_or",
          lambda r: r.sales(region=True, product=True).filter(
              (F.col("region") == "ASIA") | (F.col("category") == "PROMO")).select(LINE),
          """SELECT row_id, order_id, sales FROM sales_lines
             WHERE region = 'ASIA' OR category = 'PROMO'"""),
    Entry("PR-12", "filter_ne", lambda r: R.active_orders(r.orders),
          "SELECT order_id, customer_id, order_date, status FROM active_orders"),
    Entry("PR-13", "filter_between",
          lambda r: R.in_period(r.orders, "order_date", "1997-01-01", "1997-03-31"),
          """SELECT order_id, customer_id, order_date, status FROM shop_orders
             WHERE order_date BETWEEN TIMESTAMP '1997-01-01 00:00:00'
               AND TIMESTAMP '1997-03-31 23:59:59'"""),
    Entry("PR-14", "filter_date_window", lambda r: R.last_months(r.orders, "order_date", 12),
          """SELECT order_id, customer_id, order_date, status FROM shop_orders
             WHERE order_date >= CAST((SELECT MAX(order_date) FROM shop_orders) AS DATE)
               - INTERVAL 12 MONTH"""),
    Entry("PR-15", "filter_where_mysql", _one_sided,
          """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
             WHERE o_orderstatus = 'F' AND o_totalprice > 300000
               AND o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'"""),
    Entry("PR-16", "not_null_guard", _guard,
          """SELECT product_id, CASE WHEN discount IS NULL THEN 'unknown'
             WHEN discount > 20 THEN 'high' ELSE 'low' END AS discount_class
             FROM product_listing"""),
]

JOINS = [
    Entry("JN-01", "inner_equi",
          lambda r: r.orders.join(r.customers, "customer_id").select(
              "order_id", "customer_id", "customer_name", "status"),
          """SELECT order_id, o.customer_id, customer_name, status
             FROM shop_orders o JOIN shop_customers c ON o.customer_id = c.customer_id"""),
    Entry("JN-02", "star_join", _star,
          """SELECT item_id, i.order_id, customer_id, category, status,
             CAST(net AS DECIMAL(28,6)) AS net
             FROM shop_items i JOIN shop_orders o ON i.order_id = o.order_id
             JOIN shop_products p ON i.product_id = p.product_id"""),
    Entry("JN-03", "left_outer_self",
          lambda r: R.same_period_last_year(
              periods.monthly_revenue(r.items, r.orders), "_revenue", name="_before").select(
              "year", "month", C.money("_revenue").alias("revenue"),
              C.money("_before").alias("prev_year_revenue")),
          f"""SELECT a.y AS year, a.m AS month, {money('a.revenue')} AS revenue,
              {money('b.revenue')} AS prev_year_revenue
              FROM (SELECT year(order_date) AS y, month(order_date) AS m, SUM(net) AS revenue
                    FROM active_facts GROUP BY ALL) a
              LEFT JOIN (SELECT year(order_date) AS y, month(order_date) AS m,
                         SUM(net) AS revenue FROM active_facts GROUP BY ALL) b
              ON a.y = b.y + 1 AND a.m = b.m"""),
    Entry("JN-04", "self_join_theta",
          lambda r: baskets.bought_together(r.items, r.products, label="product_id", k=20),
          """SELECT a.product_id AS product_a, b.product_id AS product_b,
             COUNT(*) AS times_bought_together
             FROM all_items a JOIN all_items b
               ON a.order_id = b.order_id AND a.product_id < b.product_id
             GROUP BY ALL ORDER BY times_bought_together DESC, product_a, product_b LIMIT 20"""),
    Entry("JN-04", "pairs_per_order", lambda r: baskets.pairs_per_order(r.items),
          """SELECT o.order_id, COALESCE(n, 0) AS pairs
             FROM (SELECT DISTINCT order_id FROM all_items) o LEFT JOIN (
               SELECT a.order_id, COUNT(*) AS n FROM all_items a JOIN all_items b
               ON a.order_id = b.order_id AND a.product_id < b.product_id
               GROUP BY a.order_id) p ON o.order_id = p.order_id"""),
    Entry("JN-05", "cross_scalar",
          lambda r: R.with_share_of_total(
              r.table("customer").select("c_custkey", F.col("c_acctbal").cast("decimal(12,2)")
                                         .alias("balance")), "balance"),
          f"""SELECT c_custkey, balance, {ratio('balance', 'total')} AS share
              FROM (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS balance FROM customer)
              CROSS JOIN (SELECT SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS total FROM customer)"""),
    Entry("JN-06", "semi_in",
          lambda r: R.present_in(r.customers, r.orders.filter(F.col("status") == "RETURNED"),
                                 "customer_id"),
          """SELECT * FROM shop_customers WHERE customer_id IN
             (SELECT customer_id FROM shop_orders WHERE status = 'RETURNED')"""),
    Entry("JN-07", "anti_not_in",
          lambda r: R.absent_from(r.customers, r.orders.filter(F.col("status") == "DELIVERED"),
                                  "customer_id"),
          """SELECT * FROM shop_customers WHERE customer_id NOT IN
             (SELECT customer_id FROM shop_orders WHERE status = 'DELIVERED')"""),
    Entry("JN-08", "join_on_aggregate",
          lambda r: R.with_group_average(
              r.table("orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast(
                  "decimal(12,2)").alias("price")), "o_custkey", "price", "mean_price").select(
              "o_orderkey", "o_custkey", "price", "mean_price"),
          f"""SELECT o_orderkey, o.o_custkey, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
              mean_price FROM orders o JOIN (
                SELECT o_custkey, {mean('CAST(o_totalprice AS DECIMAL(12,2))', 6)} AS mean_price
                FROM orders GROUP BY o_custkey) m ON o.o_custkey = m.o_custkey"""),
]

SUBQUERIES = [
    Entry("SQ-01", "above_average_rows",
          lambda r: R.above_average(r.sales(), "sales").select(LINE),
          """SELECT row_id, order_id, sales FROM sales_lines
             WHERE sales > (SELECT CAST(SUM(sales) AS DOUBLE) / COUNT(sales) FROM sales_lines)"""),
    Entry("SQ-02", "max_row_per_key",
          lambda r: R.max_rows_per_key(r.sales(order=True), "customer_id", "sales").select(
              "customer_id", "order_id", "sales"),
          """SELECT customer_id, order_id, sales FROM sales_lines s
             WHERE sales = (SELECT MAX(sales) FROM sales_lines t
                            WHERE t.customer_id = s.customer_id)"""),
    Entry("SQ-03", "cte_single",
          lambda r: aggregates.sum_by_key(r.sales(order=True), "customer_id", "sales", "total_sales")
          .orderBy(F.col("total_sales").desc(), "customer_id"),
          "SELECT * FROM customer_sales ORDER BY total_sales DESC, customer_id"),
    Entry("SQ-04", "cte_chain",
          lambda r: customers.customer_tier_counts(r.items, r.orders, 100000, 20000),
          """SELECT order_month, category, COUNT(customer_id) AS customer_count FROM (
               SELECT customer_id, order_month, CASE WHEN revenue > 100000 THEN 'High'
                 WHEN revenue BETWEEN 20000 AND 100000 THEN 'Medium' ELSE 'Low' END AS category
               FROM (SELECT customer_id, strftime(order_date, '%Y-%m') AS order_month,
                     SUM(net) AS revenue FROM active_facts GROUP BY ALL))
             GROUP BY order_month, category"""),
    Entry("SQ-05", "scalar_over_cte",
          lambda r: sales.above_average_customers(r.sales(order=True)),
          """SELECT * FROM customer_sales WHERE total_sales >
             (SELECT CAST(SUM(total_sales) AS DOUBLE) / COUNT(*) FROM customer_sales)"""),
    Entry("SQ-06", "scalar_max_date",
          lambda r: R.last_months(r.orders, "order_date", 1).agg(
              F.count(F.lit(1)).alias("orders_in_last_month")),
          """SELECT COUNT(*) AS orders_in_last_month FROM shop_orders
             WHERE order_date >= CAST((SELECT MAX(order_date) FROM shop_orders) AS DATE)
               - INTERVAL 1 MONTH"""),
    Entry("SQ-07", "cte_self_reuse",
          lambda r: periods.yoy_revenue(r.items, r.orders).filter(
              F.col("growth_percent").isNotNull()).select("year", "month", "growth_percent"),
          f"""SELECT a.y AS year, a.m AS month,
              {ratio('a.revenue - b.revenue', 'b.revenue')} AS growth_percent
              FROM (SELECT year(order_date) AS y, month(order_date) AS m, SUM(net) AS revenue
                    FROM active_facts GROUP BY ALL) a
              JOIN (SELECT year(order_date) AS y, month(order_date) AS m,
                    SUM(net) AS revenue FROM active_facts GROUP BY ALL) b
              ON a.y = b.y + 1 AND a.m = b.m"""),
]

AGGREGATES = [
    Entry("AG-01", "global_stats", lambda r: aggregates.global_stats(r.sales(product=True)),
          f"""SELECT COUNT(*) AS total_orders, {mean('sales')} AS avg_sales,
              MIN(sales) AS min_sales, MAX(sales) AS max_sales, {mean('profit')} AS avg_profit,
              MIN(profit) AS min_profit, MAX(profit) AS max_profit FROM sales_lines"""),
    Entry("AG-02", "group_one_key",
          lambda r: aggregates.sales_summary(r.sales(product=True), ["category"]),
          f"""SELECT category, COUNT(*) AS order_count,
              CAST(SUM(sales) AS DECIMAL(28,4)) AS total_sales, {mean('profit')} AS avg_profit
              FROM sales_lines GROUP BY category"""),
    Entry("AG-03", "group_two_keys",
          lambda r: aggregates.sales_summary(
              r.sales(region=True, product=True), ["region", "sub_category"]),
          f"""SELECT region, sub_category, COUNT(*) AS order_count,
              CAST(SUM(sales) AS DECIMAL(28,4)) AS total_sales, {mean('profit')} AS avg_profit
              FROM sales_lines GROUP BY region, sub_category"""),
    Entry("AG-04", "sum_by_key",
          lambda r: aggregates.sum_by_key(r.sales(order=True), "customer_id", "sales", "total_sales"),
          "SELECT * FROM customer_sales"),
    Entry("AG-05", "count_distinct",
          lambda r: aggregates.distinct_per_key(r.sales(order=True), "customer_id", "order_id", "orders"),
          """SELECT customer_id, COUNT(DISTINCT order_id) AS orders FROM sales_lines
             GROUP BY customer_id"""),
    Entry("AG-06", "conditional_sum",
          lambda r: aggregates.signed_quantities(r.items, "product_id"),
          """SELECT product_id,
             CAST(SUM(CASE WHEN quantity > 0 THEN quantity ELSE 0 END) AS BIGINT)
               AS total_purchased,
             CAST(SUM(CASE WHEN quantity < 0 THEN ABS(quantity) ELSE 0 END) AS BIGINT)
               AS total_returned FROM all_items GROUP BY product_id"""),
    Entry("AG-07", "having",
          lambda r: quality.duplicate_keys(
              r.items, ["order_id", "product_id"], "lines"),
          """SELECT order_id, product_id, COUNT(*) AS lines FROM all_items
             GROUP BY order_id, product_id HAVING COUNT(*) > 1"""),
    Entry("AG-08", "rounded_agg",
          lambda r: r.items.groupBy("order_id").agg(
              C.money(F.sum(C.net_revenue())).alias("revenue")),
          f"SELECT order_id, {money('SUM(net)')} AS revenue FROM shop_items GROUP BY order_id"),
    Entry("AG-09", "count_column",
          lambda r: r.product_listing.groupBy("brand").agg(
              F.count("discount").alias("discounted"), F.count("final_price").alias("priced"),
              F.count(F.lit(1)).alias("listed")),
          """SELECT brand, COUNT(discount) AS discounted, COUNT(final_price) AS priced,
             COUNT(*) AS listed FROM product_listing GROUP BY brand"""),
    Entry("AG-10", "scalar_total",
          lambda r: aggregates.sum_by_key(r.sales(order=True), "customer_id", "sales", "total_sales").agg(
              F.sum("total_sales").cast("decimal(28,4)").alias("all_sales"),
              C.mean_of(F.sum("total_sales"), F.count("total_sales")).alias("mean_sales"),
              F.max("total_sales").alias("best_sales")),
          f"""SELECT CAST(SUM(total_sales) AS DECIMAL(28,4)) AS all_sales,
              {mean('total_sales')} AS mean_sales, MAX(total_sales) AS best_sales
              FROM customer_sales"""),
    Entry("AG-11", "avg_skip_null",
          lambda r: r.product_listing.groupBy("brand").agg(
              F.round(F.avg("discount"), 4).alias("mean_discount"),
              F.avg("final_price").alias("mean_final_price")),
          """SELECT brand, ROUND(AVG(discount), 4) AS mean_discount,
             AVG(final_price) AS mean_final_price FROM product_listing GROUP BY brand"""),
    Entry("AG-12", "group_by_expression",
          lambda r: r.orders.groupBy(C.month_key("order_date").alias("order_month")).agg(
              F.count(F.lit(1)).alias("order_count")),
          """SELECT strftime(order_date, '%Y-%m') AS order_month, COUNT(*) AS order_count
             FROM shop_orders GROUP BY order_month"""),
]

SORTING = [
    Entry("SL-01", "sort_desc", lambda r: r.table("orders").select(
        "o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey"),
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey"),
    Entry("SL-01", "sort_asc", lambda r: r.table("orders").select(
        "o_orderkey", "o_totalprice").orderBy(
            F.col("o_totalprice").asc_nulls_first(), "o_orderkey"),
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey"),
    Entry("SL-02", "sort_multi", lambda r: r.orders.orderBy(
        F.col("status").asc(), F.col("order_date").desc(), F.col("order_id").asc()),
        """SELECT order_id, customer_id, order_date, status FROM shop_orders
           ORDER BY status, order_date DESC, order_id"""),
    Entry("SL-03", "top_k", lambda r: ordering.top_k(
        r.sales().select(LINE), [F.col("sales").desc(), F.col("row_id").asc()], 20),
        """SELECT row_id, order_id, sales FROM sales_lines
           ORDER BY sales DESC, row_id LIMIT 20"""),
    Entry("SL-04", "limit", lambda r: quality.preview(
        r.customers.select("customer_id", "customer_name"), 10, [F.col("customer_id").asc()]),
        "SELECT customer_id, customer_name FROM shop_customers ORDER BY customer_id LIMIT 10"),
    Entry("ST-01", "distinct", lambda r: quality.drop_duplicates(r.sales(region=True).select(
        "customer_id", "region", "ship_mode")),
        "SELECT DISTINCT customer_id, region, ship_mode FROM sales_lines"),
]

ENTRIES = PROJECTIONS + JOINS + SUBQUERIES + AGGREGATES + SORTING
