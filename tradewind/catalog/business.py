"""The business questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.catalog.entry import Entry
from tradewind.catalog.sql import mean, money, percent_text, ratio
from tradewind.catalog.views import Retail
from tradewind.operators import aggregates, baskets
from tradewind.plans import customers, listing, periods, sales
from tradewind.session import scratch_path
from tradewind.sources import files

# Fixed period of the report queries; thresholds that fit the driver amounts.
START, END = "1997-01-01", "1997-06-30"
WAS_START, WAS_END = periods.previous_period(START, END)
HIGH, LOW = 200000, 100000


def _between(start: str, end: str) -> str:
    return (f"order_date BETWEEN TIMESTAMP '{start} 00:00:00' AND TIMESTAMP '{end} 23:59:59'")


_REVENUE_BY_NAME = f"""SELECT category, product_name, {money('SUM(net)')} AS total_revenue
  FROM active_facts f JOIN shop_products p ON f.product_id = p.product_id
  GROUP BY category, product_name"""

_GAPS = """SELECT customer_id, order_date, previous_order_date,
  ROUND(date_diff('second', previous_order_date, order_date) / 86400.0, 2) AS days_gap
  FROM (SELECT customer_id, order_date, LAG(order_date) OVER (
          PARTITION BY customer_id ORDER BY order_date) AS previous_order_date
        FROM active_orders)"""

_MONTHLY = """SELECT year(order_date) AS y, month(order_date) AS m, SUM(net) AS revenue
  FROM active_facts GROUP BY ALL"""


def _breakdown_sql(key: str) -> str:
    return f"""SELECT {key} AS period_key, COUNT(DISTINCT order_id) AS total_orders,
      {money('SUM(net)')} AS revenue, COUNT(DISTINCT customer_id) AS unique_customers
      FROM active_facts WHERE {_between(START, END)} GROUP BY period_key"""


def _change_sql() -> str:
    return """CASE WHEN previous_period = 0
        THEN CASE WHEN current_period > 0 THEN '+100.00%' ELSE '0.00%' END
      ELSE concat(CASE WHEN current_period > previous_period THEN '+' ELSE '' END,
        printf('%.2f', (CAST(current_period AS DOUBLE) - CAST(previous_period AS DOUBLE))
          / CAST(previous_period AS DOUBLE) * 100), '%') END"""


def _count_sql(what: str, start: str, end: str) -> str:
    return (f"(SELECT CAST(COUNT(DISTINCT {what}) AS DECIMAL(28,2)) FROM shop_orders "
            f"WHERE {_between(start, end)})")


def _revenue_sql(start: str, end: str) -> str:
    return (f"(SELECT COALESCE({money('SUM(net)')}, 0) FROM active_facts "
            f"WHERE {_between(start, end)})")


_SUMMARY = f"""SELECT metric, current_period, previous_period, {_change_sql()} AS change FROM (
  SELECT 'Total Orders' AS metric, {_count_sql('order_id', START, END)} AS current_period,
    {_count_sql('order_id', WAS_START, WAS_END)} AS previous_period
  UNION ALL SELECT 'Total Revenue ($)', {_revenue_sql(START, END)},
    {_revenue_sql(WAS_START, WAS_END)}
  UNION ALL SELECT 'Unique Customers', {_count_sql('customer_id', START, END)},
    {_count_sql('customer_id', WAS_START, WAS_END)})"""


def _region_sql(keys: str, where: str = "") -> str:
    return f"""SELECT {keys}, COUNT(*) AS order_count,
      CAST(SUM(sales) AS DECIMAL(28,4)) AS total_sales, {mean('profit')} AS avg_profit
      FROM sales_lines {where} GROUP BY {keys}"""


def _exported(r: Retail) -> DataFrame:
    """Profitable lines of one region, written as CSV and parquet and read back."""
    lines = listing.profitable_in_region(r.sales(raw=True), "ASIA")
    written = files.write_parquet(lines, scratch_path(r.spark, "profitable"))
    files.write_csv(written, scratch_path(r.spark, "profitable_csv"))
    return written.withColumn("net_profit", F.round("net_profit", 4))


ENTRIES = [
    Entry("BQ-01", "revenue_by_category",
          lambda r: sales.revenue_by_category(r.items, r.orders, r.products),
          f"""SELECT category, {money('SUM(net)')} AS total_revenue
              FROM active_facts f JOIN shop_products p ON f.product_id = p.product_id
              GROUP BY category"""),
    Entry("BQ-02", "top_customers",
          lambda r: sales.top_customers(r.items, r.orders, r.customers),
          f"""SELECT c.customer_id, customer_name, {money('revenue')} AS total_order_value
              FROM customer_value v JOIN shop_customers c ON v.customer_id = c.customer_id
              ORDER BY total_order_value DESC, c.customer_id LIMIT 10"""),
    Entry("BQ-03", "monthly_orders_last_12", lambda r: periods.monthly_orders(r.orders),
          """SELECT strftime(order_date, '%Y-%m') AS order_month,
             COUNT(DISTINCT order_id) AS order_count FROM shop_orders
             WHERE order_date >= CAST((SELECT MAX(order_date) FROM shop_orders) AS DATE)
               - INTERVAL 12 MONTH GROUP BY order_month"""),
    Entry("BQ-04", "never_delivered_customers",
          lambda r: customers.never_delivered_customers(r.orders, r.customers),
          """SELECT customer_id, customer_name FROM shop_customers
             WHERE customer_id IN (SELECT customer_id FROM shop_orders)
               AND customer_id NOT IN
                 (SELECT customer_id FROM shop_orders WHERE status = 'DELIVERED')"""),
    Entry("BQ-05", "more_returned_than_bought",
          lambda r: sales.more_returned_than_bought(r.items, r.products),
          """SELECT * FROM (SELECT p.product_id, product_name,
               CAST(SUM(CASE WHEN quantity > 0 THEN quantity ELSE 0 END) AS BIGINT)
                 AS total_purchased,
               CAST(SUM(CASE WHEN quantity < 0 THEN ABS(quantity) ELSE 0 END) AS BIGINT)
                 AS total_returned
               FROM all_items i JOIN shop_products p ON i.product_id = p.product_id
               GROUP BY p.product_id, product_name) WHERE total_returned > total_purchased"""),
    Entry("BQ-06", "return_rate_by_category",
          lambda r: sales.return_rate_by_category(r.items, r.products),
          f"""SELECT *, {percent_text('return_percent')} AS return_rate FROM (
               SELECT *, {ratio('total_returned', 'total_purchased')} AS return_percent FROM (
                 SELECT category,
                   CAST(SUM(CASE WHEN quantity > 0 THEN quantity ELSE 0 END) AS BIGINT)
                     AS total_purchased,
                   CAST(SUM(CASE WHEN quantity < 0 THEN ABS(quantity) ELSE 0 END) AS BIGINT)
                     AS total_returned
                 FROM all_items i JOIN shop_products p ON i.product_id = p.product_id
                 GROUP BY category))"""),
    Entry("BQ-07", "running_total_by_region",
          lambda r: sales.running_total_by_region(r.items, r.orders_with_region),
          f"""SELECT region_code, order_date, daily_revenue, {money('''SUM(daily_revenue) OVER (
                PARTITION BY region_code ORDER BY order_date ROWS UNBOUNDED PRECEDING)''')}
                AS running_total
              FROM (SELECT region_code, CAST(order_date AS DATE) AS order_date,
                    {money('SUM(net)')} AS daily_revenue FROM active_facts GROUP BY ALL)"""),
    Entry("BQ-08", "product_rank_in_category",
          lambda r: sales.product_rank_in_category(r.items, r.orders, r.products),
          f"""SELECT *, DENSE_RANK() OVER (PARTITION BY category ORDER BY total_revenue DESC)
              AS rank_in_category FROM ({_REVENUE_BY_NAME})"""),
    Entry("BQ-09", "order_gap_risk", lambda r: customers.order_gap_risk(r.orders),
          f"""SELECT *, CASE WHEN AVG(days_gap) OVER (PARTITION BY customer_id) > 30
              THEN 'At Risk' ELSE 'Normal' END AS risk_flag FROM ({_GAPS})"""),
    Entry("BQ-10", "customer_tier_counts",
          lambda r: customers.customer_tier_counts(r.items, r.orders, HIGH, LOW),
          f"""SELECT order_month, CASE WHEN revenue > {HIGH} THEN 'High'
                WHEN revenue BETWEEN {LOW} AND {HIGH} THEN 'Medium' ELSE 'Low' END AS category,
                COUNT(customer_id) AS customer_count
              FROM (SELECT customer_id, strftime(order_date, '%Y-%m') AS order_month,
                    SUM(net) AS revenue FROM active_facts GROUP BY ALL) GROUP BY ALL"""),
    Entry("BQ-11", "ltv_quartiles", lambda r: customers.ltv_quartiles(r.items, r.orders),
          f"""SELECT customer_id, {money('revenue')} AS total_value, quartile,
              CASE quartile WHEN 1 THEN 'Platinum' WHEN 2 THEN 'Gold' WHEN 3 THEN 'Silver'
                ELSE 'Bronze' END AS quartile_label
              FROM (SELECT *, NTILE(4) OVER (ORDER BY revenue DESC, customer_id) AS quartile
                    FROM customer_value)"""),
    Entry("BQ-12", "yoy_revenue", lambda r: periods.yoy_revenue(r.items, r.orders),
          f"""SELECT *, COALESCE({percent_text('growth_percent')}, 'N/A') AS yoy_growth_percent
              FROM (SELECT a.y AS year, a.m AS month, {money('a.revenue')} AS revenue,
                      {money('b.revenue')} AS prev_year_revenue,
                      {ratio('a.revenue - b.revenue', 'b.revenue')} AS growth_percent
                    FROM ({_MONTHLY}) a LEFT JOIN ({_MONTHLY}) b
                      ON a.y = b.y + 1 AND a.m = b.m)"""),
    Entry("BQ-13", "category_shift",
          lambda r: customers.category_shift(r.items, r.orders, r.products),
          """SELECT customer_id, first_category, last_category,
               CASE WHEN first_category = last_category THEN 'No' ELSE 'Yes' END AS category_shift
             FROM (SELECT customer_id, MAX(category) FILTER (WHERE a = 1) AS first_category,
                     MAX(category) FILTER (WHERE d = 1) AS last_category
                   FROM (SELECT customer_id, category,
                           ROW_NUMBER() OVER (PARTITION BY customer_id
                             ORDER BY order_date, item_id) AS a,
                           ROW_NUMBER() OVER (PARTITION BY customer_id
                             ORDER BY order_date DESC, item_id DESC) AS d
                         FROM active_facts f JOIN shop_products p ON f.product_id = p.product_id)
                   GROUP BY customer_id)"""),
    Entry("BQ-14", "revenue_concentration",
          lambda r: sales.revenue_concentration(r.items, r.orders),
          f"""SELECT *, {percent_text('cumulative_share')} AS cumulative_percent FROM (
                SELECT customer_id, {money('revenue')} AS revenue,
                  {money('upto')} AS cumulative_revenue,
                  {ratio('upto', 'grand_total')} AS cumulative_share
                FROM (SELECT customer_id, revenue,
                        SUM(revenue) OVER (ORDER BY revenue DESC) AS upto,
                        SUM(revenue) OVER () AS grand_total FROM customer_value))"""),
    Entry("BQ-15", "cohort_retention",
          lambda r: customers.cohort_retention(r.orders, r.customers),
          f"""SELECT *, {percent_text('retention_percent')} AS retention_rate FROM (
                SELECT r.cohort_month, cohort_size, month_number, retained_customers,
                  {ratio('retained_customers', 'cohort_size')} AS retention_percent
                FROM (SELECT strftime(registration_date, '%Y-%m') AS cohort_month,
                        (year(order_date) - year(registration_date)) * 12
                          + month(order_date) - month(registration_date) AS month_number,
                        COUNT(DISTINCT o.customer_id) AS retained_customers
                      FROM active_orders o JOIN shop_customers c
                        ON o.customer_id = c.customer_id GROUP BY ALL) r
                JOIN (SELECT strftime(registration_date, '%Y-%m') AS cohort_month,
                        COUNT(customer_id) AS cohort_size FROM shop_customers GROUP BY ALL) s
                  ON r.cohort_month = s.cohort_month
                WHERE month_number BETWEEN 0 AND 3)"""),
    Entry("BQ-16", "bought_together", lambda r: baskets.bought_together(r.items, r.products),
          """SELECT p.product_name AS product_a, q.product_name AS product_b,
               COUNT(*) AS times_bought_together
             FROM all_items a JOIN all_items b
               ON a.order_id = b.order_id AND a.product_id < b.product_id
             JOIN shop_products p ON a.product_id = p.product_id
             JOIN shop_products q ON b.product_id = q.product_id
             GROUP BY ALL ORDER BY times_bought_together DESC, product_a, product_b LIMIT 20"""),
    Entry("BQ-17", "top3_products_per_category",
          lambda r: sales.top_products_per_category(r.items, r.orders, r.products),
          f"""SELECT * FROM (SELECT *, DENSE_RANK() OVER (
                PARTITION BY category ORDER BY total_revenue DESC) AS rank_in_category
              FROM ({_REVENUE_BY_NAME})) WHERE rank_in_category <= 3"""),
    Entry("BQ-18", "reorder_risk_by_customer",
          lambda r: customers.reorder_risk_by_customer(r.orders),
          f"""SELECT customer_id, ROUND(AVG(days_gap), 2) AS avg_days_gap,
              CASE WHEN AVG(days_gap) > 30 THEN 'At Risk' ELSE 'Normal' END AS risk_flag
              FROM ({_GAPS}) GROUP BY customer_id HAVING COUNT(days_gap) > 0"""),
    Entry("BQ-20", "sales_per_customer",
          lambda r: aggregates.sum_by_key(r.sales(order=True), "customer_id", "sales", "total_sales")
          .orderBy(F.col("total_sales").desc(), "customer_id"),
          "SELECT * FROM customer_sales"),
    Entry("BQ-21", "profit_per_customer",
          lambda r: aggregates.sum_by_key(
              r.sales(order=True, product=True), "customer_id", "profit", "total_profit")
          .orderBy(F.col("total_profit").desc(), "customer_id"),
          """SELECT customer_id, CAST(SUM(profit) AS DECIMAL(28,4)) AS total_profit
             FROM sales_lines GROUP BY customer_id"""),
    Entry("BQ-22", "customer_rank", lambda r: sales.rank_customers(r.sales(order=True), r.customers),
          """SELECT c.customer_id, customer_name, total_sales,
             RANK() OVER (ORDER BY total_sales DESC) AS customer_rank
             FROM customer_sales s JOIN shop_customers c ON s.customer_id = c.customer_id"""),
    Entry("BQ-23", "top10_customers", lambda r: sales.extreme_customers(r.sales(order=True), 10, True),
          "SELECT * FROM customer_sales ORDER BY total_sales DESC, customer_id LIMIT 10"),
    Entry("BQ-23", "bottom10_customers", lambda r: sales.extreme_customers(r.sales(order=True), 10, False),
          "SELECT * FROM customer_sales ORDER BY total_sales, customer_id LIMIT 10"),
    Entry("BQ-24", "single_order_customers",
          lambda r: aggregates.keys_with_single(
              r.sales(order=True), "customer_id", "order_id", "total_orders"),
          """SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders FROM sales_lines
             GROUP BY customer_id HAVING COUNT(DISTINCT order_id) = 1"""),
    Entry("BQ-25", "above_average_customers",
          lambda r: sales.above_average_customers(r.sales(order=True)),
          """SELECT * FROM customer_sales WHERE total_sales >
             (SELECT CAST(SUM(total_sales) AS DOUBLE) / COUNT(*) FROM customer_sales)"""),
    Entry("BQ-26", "region_summary",
          lambda r: aggregates.sales_summary(r.sales(region=True, product=True), ["region"]),
          _region_sql("region")),
    Entry("BQ-27", "category_summary",
          lambda r: aggregates.sales_summary(r.sales(product=True), ["category", "sub_category"]),
          _region_sql("category, sub_category")),
    Entry("BQ-28", "sales_over_50", lambda r: listing.sales_above(r.sales(raw=True), 50),
          _region_sql("region, category", "WHERE sales > 50")),
    Entry("BQ-29", "profit_by_region",
          lambda r: sales.profit_by_region(r.sales(region=True, product=True)),
          f"""SELECT region, {money('SUM(profit)')} AS total_profit,
              COUNT(order_id) AS order_count FROM sales_lines GROUP BY region"""),
    Entry("BQ-30", "period_breakdown_daily",
          lambda r: periods.period_breakdown(r.items, r.orders, "daily", START, END),
          _breakdown_sql("strftime(order_date, '%Y-%m-%d')")),
    Entry("BQ-30", "period_breakdown_weekly",
          lambda r: periods.period_breakdown(r.items, r.orders, "weekly", START, END),
          _breakdown_sql("strftime(order_date, '%Y-W%W')")),
    Entry("BQ-30", "period_breakdown_monthly",
          lambda r: periods.period_breakdown(r.items, r.orders, "monthly", START, END),
          _breakdown_sql("strftime(order_date, '%Y-%m')")),
    Entry("BQ-31", "period_summary",
          lambda r: periods.period_summary(r.items, r.orders, START, END), _SUMMARY),
    Entry("BQ-32", "period_top_products",
          lambda r: periods.period_top_products(r.items, r.orders, r.products, START, END),
          f"""SELECT p.product_id, product_name, CAST(SUM(quantity) AS BIGINT) AS total_qty,
              {money('SUM(net)')} AS total_revenue
              FROM active_facts f JOIN shop_products p ON f.product_id = p.product_id
              WHERE {_between(START, END)} GROUP BY p.product_id, product_name
              ORDER BY total_revenue DESC, p.product_id LIMIT 3"""),
    Entry("BQ-33", "west_profit", _exported,
          """SELECT order_id, customer_name, region, category, product_name, quantity,
             sales AS total_sales, ROUND(CAST(profit AS DOUBLE), 4) AS net_profit,
             'Profitable' AS profit_flag
             FROM sales_lines WHERE region = 'ASIA' AND profit > 0"""),
    Entry("BQ-34", "monthly_sales_trend", lambda r: periods.monthly_sales_trend(r.sales(order=True)),
          """SELECT strftime(order_date, '%Y-%m') AS order_month,
             CAST(SUM(sales) AS DECIMAL(28,4)) AS total_sales FROM sales_lines
             GROUP BY order_month"""),
    Entry("BQ-34", "top_products",
          lambda r: sales.top_by_sales(
              r.sales(product=True), ["product_id", "product_name"], 10),
          """SELECT product_id, product_name, CAST(SUM(sales) AS DECIMAL(28,4)) AS total_sales
             FROM sales_lines GROUP BY product_id, product_name
             ORDER BY total_sales DESC, product_id LIMIT 10"""),
    Entry("BQ-34", "top_categories",
          lambda r: sales.top_by_sales(r.sales(product=True), ["category"], 3),
          """SELECT category, CAST(SUM(sales) AS DECIMAL(28,4)) AS total_sales FROM sales_lines
             GROUP BY category ORDER BY total_sales DESC, category LIMIT 3"""),
    Entry("BQ-35", "technology_view",
          lambda r: listing.category_view(r.sales(customer=True, product=True), "PROMO"),
          """SELECT order_id, customer_name, product_name, profit AS net_profit
             FROM sales_lines WHERE category = 'PROMO'"""),
]
