"""The views of ``catalog.views`` as SQL, and the helper that puts them before a query."""

from __future__ import annotations

import re

_ITEM_ID = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
            "CAST(ROUND(l_extendedprice * 100) AS DECIMAL(14,0)))")

VIEWS = {
    "shop_customers": """
SELECT c_custkey AS customer_id, c_name AS customer_name,
  concat('customer', CAST(c_custkey AS VARCHAR),
    CASE WHEN c_custkey % 50 = 0 THEN 'example.com' WHEN c_custkey % 50 = 1 THEN '@'
         ELSE '@example.com' END) AS email,
  DATE '1995-01-01' + CAST((c_custkey * 37) % 2000 AS INT) AS registration_date,
  CASE c_custkey % 3 WHEN 0 THEN 'REGULAR' WHEN 1 THEN 'PREMIUM' ELSE 'VIP' END AS customer_type
FROM customer""",
    "shop_products": """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
  p_brand AS subcategory, CAST(p_retailprice AS DECIMAL(12,2)) AS cost_price
FROM part""",
    "shop_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
  CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'O' THEN 'SHIPPED'
       WHEN o_orderkey % 3 = 0 THEN 'PLACED' WHEN o_orderkey % 3 = 1 THEN 'CANCELLED'
       ELSE 'RETURNED' END AS status, r_name AS region_code
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey""",
    "all_items": f"""
SELECT {_ITEM_ID} AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
  CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INT) AS quantity,
  CAST(CAST(FLOOR(ROUND(l_extendedprice * 100) / l_quantity) AS DECIMAL(14,0)) * 0.01
       AS DECIMAL(12,2)) AS unit_price,
  CAST(ROUND(l_discount * 100) AS DECIMAL(5,2)) AS discount_percent,
  l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber AS flaw
FROM lineitem""",
    "shop_items": """
SELECT item_id, order_id, product_id, quantity, unit_price, discount_percent,
  CAST(quantity * unit_price * (1 - discount_percent * 0.01) AS DECIMAL(24,6)) AS net
FROM all_items""",
    "sales_lines": f"""
SELECT {_ITEM_ID} AS row_id, l_orderkey AS order_id, o_orderdate AS order_date,
  l_shipdate AS ship_date, l_returnflag AS ship_mode, o_custkey AS customer_id,
  l_partkey AS product_id,
  CAST(CAST(ROUND(l_extendedprice * 100) AS DECIMAL(14,0)) * 0.01
       * (1 - CAST(ROUND(l_discount * 100) AS DECIMAL(5,0)) * 0.01) AS DECIMAL(12,4)) AS sales,
  CAST(l_quantity AS INT) AS quantity, CAST(l_discount AS DECIMAL(5,4)) AS discount,
  c_name AS customer_name, c_mktsegment AS segment, c_nationkey AS postal_code,
  'World' AS country, concat('City ', n_name) AS city, n_name AS state, r_name AS region,
  p_name AS product_name, p_type AS category, p_brand AS sub_category,
  CAST(CAST(CAST(ROUND(l_extendedprice * 100) AS DECIMAL(14,0)) * 0.01
       * (1 - CAST(ROUND(l_discount * 100) AS DECIMAL(5,0)) * 0.01) AS DECIMAL(12,4))
       - CAST(l_quantity AS INT) * 0.6 * CAST(p_retailprice AS DECIMAL(12,2))
       AS DECIMAL(12,4)) AS profit
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
     JOIN part ON l_partkey = p_partkey""",
    "product_listing": """
SELECT p_partkey AS product_id, p_name AS title, p_brand AS brand,
  p_retailprice AS initial_price, CAST(NULL AS DOUBLE) AS final_price,
  CASE WHEN p_size % 7 <> 0 THEN CAST((p_size % 10) * 5 AS DOUBLE) END AS discount,
  CAST(p_size % 5 AS DOUBLE) AS rating
FROM part""",
    "dirty_customers": """
SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_name, email,
  CASE WHEN customer_id % 100 = 7 THEN 'unknown'
       ELSE strftime(registration_date, '%Y-%m-%d') END AS registration_date, customer_type
FROM shop_customers""",
    "dirty_products": """
SELECT CAST(product_id AS VARCHAR) AS product_id,
  CASE WHEN product_id % 10 = 0 THEN concat('   ', upper(product_name), '   ')
       ELSE product_name END AS product_name, category, subcategory, cost_price
FROM shop_products""",
    "dirty_orders": """
SELECT CAST(order_id AS VARCHAR) AS order_id,
  CASE WHEN order_id % 20 = 0 THEN '' WHEN order_id % 20 = 1 THEN NULL
       WHEN order_id % 1000 = 5 THEN '99999999'
       ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
  CASE WHEN order_id % 1000 = 4 THEN '2028-12-15 10:00:00' WHEN order_id % 500 = 3 THEN 'junk'
       WHEN order_id % 50 = 2 THEN strftime(order_date, '%d-%m-%Y')
       ELSE strftime(order_date, '%Y-%m-%d %H:%M:%S') END AS order_date,
  status, 'REG_NORTH' AS region_code
FROM shop_orders""",
    "dirty_items": """
SELECT item_id,
  CASE WHEN flaw % 251 = 9 THEN '-999999' ELSE CAST(order_id AS VARCHAR) END AS order_id,
  CASE WHEN flaw % 251 = 10 THEN '-1' ELSE CAST(product_id AS VARCHAR) END AS product_id,
  CASE WHEN flaw % 251 = 7 THEN 0 WHEN flaw % 251 = 8 THEN NULL ELSE quantity END AS quantity,
  unit_price,
  CASE WHEN flaw % 173 = 5 THEN CAST(120 AS DECIMAL(5,2))
       WHEN flaw % 173 = 6 THEN CAST(-5 AS DECIMAL(5,2))
       ELSE discount_percent END AS discount_percent
FROM all_items""",
    "parsed_orders": """
SELECT order_id, customer_id, order_date AS date_text,
  coalesce(try_strptime(trim(order_date), '%d-%m-%Y'),
           try_strptime(trim(order_date), '%Y-%m-%d %H:%M:%S'),
           try_strptime(trim(order_date), '%Y-%m-%d')) AS order_date, status, region_code,
  trim(coalesce(customer_id, '')) <> '' AS keyed
FROM dirty_orders""",
    "clean_customers": """
SELECT customer_id, customer_name, email,
  CAST(try_strptime(registration_date, '%Y-%m-%d') AS DATE) AS registration_date, customer_type
FROM dirty_customers WHERE try_strptime(registration_date, '%Y-%m-%d') IS NOT NULL""",
    "clean_products": """
SELECT product_id, array_to_string(list_transform(
    regexp_extract_all(lower(trim(product_name)), '[a-z]+|[^a-z]+'),
    lambda w: upper(w[1]) || w[2:]), '') AS product_name, category, subcategory, cost_price
FROM dirty_products""",
    "clean_orders": """
SELECT order_id, customer_id, order_date, status, region_code FROM parsed_orders
WHERE keyed AND order_date <= TIMESTAMP '2002-01-01 00:00:00'""",
    "kept_orders": """
SELECT * FROM clean_orders WHERE customer_id IN (SELECT customer_id FROM clean_customers)""",
    "known_items": """
SELECT * FROM dirty_items WHERE order_id IN (SELECT order_id FROM kept_orders)
  AND product_id IN (SELECT product_id FROM dirty_products)""",
    "clean_items": """
SELECT item_id, order_id, product_id, quantity, unit_price,
  CASE WHEN discount_percent < 0 OR discount_percent > 100 THEN CAST(0 AS DECIMAL(5,2))
       ELSE discount_percent END AS discount_percent
FROM known_items WHERE quantity IS DISTINCT FROM 0""",
    "customers_with_copies": """
SELECT * FROM shop_customers UNION ALL
SELECT * FROM shop_customers WHERE customer_id % 100 = 0""",
    "master_rows": """
SELECT c_custkey AS customer_id, c_name AS name,
  CASE WHEN c_custkey % 97 <> 0
       THEN concat('customer', CAST(c_custkey AS VARCHAR), '@example.com') END AS email,
  c_mktsegment AS city, 'active' AS status, DATE '2001-01-01' AS updated_at
FROM customer""",
    "master": """
SELECT * FROM master_rows UNION ALL SELECT * FROM master_rows WHERE customer_id % 100 = 0""",
    "clean_master": """
SELECT DISTINCT * FROM master WHERE email IS NOT NULL""",
    "batch": """
SELECT CASE WHEN c_custkey % 3 = 2 THEN c_custkey + 10000000 ELSE c_custkey END AS customer_id,
  c_name AS name, concat('customer', CAST(c_custkey AS VARCHAR), '@example.com') AS email,
  CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS city,
  'active' AS status, DATE '2001-02-01' AS updated_at
FROM customer""",
    "active_orders": "SELECT * FROM shop_orders WHERE status <> 'CANCELLED'",
    "active_facts": """
SELECT i.*, o.customer_id, o.order_date, o.region_code
FROM shop_items i JOIN active_orders o ON i.order_id = o.order_id""",
    "customer_value": """
SELECT customer_id, SUM(net) AS revenue FROM active_facts GROUP BY customer_id""",
    "customer_sales": """
SELECT customer_id, CAST(SUM(sales) AS DECIMAL(28,4)) AS total_sales
FROM sales_lines GROUP BY customer_id""",
}


def _uses(text: str) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [v for v in VIEWS if v in words]


def with_views(query: str) -> str:
    """The query with the views it needs, directly or through others, in front."""
    needed: set[str] = set()
    todo = _uses(query)
    while todo:
        v = todo.pop()
        if v not in needed:
            needed.add(v)
            todo += _uses(VIEWS[v])
    if not needed:
        return query.strip()
    heads = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in VIEWS if v in needed)
    return f"WITH {heads}\n{query.strip()}"


def money(sql: str, digits: int = 2) -> str:
    return f"CAST(ROUND({sql}, {digits}) AS DECIMAL(28,{digits}))"


def ratio(num: str, den: str, scale: str = "100", digits: int = 2) -> str:
    """Rounded share as DOUBLE, NULL on a zero denominator; adding 0 turns -0.0 into 0.0."""
    return (f"(ROUND(CAST({num} AS DOUBLE) * CAST({scale} AS DOUBLE)"
            f" / NULLIF(CAST({den} AS DOUBLE), 0), {digits}) + 0)")


def percent_text(sql: str) -> str:
    return (f"regexp_replace(CAST(CAST(ROUND({sql}, 2) AS DECIMAL(28,2)) AS VARCHAR), '0$', '')"
            " || '%'")


def mean(c: str, digits: int = 4) -> str:
    return f"ROUND(CAST(SUM({c}) AS DOUBLE) / NULLIF(CAST(COUNT({c}) AS DOUBLE), 0), {digits})"
