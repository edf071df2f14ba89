"""Data quality, cleaning and slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.catalog.entry import Entry
from tradewind.catalog.views import Retail
from tradewind.functions import columns as C
from tradewind.operators import quality as Q
from tradewind.operators import relational as R
from tradewind.operators import scd
from tradewind.plans import cleaning, listing
from tradewind.session import scratch_path
from tradewind.sources import files
from tradewind.streaming import incremental

TRACKED = ("name", "email", "city", "status")


def _cleaned(r: Retail) -> cleaning.Cleaned:
    return cleaning.clean_ecommerce(r.dirty, r.as_of)


def _scd2(r: Retail) -> DataFrame:
    target = scd.scd2_open(scd.dim_clean(r.master), "updated_at")
    return scd.scd2_merge(target, r.batch, "customer_id", TRACKED, "updated_at")


def _incremental(r: Retail) -> DataFrame:
    """The batch as it arrives: a CSV file in the layout of the master."""
    path = scratch_path(r.spark, "batch")
    files.write_csv(r.batch, path)
    return files.read_csv(r.spark, path, r.batch.schema)


def _streamed(r: Retail) -> DataFrame:
    """The batch as CSV files, merged into the master by a stream."""
    inbox, table = scratch_path(r.spark, "inbox"), scratch_path(r.spark, "master")
    files.write_csv(r.batch, inbox)
    incremental.first_load(scd.dim_clean(r.master), table)
    batches = incremental.stream_batches(r.spark, inbox, r.batch.schema, files_per_batch=1000)
    query = incremental.merge_stream(
        batches, table, scratch_path(r.spark, "state"), incremental.merge_scd1("customer_id"))
    query.awaitTermination()
    return incremental.newest(r.spark, table)


def _checks(r: Retail) -> DataFrame:
    out = None
    for name, rules in schemas.CHECKS.items():
        found = Q.check_violations(r.dirty[name], rules).select(
            F.lit(name).alias("table_name"), "rule", "violations")
        out = found if out is None else out.unionByName(found)
    return out


def _not_null(r: Retail) -> DataFrame:
    out = None
    for name, schema in schemas.SCHEMAS.items():
        found = Q.not_null_violations(r.dirty[name], schemas.required_columns(schema)).select(
            F.lit(name).alias("table_name"), "column_name", "violations")
        out = found if out is None else out.unionByName(found)
    return out


def _numbers(r: Retail) -> DataFrame:
    return r.product_listing.select("discount", "rating", "initial_price")


_CHECK_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{rule}' AS rule, "
    f"COUNT(*) FILTER (WHERE NOT ({sql})) AS violations "
    f"FROM dirty_{'items' if t == 'order_items' else t}"
    for t, rules in schemas.CHECKS.items() for rule, sql in rules.items())
_NOT_NULL_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS violations "
    f"FROM dirty_{'items' if t == 'order_items' else t}"
    for t, schema in schemas.SCHEMAS.items() for c in schemas.required_columns(schema))
_DESCRIBE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({c}), 4) AS mean,
    ROUND(STDDEV_SAMP({c}), 4) AS stddev, ROUND(MIN({c}), 4) AS min, ROUND(MAX({c}), 4) AS max
    FROM product_listing""" for c in ("initial_price", "discount", "rating"))

_REPORT_SQL = """
SELECT 'products' AS table_name, 'names_normalized' AS metric, COUNT(*) AS value
FROM dirty_products d JOIN clean_products c ON d.product_id = c.product_id
WHERE d.product_name <> c.product_name
UNION ALL SELECT 'products', 'total_products_cleaned', COUNT(*) FROM dirty_products
UNION ALL SELECT 'customers', 'invalid_emails', COUNT(*) FROM dirty_customers
  WHERE NOT regexp_full_match(email, '[^@]+@[^@]+\\.[^@]+')
UNION ALL SELECT 'orders', 'null_customer_ids_dropped', COUNT(*) FROM parsed_orders WHERE NOT keyed
UNION ALL SELECT 'orders', 'wrong_date_formats_fixed', COUNT(*) FROM parsed_orders
  WHERE keyed AND regexp_full_match(date_text, '[0-9]{2}-[0-9]{2}-[0-9]{4}')
UNION ALL SELECT 'orders', 'unreadable_dates_dropped', COUNT(*) FROM parsed_orders
  WHERE keyed AND order_date IS NULL
UNION ALL SELECT 'orders', 'future_dates_dropped', COUNT(*) FROM parsed_orders
  WHERE keyed AND order_date > TIMESTAMP '2002-01-01 00:00:00'
UNION ALL SELECT 'orders', 'missing_customer_orders_dropped', COUNT(*) FROM clean_orders
  WHERE customer_id NOT IN (SELECT customer_id FROM clean_customers)
UNION ALL SELECT 'orders', 'total_orders_cleaned', COUNT(*) FROM kept_orders
UNION ALL SELECT 'order_items', 'orphaned_items_dropped', COUNT(*) FROM dirty_items
  WHERE order_id NOT IN (SELECT order_id FROM kept_orders)
UNION ALL SELECT 'order_items', 'zero_quantity_dropped', COUNT(*) FROM known_items
  WHERE quantity = 0
UNION ALL SELECT 'order_items', 'invalid_discounts_reset', COUNT(*) FROM known_items
  WHERE quantity IS DISTINCT FROM 0 AND (discount_percent < 0 OR discount_percent > 100)
UNION ALL SELECT 'order_items', 'total_items_cleaned', COUNT(*) FROM clean_items"""

RULES = [
    Entry("DQ-01", "drop_null_rows", lambda r: Q.drop_null_rows(r.master),
          "SELECT * FROM master WHERE email IS NOT NULL"),
    Entry("DQ-02", "fill_all", lambda r: Q.fill_nulls(r.master.select(
        "customer_id", "email").unionByName(r.product_listing.select(
            F.col("discount").cast("long").alias("customer_id"), F.col("title").alias("email"))), 0),
        """SELECT customer_id, COALESCE(email, '0') AS email FROM master
           UNION ALL SELECT COALESCE(CAST(discount AS BIGINT), 0), title FROM product_listing"""),
    Entry("DQ-03", "fill_map", lambda r: Q.fill_nulls(
        r.product_listing.select("product_id", "discount", "rating"), {"discount": 0}),
        """SELECT product_id, COALESCE(discount, 0) AS discount, rating FROM product_listing"""),
    Entry("DQ-04", "drop_duplicates", lambda r: Q.drop_duplicates(r.customers_with_copies),
          "SELECT DISTINCT * FROM customers_with_copies"),
    Entry("DQ-05", "duplicate_count", lambda r: Q.duplicate_count(r.master),
          """SELECT (SELECT COUNT(*) FROM master)
             - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM master)) AS duplicate_rows"""),
    Entry("DQ-06", "null_counts", lambda r: Q.null_counts(r.product_listing),
          """SELECT COUNT(*) - COUNT(product_id) AS product_id, COUNT(*) - COUNT(title) AS title,
             COUNT(*) - COUNT(brand) AS brand, COUNT(*) - COUNT(initial_price) AS initial_price,
             COUNT(*) - COUNT(final_price) AS final_price, COUNT(*) - COUNT(discount) AS discount,
             COUNT(*) - COUNT(rating) AS rating FROM product_listing"""),
    Entry("DQ-07", "drop_blank_key",
          lambda r: Q.drop_blank_key(r.dirty["orders"], "customer_id").select(
              "order_id", "customer_id"),
          """SELECT order_id, customer_id FROM dirty_orders
             WHERE trim(COALESCE(customer_id, '')) <> ''"""),
    Entry("DQ-08", "parse_timestamp_multi",
          lambda r: r.dirty["orders"].select(
              "order_id", C.parse_timestamp("order_date").alias("order_date")),
          "SELECT order_id, order_date FROM parsed_orders"),
    Entry("DQ-09", "count_nonstandard_dates",
          lambda r: Q.drop_blank_key(r.dirty["orders"], "customer_id").agg(
              F.count_if(F.col("order_date").rlike(C.DAY_FIRST_PATTERN)).alias("nonstandard")),
          """SELECT COUNT(*) AS nonstandard FROM parsed_orders
             WHERE keyed AND regexp_full_match(date_text, '[0-9]{2}-[0-9]{2}-[0-9]{4}')"""),
    Entry("DQ-10", "drop_future",
          lambda r: cleaning.clean_orders(r.dirty["orders"], r.as_of).select(
              "order_id", "customer_id", "order_date"),
          "SELECT order_id, customer_id, order_date FROM clean_orders"),
    Entry("DQ-11", "title_case_names",
          lambda r: cleaning.clean_products(r.dirty["products"]).select(
              "product_id", "product_name"),
          "SELECT product_id, product_name FROM clean_products"),
    Entry("DQ-12", "invalid_emails", lambda r: Q.invalid_emails(r.customers),
          r"""SELECT customer_id FROM shop_customers
              WHERE NOT regexp_full_match(email, '[^@]+@[^@]+\.[^@]+')"""),
    Entry("DQ-13", "orphan_rows",
          lambda r: Q.orphans(r.dirty["order_items"], _cleaned(r).orders, "order_id").select(
              "item_id"),
          """SELECT item_id FROM dirty_items
             WHERE order_id NOT IN (SELECT order_id FROM kept_orders)"""),
    Entry("DQ-14", "keep_referenced",
          lambda r: Q.keep_referenced(
              r.dirty["orders"], cleaning.clean_customers(r.dirty["customers"]), "customer_id")
          .select("order_id", "customer_id"),
          """SELECT order_id, customer_id FROM dirty_orders
             WHERE customer_id IN (SELECT customer_id FROM clean_customers)"""),
    Entry("DQ-15", "drop_zero_quantity",
          lambda r: Q.drop_zero_quantity(r.dirty["order_items"]).select("item_id", "quantity"),
          "SELECT item_id, quantity FROM dirty_items WHERE quantity IS DISTINCT FROM 0"),
    Entry("DQ-16", "reset_discount",
          lambda r: Q.reset_out_of_range(r.dirty["order_items"]).select(
              "item_id", "discount_percent"),
          """SELECT item_id, CASE WHEN discount_percent < 0 OR discount_percent > 100
             THEN CAST(0 AS DECIMAL(5,2)) ELSE discount_percent END AS discount_percent
             FROM dirty_items"""),
    Entry("DQ-17", "normalise_date",
          lambda r: cleaning.clean_customers(r.dirty["customers"]).select(
              "customer_id", F.date_format("registration_date", "yyyy-MM-dd")
              .alias("registration_date")),
          """SELECT customer_id, strftime(registration_date, '%Y-%m-%d') AS registration_date
             FROM clean_customers"""),
    Entry("DQ-18", "cleaning_report", lambda r: _cleaned(r).report,
          _REPORT_SQL),
    Entry("DQ-19", "primary_key_violations",
          lambda r: Q.primary_key_violations(r.dirty["orders"].select("customer_id"),
                                             "customer_id"),
          """SELECT customer_id, COUNT(*) AS row_count FROM dirty_orders GROUP BY customer_id
             HAVING COUNT(*) > 1 OR customer_id IS NULL"""),
    Entry("DQ-20", "check_violations", _checks, _CHECK_SQL),
    Entry("DQ-21", "not_null_violations", _not_null, _NOT_NULL_SQL),
    Entry("DQ-22", "foreign_key_check",
          lambda r: Q.foreign_key_violations(
              r.dirty, schemas.FOREIGN_KEYS, schemas.PRIMARY_KEYS),
          """SELECT 'orders' AS child_table, 'customer_id' AS column_name,
             customer_id AS key_value FROM dirty_orders WHERE customer_id IS NOT NULL
               AND customer_id NOT IN (SELECT customer_id FROM dirty_customers)
             UNION ALL SELECT 'order_items', 'order_id', order_id FROM dirty_items
               WHERE order_id NOT IN (SELECT order_id FROM dirty_orders)
             UNION ALL SELECT 'order_items', 'product_id', product_id FROM dirty_items
               WHERE product_id NOT IN (SELECT product_id FROM dirty_products)"""),
    Entry("DQ-23", "duplicate_keys", lambda r: Q.duplicate_keys(r.master, "customer_id"),
          """SELECT customer_id, COUNT(*) AS row_count FROM master
             GROUP BY customer_id HAVING COUNT(*) > 1"""),
    Entry("DQ-24", "dimension_rows",
          lambda r: Q.build_dimension(
              r.sales(order=True), "customer_id", ["ship_mode", "quantity"], "first"),
          """SELECT customer_id, ship_mode, quantity FROM (
               SELECT customer_id, ship_mode, quantity, row_number() OVER (
                 PARTITION BY customer_id ORDER BY ship_mode, quantity) AS n FROM sales_lines)
             WHERE n = 1"""),
    Entry("DQ-25", "row_count_check", lambda r: Q.row_counts(
        {n: r.table(n) for n in ("customer", "orders", "lineitem", "part")}),
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
            for t in ("customer", "orders", "lineitem", "part"))),
    Entry("DQ-26", "zero_sales_check", lambda r: Q.zero_count(r.sales(), "sales"),
          "SELECT COUNT(*) FILTER (WHERE sales = 0) AS zero_rows FROM sales_lines"),
    Entry("DQ-27", "describe_numeric", lambda r: Q.describe_numeric(
        _numbers(r), ["initial_price", "discount", "rating"]), _DESCRIBE_SQL),
    Entry("DQ-28", "coalesce_price",
          lambda r: R.with_effective_price(r.product_listing).select("product_id", "final_price"),
          """SELECT product_id, COALESCE(final_price, initial_price) AS final_price
             FROM product_listing"""),
    Entry("DQ-29", "clean_ecommerce", lambda r: _cleaned(r).order_items, "SELECT * FROM clean_items"),
    Entry("DQ-29", "clean_ecommerce_orders", lambda r: _cleaned(r).orders,
          "SELECT * FROM kept_orders"),
    Entry("DQ-29", "clean_ecommerce_customers", lambda r: _cleaned(r).customers,
          "SELECT * FROM clean_customers"),
    Entry("DQ-29", "clean_ecommerce_products", lambda r: _cleaned(r).products,
          "SELECT * FROM clean_products"),
]

_SCD2_SQL = """
SELECT m.customer_id, m.name, m.email, m.city, m.status, m.updated_at,
  (b.customer_id IS NULL OR NOT changed) AS is_current, m.updated_at AS valid_from,
  CASE WHEN changed THEN b.updated_at END AS valid_to
FROM (SELECT m.*, COALESCE(m.name IS DISTINCT FROM b.name OR m.email IS DISTINCT FROM b.email
        OR m.city IS DISTINCT FROM b.city OR m.status IS DISTINCT FROM b.status, FALSE)
        AND b.customer_id IS NOT NULL AS changed
      FROM clean_master m LEFT JOIN batch b ON m.customer_id = b.customer_id) m
LEFT JOIN batch b ON m.customer_id = b.customer_id
UNION ALL
SELECT b.customer_id, b.name, b.email, b.city, b.status, b.updated_at, TRUE, b.updated_at, NULL
FROM batch b LEFT JOIN clean_master m ON m.customer_id = b.customer_id
WHERE m.customer_id IS NULL OR m.name IS DISTINCT FROM b.name
  OR m.email IS DISTINCT FROM b.email OR m.city IS DISTINCT FROM b.city
  OR m.status IS DISTINCT FROM b.status"""

DIMENSIONS = [
    Entry("SD-01", "scd1_merge",
          lambda r: scd.scd1_merge(scd.dim_clean(r.master), r.batch, "customer_id"),
          """SELECT * FROM clean_master WHERE customer_id NOT IN (SELECT customer_id FROM batch)
             UNION ALL SELECT * FROM batch"""),
    Entry("SD-02", "scd2_merge", _scd2, _SCD2_SQL),
    Entry("SD-03", "dim_clean", lambda r: scd.dim_clean(r.master), "SELECT * FROM clean_master"),
    Entry("SD-04", "scd_validate",
          lambda r: scd.scd_validate(_scd2(r), "customer_id", current_only=True),
          f"""SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE is_current) AS current_rows,
              COUNT(*) FILTER (WHERE is_current) - COUNT(DISTINCT CASE WHEN is_current
                THEN customer_id END) AS duplicate_keys FROM ({_SCD2_SQL})"""),
    Entry("SD-05", "incremental_read", _incremental, "SELECT * FROM batch"),
    Entry("SD-05", "incremental_stream", _streamed,
          """SELECT * FROM clean_master WHERE customer_id NOT IN (SELECT customer_id FROM batch)
             UNION ALL SELECT * FROM batch"""),
]


_SPLIT = {
    "star_customers": ("customers", """SELECT DISTINCT customer_id, customer_name, segment,
        country, city, state, postal_code, region FROM sales_lines"""),
    "star_products": ("products", """SELECT DISTINCT product_id, product_name, category,
        sub_category FROM sales_lines"""),
    "star_orders": ("orders", """SELECT row_id, order_id, CAST(order_date AS DATE) AS order_date,
        CAST(ship_date AS DATE) AS ship_date, ship_mode, customer_id, product_id,
        CAST(sales AS DECIMAL(10,2)) AS sales, quantity,
        CAST(discount AS DECIMAL(5,2)) AS discount, CAST(profit AS DECIMAL(10,2)) AS profit
        FROM sales_lines"""),
}


def _delivered(r: Retail) -> DataFrame:
    """The listing under the headers of the delivered file."""
    return r.sales(raw=True).withColumnsRenamed({plain: head for head, plain in listing.HEADERS.items()})


STAR = [
    Entry("BQ-19", key, lambda r, t=table: listing.star_schema(r.sales(raw=True))[t], sql)
    for key, (table, sql) in _SPLIT.items()
] + [
    Entry("BQ-19", "star_schema_split",
          lambda r: Q.row_counts(listing.split_listing(r.sales(raw=True))),
          """SELECT 'customers' AS table_name, COUNT(DISTINCT customer_id) AS row_count
             FROM sales_lines UNION ALL SELECT 'products', COUNT(DISTINCT product_id)
             FROM sales_lines UNION ALL SELECT 'orders', COUNT(*) FROM sales_lines"""),
    Entry("BQ-19", "transform_listing",
          lambda r: listing.transform_listing(_delivered(r)).select(
              "row_id", "order_id", "customer_name", "product_name", "sub_category", "postal_code",
              "order_date", "order_date_parsed", "order_year"),
          """SELECT row_id, order_id, customer_name, product_name, sub_category,
             CAST(postal_code AS VARCHAR) AS postal_code,
             strftime(CAST(order_date AS DATE), '%-m/%-d/%Y') AS order_date,
             CAST(order_date AS DATE) AS order_date_parsed, YEAR(CAST(order_date AS DATE)) AS order_year
             FROM sales_lines"""),
]

ENTRIES = RULES + DIMENSIONS + STAR
