"""Readers, writers and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.catalog.entry import Entry
from tradewind.catalog.views import Retail
from tradewind.operators import aggregates, quality
from tradewind.plans import cleaning, listing
from tradewind.session import scratch_path, stage
from tradewind.sources import files, tables


def _csv_round_trip(df: DataFrame, multiline: bool = False, infer: bool = False) -> DataFrame:
    path = scratch_path(df.sparkSession, "csv")
    files.write_csv(df, path)
    return files.read_csv(df.sparkSession, path, None if infer else df.schema, multiline)


def _quoted(r: Retail) -> DataFrame:
    """Names with inch marks, commas and line breaks."""
    return _csv_round_trip(r.products.withColumn(
        "product_name", F.concat("product_name", F.lit(' 14 7/8", wide\nand long'))), True)


def _inferred(r: Retail) -> DataFrame:
    return _csv_round_trip(r.table("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), infer=True)


def _export_small(r: Retail) -> DataFrame:
    small = aggregates.sales_summary(
        r.sales(region=True, product=True), ["region", "category"])
    path = scratch_path(r.spark, "export")
    files.export_csv(small, path)
    return files.read_csv(r.spark, path, small.schema)


def _saved_table(r: Retail) -> DataFrame:
    """Save a managed table, read it by name, overwrite it with its own cleaned rows, and drop it.

    The name is this run's own, so that runs side by side do not meet in the catalog.
    """
    name = tables.fresh_name("tradewind_customers")
    try:
        raw = tables.save_table(r.master, name)
        return stage(tables.replace_table(quality.drop_duplicates(raw), name), "saved")
    finally:
        tables.drop_table(r.spark, name)


def _metadata(r: Retail) -> DataFrame:
    found = files.source_metadata(r.spark, f"{r.folder}/lineitem.parquet")
    return found.select(
        (F.col("file_size") > 0).alias("has_size"), F.col("modified").isNotNull().alias("has_time"),
        F.col("file_path").endswith("lineitem.parquet").alias("has_path"),
        F.col("column_count").cast("long").alias("column_count"), "row_count")


def _copied(r: Retail) -> DataFrame:
    source = scratch_path(r.spark, "source")
    files.write_csv(r.customers, source)
    return files.copy_dataset(r.spark, source, scratch_path(r.spark, "target"),
                              schema=r.customers.schema)


def _loaded(r: Retail) -> DataFrame:
    cleaned = cleaning.clean_ecommerce(r.dirty, r.as_of)
    return quality.row_counts(tables.load_tables(cleaned.tables(), scratch_path(r.spark, "load")))


def _inserted(r: Retail) -> DataFrame:
    """The three tables of the star schema, written and counted."""
    star = listing.split_listing(r.sales(raw=True))
    return quality.row_counts({
        n: files.write_parquet(df, scratch_path(r.spark, n)) for n, df in star.items()})


def _ends(r: Retail) -> DataFrame:
    orders = r.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    key = F.col("o_orderkey")
    return quality.preview(orders, 5, [key.asc()]).unionByName(
        quality.preview(orders, 5, [key.desc()]))


def _explained(r: Retail) -> DataFrame:
    """Filter and projection whose plan the tests inspect for pushdown."""
    return r.table("orders").filter(F.col("o_totalprice") > 400000).select(
        "o_custkey", "o_totalprice")


_SUMMARY_SQL = """SELECT region, category, COUNT(*) AS order_count,
  CAST(SUM(sales) AS DECIMAL(28,4)) AS total_sales,
  ROUND(CAST(SUM(profit) AS DOUBLE) / COUNT(profit), 4) AS avg_profit
FROM sales_lines GROUP BY region, category"""

_TYPES = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  ELSE column_type END"""

ENTRIES = [
    Entry("IO-01", "read_csv", lambda r: _csv_round_trip(r.customers),
          "SELECT * FROM shop_customers"),
    Entry("IO-02", "read_csv_quoted", _quoted,
          """SELECT product_id, product_name || ' 14 7/8", wide' || chr(10) || 'and long'
             AS product_name, category, subcategory, cost_price FROM shop_products"""),
    Entry("IO-03", "read_csv_pandas", _inferred,
          "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"),
    Entry("IO-04", "read_parquet",
          lambda r: files.read_parquet(r.spark, f"{r.folder}/orders.parquet"),
          "SELECT * FROM orders"),
    Entry("IO-05", "write_parquet",
          lambda r: files.write_parquet(r.items, scratch_path(r.spark, "items")),
          """SELECT item_id, order_id, product_id, quantity, unit_price, discount_percent
             FROM all_items"""),
    Entry("IO-06", "write_csv", lambda r: _csv_round_trip(r.orders_with_region.select(
        "order_id", "customer_id", "order_date", "status", "region_code")),
        "SELECT order_id, customer_id, order_date, status, region_code FROM shop_orders"),
    Entry("IO-07", "export_small_csv", _export_small, _SUMMARY_SQL),
    Entry("IO-08", "save_table", _saved_table, "SELECT DISTINCT * FROM master"),
    Entry("IO-09", "source_metadata", _metadata,
          """SELECT TRUE AS has_size, TRUE AS has_time, TRUE AS has_path,
             (SELECT COUNT(*) FROM (DESCRIBE lineitem)) AS column_count,
             (SELECT COUNT(*) FROM lineitem) AS row_count"""),
    Entry("IO-10", "copy_dataset", _copied,
          """SELECT COUNT(*) AS rows_read, COUNT(*) AS rows_written, 5 AS column_count
             FROM shop_customers"""),
    Entry("IO-11", "append_table", _loaded,
          """SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM clean_customers
             UNION ALL SELECT 'products', COUNT(*) FROM clean_products
             UNION ALL SELECT 'orders', COUNT(*) FROM kept_orders
             UNION ALL SELECT 'order_items', COUNT(*) FROM clean_items"""),
    Entry("IO-12", "insert_select", _inserted,
          """SELECT 'customers' AS table_name, COUNT(DISTINCT customer_id) AS row_count
             FROM sales_lines
             UNION ALL SELECT 'products', COUNT(DISTINCT product_id) FROM sales_lines
             UNION ALL SELECT 'orders', COUNT(*) FROM sales_lines"""),
    Entry("IO-13", "preview", _ends,
          """SELECT * FROM (SELECT o_orderkey, o_custkey, o_totalprice FROM orders
               ORDER BY o_orderkey LIMIT 5)
             UNION ALL SELECT * FROM (SELECT o_orderkey, o_custkey, o_totalprice FROM orders
               ORDER BY o_orderkey DESC LIMIT 5)"""),
    Entry("IO-14", "schema_profile", lambda r: quality.schema_profile(r.table("lineitem")),
          f"""SELECT row_number() OVER () AS ordinal, column_name, {_TYPES} AS data_type,
              (SELECT COUNT(*) FROM lineitem) AS row_count, COUNT(*) OVER () AS column_count
              FROM (DESCRIBE lineitem)"""),
    Entry("IO-15", "explain_plan", _explained,
          "SELECT o_custkey, o_totalprice FROM orders WHERE o_totalprice > 400000"),
]
