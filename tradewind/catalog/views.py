"""Retail tables derived row by row from the driver tables.

Each view is a projection (plus key joins where a column lives in another
table); ``catalog.sql`` holds the same views as SQL text.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.sources import files

# The moment that counts as now for the dirty orders.
AS_OF = "2002-01-01 00:00:00"
_LAYOUTS: dict[str, StructType] = {}


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("decimal(14,0)")


def _hundredth() -> Column:
    return F.lit(0.01).cast("decimal(3,2)")


class Retail:
    """The driver tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A driver table; its layout is looked up once per folder and process."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _LAYOUTS:
            _LAYOUTS[path] = self.spark.read.parquet(path).schema
        return files.read_parquet(self.spark, path, _LAYOUTS[path])

    @cached_property
    def region_of_nation(self) -> DataFrame:
        """The 25 nations with their region."""
        return self.table("nation").join(
            F.broadcast(self.table("region")), F.col("n_regionkey") == F.col("r_regionkey"))

    # --- e-commerce tables -------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        host = (F.when(key % 50 == 0, "example.com").when(key % 50 == 1, "@")
                .otherwise("@example.com"))
        kind = (F.when(key % 3 == 0, "REGULAR").when(key % 3 == 1, "PREMIUM").otherwise("VIP"))
        return self.table("customer").select(
            key.alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.concat(F.lit("customer"), key.cast("string"), host).alias("email"),
            F.date_add(F.lit("1995-01-01").cast("date"), ((key * 37) % 2000).cast("int"))
            .alias("registration_date"),
            kind.alias("customer_type"))

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("cost_price"))

    @cached_property
    def orders(self) -> DataFrame:
        """Orders without the region; see ``orders_with_region``."""
        key = F.col("o_orderkey")
        status = (
            F.when(F.col("o_orderstatus") == "F", "DELIVERED")
            .when(F.col("o_orderstatus") == "O", "SHIPPED")
            .when(key % 3 == 0, "PLACED").when(key % 3 == 1, "CANCELLED").otherwise("RETURNED"))
        return self.table("orders").select(
            key.alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"), status.alias("status"))

    @cached_property
    def orders_with_region(self) -> DataFrame:
        home = self.table("customer").join(
            F.broadcast(self.region_of_nation), F.col("c_nationkey") == F.col("n_nationkey"))
        return self.orders.join(
            home.select(F.col("c_custkey").alias("customer_id"),
                        F.col("r_name").alias("region_code")), "customer_id")

    @cached_property
    def _items(self) -> DataFrame:
        quantity = F.col("l_quantity")
        return self.table("lineitem").select(
            F.concat_ws("-", *[F.col(c).cast("string") for c in (
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                _cents("l_extendedprice").cast("string")).alias("item_id"),
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity).cast("int")
            .alias("quantity"),
            (F.floor(F.round(F.col("l_extendedprice") * 100) / quantity).cast("decimal(14,0)")
             * _hundredth()).cast("decimal(12,2)").alias("unit_price"),
            F.round(F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_percent"),
            (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_suppkey") * 7
             + F.col("l_linenumber")).alias("_flaw"))

    @cached_property
    def items(self) -> DataFrame:
        return self._items.drop("_flaw")

    # --- the flat sales listing --------------------------------------------

    def sales(self, order: bool = False, customer: bool = False, region: bool = False,
              product: bool = False, raw: bool = False) -> DataFrame:
        """Order lines with amounts, joined only with the tables that are asked for.

        ``order`` adds customer and date, ``product`` names and profit; ``raw`` gives
        every column of the listing, dates as M/d/yyyy text.
        """
        if raw:
            customer = region = product = True
        order = order or customer or region
        df = self.table("lineitem")
        # profit needs the cost, which is the part's
        if product:
            df = df.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        if order:
            placed = self.table("orders")
            # orders find their customer before their lines find them: there are fewer to move
            if customer or region:
                home = self.table("customer")
                if region:
                    home = home.join(F.broadcast(self.region_of_nation),
                                     F.col("c_nationkey") == F.col("n_nationkey"))
                placed = placed.join(home, F.col("o_custkey") == F.col("c_custkey"))
            df = df.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        keep = F.lit(1) - F.round(F.col("l_discount") * 100).cast("decimal(5,0)") * _hundredth()
        sales = (_cents("l_extendedprice") * _hundredth() * keep).cast("decimal(12,4)")
        quantity = F.col("l_quantity").cast("int")
        out = {
            "row_id": F.concat_ws("-", *[F.col(c).cast("string") for c in (
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                _cents("l_extendedprice").cast("string")),
            "order_id": F.col("l_orderkey"),
            "ship_date": F.col("l_shipdate"),
            "ship_mode": F.col("l_returnflag"),
            "product_id": F.col("l_partkey"),
            "sales": sales,
            "quantity": quantity,
            "discount": F.col("l_discount").cast("decimal(5,4)"),
        }
        if order:
            out |= {"order_date": F.col("o_orderdate"), "customer_id": F.col("o_custkey")}
        if customer:
            out |= {"customer_name": F.col("c_name"), "segment": F.col("c_mktsegment"),
                    "postal_code": F.col("c_nationkey")}
        if region:
            out |= {"country": F.lit("World"), "city": F.concat(F.lit("City "), F.col("n_name")),
                    "state": F.col("n_name"), "region": F.col("r_name")}
        if product:
            cost = F.col("p_retailprice").cast("decimal(12,2)")
            out |= {
                "product_name": F.col("p_name"), "category": F.col("p_type"),
                "sub_category": F.col("p_brand"),
                "profit": (sales - quantity * F.lit(0.6).cast("decimal(2,1)") * cost)
                .cast("decimal(12,4)")}
        if raw:
            out |= {c: F.date_format(out[c], "M/d/yyyy") for c in ("order_date", "ship_date")}
        return df.select(*[c.alias(n) for n, c in out.items()])

    @cached_property
    def product_listing(self) -> DataFrame:
        """Listed products: no final price at all, some discounts missing."""
        size = F.col("p_size")
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"),
            F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("initial_price"),
            F.lit(None).cast("double").alias("final_price"),
            F.when(size % 7 != 0, ((size % 10) * 5).cast("double")).alias("discount"),
            (size % 5).cast("double").alias("rating"))

    # --- the same tables with flaws ----------------------------------------

    @cached_property
    def as_of(self) -> Column:
        return F.lit(AS_OF).cast("timestamp_ntz")

    @cached_property
    def dirty(self) -> dict[str, DataFrame]:
        """Text ids and dates, blank keys, junk dates, orphans, zeros, bad discounts."""
        order = F.col("order_id")
        orders = self.orders.select(
            order.cast("string").alias("order_id"),
            F.when(order % 20 == 0, "").when(order % 20 == 1, F.lit(None))
            .when(order % 1000 == 5, "99999999")
            .otherwise(F.col("customer_id").cast("string")).alias("customer_id"),
            F.when(order % 1000 == 4, "2028-12-15 10:00:00").when(order % 500 == 3, "junk")
            .when(order % 50 == 2, F.date_format("order_date", "dd-MM-yyyy"))
            .otherwise(F.date_format("order_date", "yyyy-MM-dd HH:mm:ss")).alias("order_date"),
            "status", F.lit("REG_NORTH").alias("region_code"))
        flaw = F.col("_flaw")
        items = self._items.select(
            "item_id",
            F.when(flaw % 251 == 9, "-999999").otherwise(F.col("order_id").cast("string"))
            .alias("order_id"),
            F.when(flaw % 251 == 10, "-1").otherwise(F.col("product_id").cast("string"))
            .alias("product_id"),
            F.when(flaw % 251 == 7, 0).when(flaw % 251 == 8, F.lit(None).cast("int"))
            .otherwise(F.col("quantity")).alias("quantity"),
            "unit_price",
            F.when(flaw % 173 == 5, F.lit(120).cast("decimal(5,2)"))
            .when(flaw % 173 == 6, F.lit(-5).cast("decimal(5,2)"))
            .otherwise(F.col("discount_percent")).alias("discount_percent"))
        product = F.col("product_id")
        products = self.products.select(
            product.cast("string").alias("product_id"),
            F.when(product % 10 == 0, F.concat(
                F.lit("   "), F.upper("product_name"), F.lit("   ")))
            .otherwise(F.col("product_name")).alias("product_name"),
            "category", "subcategory", "cost_price")
        customer = F.col("customer_id")
        customers = self.customers.select(
            customer.cast("string").alias("customer_id"), "customer_name", "email",
            F.when(customer % 100 == 7, "unknown")
            .otherwise(F.date_format("registration_date", "yyyy-MM-dd"))
            .alias("registration_date"), "customer_type")
        return {"customers": customers, "products": products, "orders": orders,
                "order_items": items}

    @cached_property
    def customers_with_copies(self) -> DataFrame:
        return self.customers.unionByName(self.customers.filter(F.col("customer_id") % 100 == 0))

    # --- customer master and incremental batch -----------------------------

    @cached_property
    def master(self) -> DataFrame:
        """One email missing in 97; every 100th row twice."""
        key = F.col("c_custkey")
        rows = self.table("customer").select(
            key.alias("customer_id"), F.col("c_name").alias("name"),
            F.when(key % 97 != 0, F.concat(
                F.lit("customer"), key.cast("string"), F.lit("@example.com"))).alias("email"),
            F.col("c_mktsegment").alias("city"), F.lit("active").alias("status"),
            F.lit("2001-01-01").cast("date").alias("updated_at"))
        return rows.unionByName(rows.filter(F.col("customer_id") % 100 == 0))

    @cached_property
    def batch(self) -> DataFrame:
        """One row per customer: a third moved, a third only touched, a third new."""
        key = F.col("c_custkey")
        return self.table("customer").select(
            F.when(key % 3 == 2, key + 10000000).otherwise(key).alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.com")).alias("email"),
            F.when(key % 3 == 0, "MOVED").otherwise(F.col("c_mktsegment")).alias("city"),
            F.lit("active").alias("status"),
            F.lit("2001-02-01").cast("date").alias("updated_at"))
