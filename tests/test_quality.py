"""Cleaning rules on small literal frames: NULL, blank, boundary and tie cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tradewind.operators import quality as Q
from tradewind.operators import relational as R
from tradewind.plans import cleaning, listing
from tradewind.session import stage

NOW = dt.datetime(2025, 6, 10, 12)


def test_orphan_items_are_found_and_dropped(spark):
    orders = spark.createDataFrame([("O-1",), ("O-2",)], "order_id string")
    items = spark.createDataFrame(
        [("I-1", "O-1"), ("I-2", "O-9"), ("I-3", "O-2"), ("I-4", None)],
        "item_id string, order_id string")
    assert [r.item_id for r in Q.orphans(items, orders, "order_id").orderBy("item_id").collect()] \
        == ["I-2", "I-4"]
    assert Q.keep_referenced(items, orders, "order_id").count() == 2


def test_discounts_out_of_range_become_zero(spark):
    df = spark.createDataFrame(
        [(Decimal(v) if v is not None else None,) for v in ("10", "150", "-5", "0", "100", None)],
        "discount_percent decimal(5,2)")
    got = [r[0] for r in Q.reset_out_of_range(df).collect()]
    assert got == [Decimal(10), Decimal(0), Decimal(0), Decimal(0), Decimal(100), None]


def test_zero_quantities_go_returns_and_nulls_stay(spark):
    df = spark.createDataFrame([(0,), (-2,), (3,), (None,)], "quantity int")
    assert [r[0] for r in Q.drop_zero_quantity(df).collect()] == [-2, 3, None]


def orders_frame(spark):
    return spark.createDataFrame([
        ("O-1", "C-1", "2025-06-20 12:00:00"), ("O-2", "C-2", "2025-06-08 12:00:00"),
        ("O-3", "  ", "2025-06-01 00:00:00"), ("O-4", None, "2025-06-01 00:00:00"),
        ("O-5", "C-1", "01-06-2025"), ("O-6", "C-1", "junk"), ("O-7", "C-1", None),
        ("O-8", "C-1", "2025-06-10 12:00:00"), ("O-9", "C-9", "2025-06-01 00:00:00"),
    ], "order_id string, customer_id string, order_date string")


def test_clean_orders(spark):
    got = cleaning.clean_orders(orders_frame(spark), F.lit(NOW).cast("timestamp_ntz"))
    assert [r.order_id for r in got.orderBy("order_id").collect()] == ["O-2", "O-5", "O-8", "O-9"]
    assert {r.order_id: r.order_date for r in got.collect()}["O-5"] == dt.datetime(2025, 6, 1)


@pytest.fixture
def raw(spark):
    orders = orders_frame(spark).withColumns({
        "status": F.lit("PLACED"), "region_code": F.lit("REG_EAST")})
    return {
        "orders": orders,
        "customers": spark.createDataFrame([
            ("C-1", "a", "a@b.co", "2024-01-01", "VIP"), ("C-2", "b", None, "2024-01-02", "VIP"),
            ("C-3", "c", "bad", "not a date", "VIP")],
            "customer_id string, customer_name string, email string, registration_date string,"
            "customer_type string"),
        "products": spark.createDataFrame(
            [("P-1", " blue x-RAY "), ("P-2", "Plain Name")],
            "product_id string, product_name string"),
        "order_items": spark.createDataFrame([
            ("I-1", "O-2", "P-1", 1, Decimal(1), Decimal(120)),
            ("I-2", "O-2", "P-9", 1, Decimal(1), Decimal(0)),
            ("I-3", "O-5", "P-2", 0, Decimal(1), Decimal(130)),
            ("I-4", "O-1", "P-1", 5, Decimal(1), Decimal(0)),
            ("I-5", "O-8", "P-2", None, Decimal(1), None),
            ("I-6", "O-77", "P-1", 1, Decimal(1), Decimal(0))],
            "item_id string, order_id string, product_id string, quantity int,"
            "unit_price decimal(12,2), discount_percent decimal(5,2)"),
    }


def test_cleaning_report_and_tables_agree(spark, raw):
    done = cleaning.clean_ecommerce(raw, F.lit(NOW).cast("timestamp_ntz"))
    report = {(r.table_name, r.metric): r.value for r in done.report.collect()}
    assert report == {
        ("products", "names_normalized"): 1, ("products", "total_products_cleaned"): 2,
        ("customers", "invalid_emails"): 2,
        ("orders", "null_customer_ids_dropped"): 2, ("orders", "wrong_date_formats_fixed"): 1,
        ("orders", "unreadable_dates_dropped"): 2,
        ("orders", "future_dates_dropped"): 1, ("orders", "missing_customer_orders_dropped"): 1,
        ("orders", "total_orders_cleaned"): 3,
        ("order_items", "orphaned_items_dropped"): 2, ("order_items", "zero_quantity_dropped"): 1,
        ("order_items", "invalid_discounts_reset"): 1, ("order_items", "total_items_cleaned"): 2,
    }
    assert done.customers.count() == 2
    assert [r.product_name for r in done.products.orderBy("product_id").collect()] \
        == ["Blue X-Ray", "Plain Name"]
    assert rows(done.order_items.select("item_id", "quantity", "discount_percent")) \
        == [("I-1", 1, Decimal("0.00")), ("I-5", None, None)]


def test_nulls_and_duplicates(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (None, "b")], "n int, t string")
    assert Q.duplicate_count(df).first()[0] == 3
    assert Q.drop_duplicates(df).count() == 3
    assert Q.null_counts(df).first().asDict() == {"n": 1, "t": 2}
    assert Q.drop_null_rows(df).count() == 3
    assert Q.drop_null_rows(df, ["n"]).count() == 5
    assert rows(Q.fill_nulls(df, 0).distinct()) == [(0, "b"), (1, "a"), (2, "0")]
    assert Q.fill_nulls(df, {"t": "x"}).filter("t = 'x'").count() == 2
    assert Q.duplicate_count(df.limit(0)).first()[0] == 0


@pytest.mark.parametrize("most", [0, 1, 100])
def test_few_duplicates_are_dropped_like_any(spark, most):
    """Copies, NULLs, zeros of either sign, and different rows of one hash: a NULL adds nothing to it."""
    df = stage(spark.createDataFrame(
        [(1, None, "a", 0.0), (None, 1, "a", 0.0), (1, None, "a", -0.0), (1, None, "a", 0.0),
         (2, 3, None, float("nan")), (2, 3, None, float("nan")), (None, None, None, None),
         (None, None, None, None), (4, 5, "b", 1.0)], "a int, b int, `c.d` string, e double"))
    got, want = Q.drop_few_duplicates(df, most), Q.drop_duplicates(df)
    assert got.columns == want.columns and len(rows(got)) == 5
    assert {str(r).replace("-0.0", "0.0") for r in got.collect()} == {str(r).replace("-0.0", "0.0") for r in want.collect()}
    single = df.filter("a = 4")
    assert rows(Q.drop_few_duplicates(single, most)) == rows(single)
    assert Q.drop_few_duplicates(df.limit(0), most).isEmpty()


def order_lines(spark, n):
    i = F.col("id")
    text = {c: F.concat(F.lit(c), (i % 7).cast("string")) for c in (
        "ship_mode", *listing.CUSTOMER_ATTRIBUTES, *listing.PRODUCT_ATTRIBUTES)}
    return spark.range(n).select(
        i.cast("string").alias("row_id"), (i % 50).alias("order_id"), F.lit("1/2/2020").alias("order_date"),
        F.when(i % 3 != 0, "2/3/2020").alias("ship_date"), F.when(i % 5 != 0, i % 11).alias("customer_id"),
        (i % 13).alias("product_id"), (i / 3).cast("decimal(12,4)").alias("sales"), (i % 4).cast("int").alias("quantity"),
        F.lit(0).cast("decimal(5,4)").alias("discount"), F.lit(None).cast("decimal(12,4)").alias("profit"),
        *[v.alias(c) for c, v in text.items()])


def test_listing_with_copies_splits_as_without(spark):
    """A copy, and a line that only differs in the text of a date or below the cent, are dropped."""
    lines = order_lines(spark, 200)
    near = lines.filter("row_id % 10 = 1").withColumns(
        {"order_date": F.lit("01/02/2020"), "sales": F.col("sales").cast("decimal(10,2)").cast("decimal(12,4)")})
    listed = lines.unionByName(lines.filter("row_id % 10 = 0")).unionByName(near)
    got = listing.split_listing(listed)
    for name, want in listing.star_schema(lines).items():
        assert rows(got[name]) == rows(want), name
    assert got["orders"].count() == 200


def test_order_lines_without_copies_are_not_exchanged(spark):
    """Only their hashes are: the table of orders, the widest, is written from where the listing lies."""
    star = listing.split_listing(order_lines(spark, 200))
    assert "Exchange" not in Q.explain_text(star["orders"], "simple")
    assert star["orders"].count() == 200


def test_constraint_reports(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (None, -1), (2, 7)], "k int, v int")
    assert rows(Q.primary_key_violations(df, "k")) == [(1, 2), (None, 1)]
    assert rows(Q.duplicate_keys(df, "k")) == [(1, 2)]
    # a NULL passes a CHECK
    assert rows(Q.check_violations(df, {"small": "v < 6", "positive": "v >= 0"})) \
        == [("positive", 1), ("small", 1)]
    assert rows(Q.not_null_violations(df, ["k", "v"])) == [("k", 1), ("v", 1)]
    found = Q.foreign_key_violations(
        {"child": df, "parent": spark.createDataFrame([(1,)], "id int")},
        [("child", "k", "parent")], {"parent": "id"})
    assert rows(found) == [("child", "k", "2")]


def test_dimension_policies(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "b", 2), (1, "a", 9), (2, "x", None)], "k int, a string, b int")
    assert rows(Q.build_dimension(df, "k", ["a", "b"], "keep_all")) \
        == [(1, "a", 9), (1, "b", 2), (2, "x", None)]
    assert rows(Q.build_dimension(df, "k", ["a", "b"], "first")) == [(1, "a", 9), (2, "x", None)]
    with pytest.raises(Exception, match="several attribute rows for key 1"):
        Q.build_dimension(df, "k", ["a", "b"], "error").collect()
    assert rows(Q.build_dimension(df.filter("k = 2"), "k", ["a", "b"], "error")) \
        == [(2, "x", None)]


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(1, 2.0), (3, None), (None, 4.0)], "a int, b double")
    got = {r.column_name: r for r in Q.describe_numeric(df, ["a", "b"]).collect()}
    assert (got["a"]["count"], got["a"]["mean"], got["a"]["min"], got["a"]["max"]) == (2, 2, 1, 3)
    assert got["b"]["stddev"] == 1.4142
    assert rows(Q.schema_profile(df)) == [(1, "a", "int", 3, 2), (2, "b", "double", 3, 2)]


def test_margin_is_null_on_zero_sales(spark):
    df = spark.createDataFrame([(5.0, 20.0), (5.0, 0.0), (0.0, 0.0)], "profit double, sales double")
    assert [r.profit_margin for r in R.with_profit_margin(df).collect()] == [25.0, None, None]
    constant = R.with_profit_margin(df, "profit", "profit", scale=10)
    assert [r.profit_margin for r in constant.collect()] == [10.0, 10.0, None]


def test_max_rows_keep_ties(spark):
    df = spark.createDataFrame(
        [("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("b", 1, 4), ("c", None, 5)],
        "key string, v int, id int")
    assert sorted(r.id for r in R.max_rows_per_key(df, "key", "v").collect()) == [1, 2, 4]


def test_listing_headers_and_dates(spark):
    df = spark.createDataFrame(
        [("O-1", 42420, "9/8/2016")],
        "`Order ID` string, `Postal Code` int, `Order Date` string")
    got = listing.transform_listing(df).first()
    assert (got.order_id, got.postal_code, got.order_date_parsed, got.order_year) \
        == ("O-1", "42420", dt.date(2016, 9, 8), 2016)
