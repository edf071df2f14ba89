"""Basket pairs against a brute-force join, with one order holding a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tradewind.operators import baskets


@pytest.fixture(scope="module")
def shop(spark):
    n = spark.range(3000)
    items = n.select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.hash("id"), F.lit(500)) + 1)
        .alias("order_id"),
        F.pmod(F.hash(F.col("id") * 7), F.lit(300)).cast("long").alias("product_id"))
    products = spark.range(300).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("n"), (F.col("id") % 70).cast("string")).alias("product_name"))
    return items.persist(), products.persist()


def brute(items, products, label, k):
    named = items.join(products, "product_id").select(
        "order_id", "product_id", F.col(label).alias("label"))
    a = named.toDF("order_id", "pa", "product_a")
    b = named.toDF("order_id", "pb", "product_b")
    return [tuple(r) for r in a.join(b, "order_id").filter("pa < pb")
            .groupBy("product_a", "product_b").count()
            .orderBy(F.desc("count"), "product_a", "product_b").limit(k).collect()]


@pytest.mark.parametrize("label", ["product_name", "product_id"])
@pytest.mark.parametrize("block", [8, 60, 100000])
def test_best_pairs_are_exact(shop, label, block):
    items, products = shop
    got = baskets.bought_together(items, products, label, 20, block).collect()
    assert [tuple(r) for r in got] == brute(items, products, label, 20)


def test_only_large_orders(shop):
    items, products = shop
    hot = items.filter("order_id = 0")
    got = baskets.bought_together(hot, products, "product_name", 10, 50).collect()
    assert [tuple(r) for r in got] == brute(hot, products, "product_name", 10)


def test_blocks_count_products_not_lines(spark):
    """200,000 lines of 50 products are one block; 120 products of 120 lines are three of 50."""
    lines = baskets.basket_lines(
        spark.range(200_000).select(F.lit(1).alias("order_id"), (F.col("id") % 50).alias("product_id"))
        .unionByName(spark.range(120).select(F.lit(2).alias("order_id"), F.col("id").alias("product_id"))))
    assert [tuple(r) for r in baskets.order_blocks(lines, 50).collect()] == [(2, 3)]


def test_rows_without_keys_pair_with_nothing(spark, shop):
    items = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, 2), (1, None)], "order_id int, product_id long")
    assert [tuple(r) for r in baskets.bought_together(items, shop[1], "product_id").collect()] == [(1, 2, 1)]
    assert baskets.bought_together(items.limit(0), shop[1], "product_id").count() == 0


def test_products_without_a_label_are_one_group(shop):
    items, products = shop
    some = products.withColumn("product_name", F.when(F.col("product_id") % 5 > 0, F.col("product_name")))
    got = baskets.bought_together(items, some, k=30).collect()
    assert [tuple(r) for r in got] == brute(items, some, "product_name", 30)
    assert any(r.product_a is None for r in got)


def test_fewer_pairs_than_asked_for(spark, shop):
    items = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 3)], "order_id int, product_id long")
    for block in (1, 100):
        got = baskets.bought_together(items, shop[1], "product_id", 20, block).collect()
        assert [tuple(r) for r in got] == [(1, 2, 2)]


def test_pairs_per_order_need_no_pairing(shop):
    items, _ = shop
    got = {r.order_id: r.pairs for r in baskets.pairs_per_order(items).collect()}
    a, b = items.toDF("order_id", "pa"), items.toDF("order_id", "pb")
    want = a.join(b, "order_id").groupBy("order_id").agg(F.count_if(F.expr("pa < pb")).alias("n"))
    assert got == {r.order_id: r.n for r in want.collect()}
