"""One order, one customer or one product holding a third of all rows."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tests.conftest import rows
from tradewind.functions import columns as C
from tradewind.operators import ordering, quality
from tradewind.operators import relational as R
from tradewind.plans import customers, sales

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def tiny_skew(spark):
    """Thresholds of the skew join scaled down to the size of the fixture."""
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(column, share=3):
    return F.when(F.col("id") % share == 0, 0).otherwise(F.col("id"))


@pytest.fixture
def shop(spark):
    n = spark.range(0, 60000, 1, 16)
    orders = n.select(
        F.col("id").alias("order_id"), hot("id").alias("customer_id"),
        (F.lit("2024-01-01").cast("date").cast("timestamp_ntz")
         + F.make_dt_interval(F.col("id") % 400)).alias("order_date"),
        F.when(F.col("id") % 7 == 1, "CANCELLED").otherwise("SHIPPED").alias("status"))
    items = n.select(
        F.col("id").alias("item_id"), hot("id").alias("order_id"),
        F.when(F.col("id") % 3 == 1, 5).otherwise(F.col("id") % 1000).alias("product_id"),
        F.lit(2).alias("quantity"), F.lit(10).cast("decimal(12,2)").alias("unit_price"),
        F.lit(0).cast("decimal(5,2)").alias("discount_percent"))
    return orders, items


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    got = df.collect()
    return got, df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_in_the_product_join(tiny_skew, shop):
    orders, items = shop
    df = R.product_revenue(items, R.active_orders(orders))
    got, plan = final_plan(df)
    assert "skew=true" in plan
    want = (items.join(R.active_orders(orders), "order_id").groupBy("product_id")
            .agg(F.sum(C.net_revenue()).alias("revenue")))
    assert sorted(map(tuple, got)) == rows(want) or sorted(map(tuple, got), key=repr) == rows(want)


def test_hot_order_shrinks_before_the_order_join(tiny_skew, shop):
    """Per-order sums leave one row per order and task; nothing is skewed after that."""
    orders, items = shop
    _, plan = final_plan(sales.customer_revenue(items, orders))
    assert "skew=true" not in plan


def test_gaps_of_a_hot_customer(tiny_skew, shop):
    """Its orders lie in many partitions and are never gathered by customer: only
    partial aggregates of the customers at the borders are."""
    orders, _ = shop
    got, plan = final_plan(customers.order_gap_risk(orders))
    lines = plan.split("== Initial Plan")[0].splitlines()
    gathered = [lines[i + 1] for i, line in enumerate(lines)
                if "Exchange hashpartitioning(customer_id" in line]
    assert all("HashAggregate" in below for below in gathered)
    lag = F.lag("order_date").over(W.partitionBy("customer_id").orderBy("order_date", "order_id"))
    gaps = R.active_orders(orders).withColumn("previous_order_date", lag).withColumn(
        "days_gap", C.days_between("order_date", "previous_order_date"))
    mean = F.avg("days_gap").over(W.partitionBy("customer_id"))
    want = gaps.select("customer_id", "order_date", "previous_order_date", "days_gap",
                       C.risk_flag(mean).alias("risk_flag"))
    assert sorted(map(tuple, got), key=repr) == rows(want)


def test_hot_customer_is_split_when_joined_with_its_mean(tiny_skew, shop):
    orders, _ = shop
    df = R.with_group_average(orders, "customer_id", "order_id", "mean_id")
    got, plan = final_plan(df)
    assert "skew=true" in plan
    assert len(got) == 60000


@pytest.fixture
def listing_of(spark, shop):
    """Lines joined with their products; one product holds a third of them and its row is wide."""
    _, items = shop
    products = spark.range(1000).select(
        F.col("id").alias("product_id"), F.concat(F.lit("p"), F.col("id") % 50).alias("product_name"))
    # amounts that do not compress, as the thresholds go by bytes
    amount = (F.pmod(F.hash("item_id"), F.lit(1_000_000)) + 1).cast("decimal(12,4)")
    lines = items.withColumn("sales", amount).join(products, "product_id")
    return lines


def test_hot_product_is_split_below_distinct_rows(tiny_skew, listing_of):
    df = quality.drop_duplicates(listing_of)
    got, plan = final_plan(df)
    assert "skew=true" in plan and len(got) == 60000


def test_hot_product_is_split_below_a_dimension(tiny_skew, listing_of):
    got, plan = final_plan(quality.build_dimension(listing_of, "product_id", ["product_name", "sales"], "first"))
    assert "skew=true" in plan and len({r.product_id for r in got}) == len(got) > 600


def test_hot_product_is_split_below_its_total(tiny_skew, listing_of):
    got, plan = final_plan(sales.top_by_sales(listing_of, ["product_id", "product_name"], 3))
    assert "skew=true" in plan and got[0].product_id == 5 and got[0].total_sales > 10**9


def test_hot_customer_is_split_when_its_ends_are_found(tiny_skew, shop):
    orders, _ = shop
    got, plan = final_plan(ordering.first_last(orders, ["customer_id"], ["order_date", "order_id"], "order_id", "a", "b"))
    assert "skew=true" in plan
    want = orders.groupBy("customer_id").agg(
        F.min_by("order_id", F.struct("order_date", "order_id")).alias("a"), F.max_by("order_id", F.struct("order_date", "order_id")).alias("b"))
    assert sorted(map(tuple, got)) == rows(want) or sorted(map(tuple, got), key=repr) == rows(want)


def test_best_of_a_hot_group_with_ties(spark):
    """Half of all rows share a group and its best key; each share keeps its own best ones."""
    df = spark.range(4000).select("id", (F.col("id") % 2).alias("g"), F.when(F.col("id") % 3 == 0, 9).otherwise(F.col("id") % 9).alias("k"))
    got = ordering.top_n_per_group(df, ["g"], "k", 2, "r", shares=3)
    want = df.withColumn("r", F.dense_rank().over(W.partitionBy("g").orderBy(F.desc("k")))).filter("r <= 2")
    assert rows(got) == rows(want)


def test_hot_group_spreads_over_sorted_partitions(tiny_skew, shop):
    """A group with a third of the rows is cut like any other range of rows."""
    orders, _ = shop
    placed = ordering.sorted_parts(
        orders, [F.col("customer_id").asc(), F.col("order_id").asc()])
    sizes = [r["count"] for r in placed.groupBy(ordering.PART).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 60000 / 3 / 2
