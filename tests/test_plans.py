"""Invariants between the questions, and what their plans must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tests.conftest import DATA
from tradewind.operators.quality import explain_text
from tradewind.plans import customers, periods, sales


def test_revenue_adds_up(retail):
    by_category = sales.revenue_by_category(retail.items, retail.orders, retail.products)
    by_month = periods.yoy_revenue(retail.items, retail.orders)
    a = by_category.agg(F.sum("total_revenue")).first()[0]
    b = by_month.agg(F.sum("revenue")).first()[0]
    assert abs(a - b) < 1


def test_last_running_total_is_the_region_total(retail):
    got = sales.running_total_by_region(retail.items, retail.orders_with_region)
    ends = got.groupBy("region_code").agg(
        F.max_by("running_total", "order_date").alias("last"), F.sum("daily_revenue").alias("all"))
    assert ends.count() == 5 and all(r["last"] == r["all"] for r in ends.collect())


def test_concentration_ends_at_one_hundred_percent(retail):
    got = sales.revenue_concentration(retail.items, retail.orders)
    last = got.orderBy(F.col("revenue").asc()).first()
    assert last.cumulative_share == 100.0 and last.cumulative_percent == "100.0%"


def test_quartiles_are_even(retail):
    sizes = [r["count"] for r in customers.ltv_quartiles(retail.items, retail.orders)
             .groupBy("quartile").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_retained_customers_fit_their_cohort(retail):
    got = customers.cohort_retention(retail.orders, retail.customers)
    assert got.filter("retained_customers > cohort_size OR month_number NOT BETWEEN 0 AND 3") \
        .isEmpty()


def test_periods_reject_reversed_dates():
    assert periods.previous_period("2025-03-01", "2025-03-31") == ("2025-01-29", "2025-02-28")
    with pytest.raises(ValueError):
        periods.previous_period("2025-03-02", "2025-03-01")


def test_empty_period(retail):
    got = periods.period_summary(retail.items, retail.orders, "1960-01-01", "1960-01-31")
    assert {(r.current_period, r.previous_period, r.change) for r in got.collect()} \
        == {(0, 0, "0.00%")}


# --- plans -----------------------------------------------------------------

@pytest.mark.parametrize("key", sorted(driver.queries()))
def test_plans_stay_in_the_jvm_and_off_single_tasks(spark, key):
    """No Python stage, no cross product, and no exchange that sends rows to one
    task unless they were aggregated or limited first."""
    plan = explain_text(driver.queries()[key](spark, DATA), "simple")
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # an aggregate, a limit, or the per-partition table of ``ordering``
            below = " ".join(lines[i + 1:i + 6])
            assert re.search(r"Aggregate|Limit|TakeOrdered|_part", below), plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = explain_text(driver.queries()["explain_plan"](spark, DATA))
    assert "GreaterThan(o_totalprice,400000.0)" in plan
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_totalprice:double>", plan)


def test_period_filter_reaches_the_scan(spark):
    plan = explain_text(driver.queries()["filter_between"](spark, DATA))
    pushed = next(l for l in plan.splitlines() if l.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_unused_tables_are_not_joined(spark):
    plan = explain_text(driver.queries()["sum_by_key"](spark, DATA), "simple")
    assert "part.parquet" not in plan and "customer.parquet" not in plan


def test_order_totals_reuse_the_join_partitioning(spark):
    """The per-order sum and the join that follows share one shuffle of the items."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = explain_text(driver.queries()["top_customers"](spark, DATA), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(order_id") == 2


@pytest.mark.parametrize("key", [
    "parse_timestamp_multi", "normalise_date", "drop_future", "clean_ecommerce_customers", "clean_ecommerce_orders",
    "clean_ecommerce", "cleaning_report", "signed_change", "period_summary"])
def test_generated_code_compiles(spark, key):
    """No stage is too large for one method; Spark would run such a stage row by row."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = driver.queries()[key](spark, DATA)
        plan = df._jdf.queryExecution().executedPlan()
        debug = getattr(spark._jvm.org.apache.spark.sql.execution, "debug")
        parts = getattr(getattr(debug, "package$"), "MODULE$").codegenStringSeq(plan)
        sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # -1: it did not compile at all; beyond 65,535 bytes Spark falls back
    assert sizes and all(0 < s < 65535 for s in sizes)


@pytest.mark.parametrize("key", ["running_total", "lag_per_key", "order_gap_risk", "reorder_risk_by_customer",
                                 "global_row_number", "ntile_global"])
def test_windows_move_rows_once(spark, key):
    """The range sort is part of what was staged; after that only aggregates and border rows are exchanged."""
    plan = explain_text(driver.queries()[key](spark, DATA), "simple").splitlines()
    for i, line in enumerate(plan):
        # by the last group of a partition: the table of borders, one row per partition
        if re.search(r"Exchange (hash|range)partitioning\((?!_last#)", line):
            assert re.search("HashAggregate|SortAggregate", " ".join(plan[i + 1:i + 3])), line


@pytest.mark.parametrize("key,scans", [("star_schema_split", 0), ("insert_select", 0), ("cleaning_report", 1)])
def test_the_fact_is_scanned_once(spark, key, scans):
    """The listing is staged for its three tables; the report reads its items once."""
    plan = explain_text(driver.queries()[key](spark, DATA))
    assert plan.count("lineitem.parquet") == scans


def test_lines_of_the_listing_move_once_per_large_key(spark, retail):
    """By part and by order; orders meet their customers before that, so no line moves by customer."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = explain_text(retail.sales(raw=True), "simple").splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = [re.search(r"\w", line + "x").start() for line in plan]
    moved = []
    for i, line in enumerate(plan):
        end = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
        if "Exchange hashpartitioning" in line and any("l_orderkey" in below for below in plan[i + 1:end]):
            moved.append(re.search(r"hashpartitioning\((\w+)#", line)[1])
    assert sorted(moved) == ["l_orderkey", "l_partkey"]


def test_groups_are_limited_before_the_shuffle(spark):
    plan = explain_text(driver.queries()["top_n_per_group"](spark, DATA), "simple").splitlines()
    below = [" ".join(plan[i + 1:i + 3]) for i, line in enumerate(plan) if "Exchange hashpartitioning" in line and "_share" in line]
    assert below and all("WindowGroupLimit" in b for b in below)


def test_top_k_fills_up_beyond_unknown_keys(retail):
    best = [r.customer_id for r in sales.top_customers(
        retail.items, retail.orders, retail.customers, 6).collect()]
    known = retail.customers.filter(~F.col("customer_id").isin(best[:3]))
    got = sales.top_customers(retail.items, retail.orders, known, 3).collect()
    assert [r.customer_id for r in got] == best[3:]
    period = (retail.items, retail.orders, retail.products, "1996-01-01", "1996-12-31")
    best = [r.product_id for r in periods.period_top_products(*period, k=6).collect()]
    known = retail.products.filter(~F.col("product_id").isin(best[:3]))
    got = periods.period_top_products(*period[:2], known, *period[3:], k=3).collect()
    assert [r.product_id for r in got] == best[3:]
