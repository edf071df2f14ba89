"""Summaries used by several business questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as C


def global_stats(df: DataFrame, columns: Sequence[str] = ("sales", "profit")) -> DataFrame:
    """One row: row count, then mean, smallest and largest of each column."""
    out = [F.count(F.lit(1)).alias("total_orders")]
    for c in columns:
        out += [
            C.mean_of(F.sum(c), F.count(c)).alias(f"avg_{c}"),
            F.min(c).alias(f"min_{c}"),
            F.max(c).alias(f"max_{c}"),
        ]
    return df.agg(*out)


def sales_summary(
    df: DataFrame, keys: Sequence[str], sales: str = "sales", profit: str = "profit"
) -> DataFrame:
    """order_count, total_sales and avg_profit per key, biggest sales first."""
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum(sales).cast("decimal(28,4)").alias("total_sales"),
            C.mean_of(F.sum(profit), F.count(profit)).alias("avg_profit"),
        )
        .orderBy(F.col("total_sales").desc(), *keys)
    )


def sum_by_key(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(column).cast("decimal(28,4)").alias(name))


def signed_quantities(items: DataFrame, key: str) -> DataFrame:
    """Bought and returned units per key; a return has a negative quantity."""
    q = F.col("quantity").cast("long")
    return items.groupBy(key).agg(
        F.sum(F.when(q > 0, q).otherwise(0)).alias("total_purchased"),
        F.sum(F.when(q < 0, F.abs(q)).otherwise(0)).alias("total_returned"),
    )


def keys_with_single(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    """Keys with exactly one distinct ``counted``.

    One distinct value means smallest = largest, which needs no distinct count.
    """
    return (
        df.groupBy(key)
        .agg(F.min(counted).alias("_lo"), F.max(counted).alias("_hi"))
        .filter(F.col("_lo") == F.col("_hi"))
        .select(key, F.lit(1).cast("long").alias(name))
    )


def distinct_per_key(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    """Exact distinct count per key."""
    return df.groupBy(key).agg(F.count_distinct(counted).alias(name))
