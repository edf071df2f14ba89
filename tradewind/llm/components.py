"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import stage


def components(links: DataFrame, name: str) -> DataFrame:
    """id, component (the smallest id reachable) for each id in ``links`` (u, v); longs, no nulls.

    Alternating large-star and small-star steps: each attaches the neighbours of an id to
    the smallest of them, until every id hangs directly on the smallest of its component. A
    step is one pre-aggregated minimum and one join. The minima are written first, so that an id
    with very many links can be split in the join. The steps end when each component is a star around its smallest id.
    """
    edges = stage(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), f"{name}_0")
    for step in range(1, 100):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m"))
                      .select("u", F.least("u", "m").alias("m")), f"{name}_{step}_large")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # distinct: a neighbour may get the same minimum from several sides
        large = stage(large.where("u <> v").distinct(), f"{name}_{step}_edges")
        lower = stage(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}_{step}_small")
        hung = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(hung.unionByName(lower.withColumnRenamed("m", "v")).distinct(), f"{name}_{step}")
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(roots).select(F.col("u").alias("id"), F.col("v").alias("component"))


def _settled(edges: DataFrame) -> bool:
    """Whether every id hangs on one other id, which hangs on none."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up")))
    seen = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return seen.where((F.col("ups") > 1) | (F.col("ups") > 0) & (F.col("least") == 0)).isEmpty()
