"""Distributed windows against plain ones: ties, NULLs, hot groups, borders."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.operators import ordering as o
from tradewind.operators.quality import explain_text



def frame(spark, shape):
    ids = spark.range(4000)
    keys = {
        "few_values": F.when(F.col("id") % 17 == 0, None).otherwise(F.hash("id") % 50),
        "three_values": F.hash("id") % 2,
        "all_equal": F.lit(5),
        "all_null": F.lit(None).cast("int"),
        "hot_value": F.when(F.col("id") % 3 == 0, 7).otherwise(F.hash("id") % 1000),
        "unique": (F.col("id") * 7) % 4001,
    }
    return ids.select(
        "id", keys[shape].cast("decimal(12,4)").alias("k"),
        # group 0 holds half of the rows, one group is NULL
        F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 11 == 0, None)
        .otherwise(F.col("id") % 5).alias("g"),
        F.when(F.col("id") % 13 != 0, F.hash("id") % 100).cast("long").alias("x"))


SHAPES = ["few_values", "three_values", "all_equal", "all_null", "hot_value", "unique"]


def mismatches(df, got, window):
    want = df.select(F.col("id").alias("_id"), window.alias("_want"))
    joined = got.join(want, got["id"] == want["_id"], "full")
    assert got.count() == df.count()
    return joined.filter(~F.col("r").eqNullSafe(F.col("_want"))).count()


@pytest.mark.parametrize("shape", SHAPES)
def test_windows_equal_plain_windows(many_partitions, shape):
    df = frame(many_partitions, shape).persist()
    down, up = F.col("k").desc_nulls_last(), F.col("k").asc_nulls_first()
    by_id = [down, F.col("id").asc()]
    g = W.partitionBy("g")
    cases = {
        "row_number": (o.global_row_number(df, by_id, "r"), F.row_number().over(W.orderBy(*by_id))),
        "ntile": (o.global_ntile(df, by_id, 7, "r"), F.ntile(7).over(W.orderBy(*by_id))),
        "rank": (o.global_rank(df, "k", "r"), F.rank().over(W.orderBy(down))),
        "rank_up": (o.global_rank(df, "k", "r", False), F.rank().over(W.orderBy(up))),
        "dense": (o.global_dense_rank(df, "k", "r"), F.dense_rank().over(W.orderBy(down))),
        "sum": (o.global_cumulative(df, "k", "x", "r"), F.sum("x").over(W.orderBy(down))),
        "group_rank": (o.ranks(df, "k", ["g"], rank="r"), F.rank().over(g.orderBy(down))),
        "group_dense": (o.rank_in_group(df, ["g"], "k", "r"), F.dense_rank().over(g.orderBy(down))),
        "group_sum": (o.ranks(df, "k", ["g"], cumulative={"x": "r"}),
                      F.sum("x").over(g.orderBy(down))),
        "running": (o.running_total(df, ["g"], by_id, "x", "r"), F.sum("x").over(
            g.orderBy(*by_id).rowsBetween(W.unboundedPreceding, 0))),
        "lag": (o.lag_in_group(df, ["g"], by_id, "x", "r"), F.lag("x").over(g.orderBy(*by_id))),
    }
    bad = {n: c for n, (got, w) in cases.items() if (c := mismatches(df, got, w))}
    df.unpersist()
    assert not bad


@pytest.mark.parametrize("rows,tiles", [(0, 4), (1, 4), (3, 4), (4, 4), (10, 4), (7, 1)])
def test_ntile_sizes(many_partitions, rows, tiles):
    df = many_partitions.range(rows)
    got = o.global_ntile(df, [F.col("id").asc()], tiles, "t").groupBy("t").count().collect()
    sizes = [n for _, n in sorted((r["t"], r["count"]) for r in got)]
    want = [rows // tiles + (i < rows % tiles) for i in range(tiles)]
    assert sizes == [n for n in want if n]


def test_empty_input(many_partitions):
    df = many_partitions.range(0).select("id", F.lit(1).alias("k"), F.lit(1).alias("g"))
    assert o.global_rank(df, "k", "r").collect() == []
    assert o.lag_in_group(df, ["g"], [F.col("id")], "k", "r").collect() == []


@pytest.mark.parametrize("shape", SHAPES)
def test_top_n_per_group(spark, shape):
    df = frame(spark, shape)
    got = o.top_n_per_group(df, ["g"], "k", 3, "r")
    plain = df.withColumn("r", F.dense_rank().over(
        W.partitionBy("g").orderBy(F.col("k").desc_nulls_last()))).filter("r <= 3")
    assert sorted(map(repr, got.select(plain.columns).collect())) \
        == sorted(map(repr, plain.collect()))
    plan = explain_text(got, "simple")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ties_share_their_rank_with_top_n(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 4), ("a", 3), ("a", 2)], "g string, k int")
    assert o.top_n_per_group(df, ["g"], "k", 3).count() == 4
