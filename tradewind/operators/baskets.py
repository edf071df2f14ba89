"""Products bought in the same order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.session import stage

# Orders are cut into blocks of about this many different products; the result is
# the same for any value.
BLOCK = 1000
# How many of the strongest products are paired up to find a floor.
PROBES = 16
COUNT = "times_bought_together"


def basket_lines(items: DataFrame) -> DataFrame:
    """(order_id, product_id, copies): repeated lines of an order as one row."""
    return items.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("copies"))


def pairs_per_order(items: DataFrame) -> DataFrame:
    """How many item-row pairs with different products each order holds.

    Of n rows there are n*n ordered pairs; those of equal products make up
    sum(copies^2); half of the rest has the smaller product first. Nothing is
    paired up to count them.
    """
    n = F.sum("copies")
    return (
        basket_lines(items).groupBy("order_id")
        .agg(((n * n - F.sum(F.col("copies") * F.col("copies"))) / 2).cast("long").alias("pairs"))
    )


def order_blocks(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """(order_id, blocks) of the orders with more than ``block`` different products."""
    return (
        lines.groupBy("order_id").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
        .filter(F.col("blocks") > 1)
    )


def _pairs(lines: DataFrame, floor: float = 0) -> DataFrame:
    """Pair counts.

    ``lines`` has one row per order and product with its ``copies``, the ``blocks``
    its order is cut into, and the ``bound`` of its label. Blocks i and j of an order
    meet for i <= j only, each pair of blocks being a join key of its own: no task
    holds more than two blocks of an order, and no pair is made twice. ``floor`` drops
    pairs whose bound cannot reach it.
    """
    own = F.pmod(F.hash("product_id"), F.col("blocks"))
    later = F.explode(F.sequence(own, F.col("blocks") - 1))
    earlier = F.explode(F.sequence(F.lit(0), own))

    def side(i: Column, j: Column, mark: str) -> DataFrame:
        return lines.select(
            "order_id", i.alias("_i"), j.alias("_j"), F.col("product_id").alias(f"_id_{mark}"),
            F.col("label").alias(f"_label_{mark}"), F.col("copies").alias(f"_copies_{mark}"),
            F.col("bound").alias(f"_bound_{mark}"))

    ordered = F.col("_id_a") < F.col("_id_b")
    pairs = side(own, later, "a").join(side(earlier, own, "b"), ["order_id", "_i", "_j"]).filter(
        (F.col("_i") < F.col("_j")) | ordered)
    if floor > 1:  # every pair there is counts once at least
        pairs = pairs.filter(F.col("_bound_a") * F.col("_bound_b") >= floor)
    return (
        pairs.groupBy(
            F.when(ordered, F.col("_label_a")).otherwise(F.col("_label_b")).alias("product_a"),
            F.when(ordered, F.col("_label_b")).otherwise(F.col("_label_a")).alias("product_b"))
        .agg(F.sum(F.col("_copies_a") * F.col("_copies_b")).alias(COUNT))
    )


def _kth(pairs: DataFrame, k: int) -> float:
    """The k-th best count, or 1 if there are fewer pairs."""
    best = pairs.orderBy(F.col(COUNT).desc()).limit(k)
    return best.agg(
        F.when(F.count(F.lit(1)) == k, F.min(COUNT)).otherwise(1).cast("double")).first()[0]


def bought_together(
    items: DataFrame, products: DataFrame, label: str = "product_name", k: int = 20,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` label pairs most often found in one order, exactly.

    Counts item-row pairs with a.product_id < b.product_id, so two labels may
    appear in either order. Equal lines of an order are folded first, and orders are
    cut into blocks by their number of *different* products, whatever their number of lines.

    All pairs of a large order would be quadratic in its products. But two labels
    cannot be found together more often than norm_a * norm_b, the norm being the
    root of the summed squares of a label's lines per order (Cauchy-Schwarz; a
    label's norm is at most the sum of its products' norms). The k-th best count
    among a few strong products is a floor that the k-th best total certainly reaches,
    so labels and pairs with a bound below it need not be counted.
    """
    names = products.select("product_id", F.col(label).alias("label"))
    # rows without an order or a product pair with nothing
    bought = items.select("order_id", "product_id").dropna()
    lines = stage(basket_lines(bought), "basket_lines")
    large = stage(order_blocks(lines, block), "order_blocks")
    cut = lines.join(large, "order_id", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    square = F.col("copies").cast("double") * F.col("copies")
    norms = lines.groupBy("product_id").agg(F.sqrt(F.sum(square)).alias("_norm"))
    named = names.join(norms, "product_id")
    bounds = named.groupBy(F.col("label").alias("_label")).agg(F.sum("_norm").alias("bound"))
    # staged: Spark splits a hot product in a join only if both sides come straight out of a shuffle;
    # products without a label are a group of their own, as in any grouping
    labels = stage(named.join(bounds, F.col("label").eqNullSafe(F.col("_label"))).drop("_label"), "basket_labels")
    strong = (labels.orderBy(F.col("_norm").desc(), "product_id").limit(PROBES)
              .select("product_id", "label", F.col("_norm").alias("bound")))
    # one part in a million off the floor makes up for rounding in the roots
    floor = _kth(_pairs(cut.join(F.broadcast(strong), "product_id")), k) * (1 - 1e-6)
    best = labels.agg(F.max("bound")).first()[0] or 0.0
    useful = labels.filter(F.col("bound") * best >= floor).drop("_norm")
    order = [F.col(COUNT).desc(), F.col("product_a").asc(), F.col("product_b").asc()]
    return _pairs(cut.join(useful, "product_id"), floor).orderBy(*order).limit(k)
