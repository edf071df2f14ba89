"""Merkle manifest of a dataset: a tree for each source, and one over the sources.

Nodes are numbered within their tree, and a **slot pivot** makes each level: conditional aggregates spread the children
of a parent into ``FANOUT`` columns, one for each slot. Concatenating the columns and hashing gives the parent's digest;
leaving out the column of the own slot gives a child's siblings. A parent row that holds the only node of
its level passes that digest on unchanged, so that all trees can be walked as if equally deep.

Proofs are put together from the top: each row of a level takes over the path of its parent, which costs one row for
``FANOUT`` children. The leaves get theirs out of the pivoted row, which also carries their ids.

Keys are (tree, place), so a source with a third of all rows is spread like any other. Leaves are numbered by a range
sort, a count in each partition and one small row for each source and partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import LOWER, UPPER, number
from tradewind.session import stage

FANOUT = 16
_PATH = "array<struct<before: string, after: string>>"


def leaf(*columns: str | Column) -> Column:
    """SHA-256 of the columns: ``-`` for null, else UTF-8 byte count, ``:`` and value."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def manifest(docs: DataFrame, name: str = "merkle") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for each row of ``docs``.

    ``docs`` has doc_id, source, lang, n_chars and text. Where 5 divides the CRC-32 of the decimal doc_id, the row is
    checked as if its text had been lower-cased (A to Z); ``verified`` tells whether the root still comes out.

    * Rows of a source ascend by doc_id, null first, and by leaf among rows of one doc_id. Rows that are equal
      in all five columns are leaves of their own; which of them stands first makes no difference to any digest.
    * A missing source is a tree of its own, before all others. A missing text is not changed by lower-casing.
    * An empty table gives no rows. Extra columns are ignored and not part of a leaf.
    """
    docs = docs.select("doc_id", "source", "lang", "n_chars", "text")
    row = ("doc_id", "source", "lang", "n_chars")
    lowered = F.translate("text", UPPER, LOWER)
    # a string for each source that is never null and sorts null first, then bytewise; rand tells equal rows apart
    leaves = stage(docs.select(
        F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0")).alias("tree"), "doc_id", leaf(*row, "text").alias("digest"),
        F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, leaf(*row, lowered)).alias("tampered"),
        F.rand(12).alias("tie")), f"{name}_leaves")
    order = ["tree", "doc_id", "digest", "tie"]
    placed = number(leaves.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie"), ["tree"], "pos", f"{name}_placed")
    levels = _levels(placed, ("doc_id", "tampered"), name)
    tops = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest")
    order = ["tree", "source_tree"]
    tops = number(tops.repartitionByRange(*order).sortWithinPartitions(*order), ["tree"], "pos", f"{name}_sources")
    above = _levels(tops, ("source_tree",), f"{name}_above")
    roots = _walked(above, above[-1].select("tree", F.lit(None).cast(_PATH).alias("path"), F.col("digest").alias("root")), ("root",))
    roots = stage(_children(roots, ("source_tree",), ("root",))
                  .select(F.col("source_tree").alias("tree"), F.col("digest").alias("subroot"), "path", "root"), f"{name}_roots")
    below = _walked(levels, roots, ("subroot", "root"))
    out = _children(below, ("doc_id", "tampered"), ("subroot", "root"))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    folded = F.aggregate("path", F.coalesce("tampered", "digest"),
                         lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))
    return (out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"),
                       folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def _levels(nodes: DataFrame, carried: tuple[str, ...], name: str) -> list[DataFrame]:
    """The levels above ``nodes`` (tree, pos, digest), up to one row for each tree.

    A row has tree, pos, digest, ``digest_0`` to ``digest_15`` and, above the nodes themselves, each carried column alike.
    """
    levels: list[DataFrame] = []
    while not levels or (levels[-1].agg(F.max("pos")).first()[0] or 0) > 0:
        slot = F.pmod("pos", F.lit(FANOUT))
        spread = [F.max(F.when(slot == i, F.col(c))).alias(f"{c}_{i}") for c in ("digest", *carried) for i in range(FANOUT)]
        wide = nodes.groupBy("tree", F.expr(f"pos div {FANOUT}").alias("up")).agg(*spread).withColumnRenamed("up", "pos")
        whole = F.sha2(F.concat_ws("", *[f"digest_{i}" for i in range(FANOUT)]), 256)
        wide = wide.withColumn("digest", F.when(_passes(), F.col("digest_0")).otherwise(whole))
        levels.append(stage(wide, f"{name}_{len(levels) + 1}"))
        nodes, carried = levels[-1].select("tree", "pos", "digest"), ()
    return levels


def _passes() -> Column:
    """Whether a row of a level stands over the only node of its tree."""
    return (F.col("pos") == 0) & F.col("digest_1").isNull()


def _extended(slot: Column) -> Column:
    """The path of the child in ``slot`` of a row with its own ``path``."""
    own = F.struct(F.concat_ws("", *[F.when(F.lit(i) < slot, F.col(f"digest_{i}")) for i in range(FANOUT)]).alias("before"),
                   F.concat_ws("", *[F.when(F.lit(i) > slot, F.col(f"digest_{i}")) for i in range(FANOUT)]).alias("after"))
    above = F.coalesce("path", F.array().cast(_PATH))
    return F.when(_passes(), above).otherwise(F.concat(F.array(own), above))


def _walked(levels: list[DataFrame], tops: DataFrame, extra: tuple[str, ...]) -> DataFrame:
    """The lowest level with the path of each row to the root; ``tops`` (tree, path, *extra) has the paths of the trees."""
    rows = levels[-1].join(tops, "tree")
    for level in reversed(levels[:-1]):
        own = [c for c in level.columns if c not in ("tree", "pos")]
        low = level.select("tree", "pos", *[F.col(c).alias(f"own_{c}") for c in own])
        high = rows.withColumnRenamed("pos", "up").withColumn("pos", F.col("up"))
        high = high.select("tree", "up", "pos", "path", *extra, *[f"digest_{i}" for i in range(FANOUT)])
        both = (low.withColumn("up", F.expr(f"pos div {FANOUT}")).withColumn("slot", F.pmod("pos", F.lit(FANOUT)))
                .withColumnRenamed("pos", "own_pos").join(high, ["tree", "up"]))
        rows = both.select("tree", F.col("own_pos").alias("pos"), _extended(F.col("slot")).alias("path"), *extra,
                           *[F.col(f"own_{c}").alias(c) for c in own])
    return rows


def _children(rows: DataFrame, carried: tuple[str, ...], extra: tuple[str, ...]) -> DataFrame:
    """digest, the carried columns, path and ``extra`` of each child of ``rows``."""
    one = [F.struct(F.lit(i).alias("slot"), *[F.col(f"{c}_{i}").alias(c) for c in ("digest", *carried)]) for i in range(FANOUT)]
    held = rows.withColumn("child", F.explode(F.filter(F.array(*one), lambda c: c["digest"].isNotNull())))
    return held.select("child.digest", *[f"child.{c}" for c in carried], _extended(F.col("child.slot")).alias("path"), *extra)
