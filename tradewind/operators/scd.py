"""Slowly changing dimensions, type 1 and type 2, as plain joins.

Parquet tables have no MERGE, so each function returns the whole new table; write
it next to the old one and switch over (``sources.tables.replace_table``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators import quality

CURRENT, VALID_FROM, VALID_TO = "is_current", "valid_from", "valid_to"


def one_row_per_key(source: DataFrame, key: str) -> DataFrame:
    """Fail if the batch holds a key twice: the merge would be ambiguous.

    NULL keys match nothing and may repeat.
    """
    columns = [c for c in source.columns if c != key]
    keyed = (
        source.filter(F.col(key).isNotNull()).groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*columns)).alias("_row"))
    )
    message = F.concat(F.lit("several source rows for key "), F.col(key).cast("string"))
    checked = keyed.filter(
        F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.lit(True)))
    rows = checked.select(*[
        F.col(key) if c == key else F.col("_row")[c].alias(c) for c in source.columns])
    return rows.unionByName(source.filter(F.col(key).isNull()))


def dim_clean(df: DataFrame) -> DataFrame:
    """Complete rows only, each once."""
    return quality.drop_duplicates(quality.drop_null_rows(df))


def scd1_merge(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Matched keys are overwritten, new ones inserted, the rest is kept.

    Rows without a key match nothing and stay out of the join, where they would
    all meet in one task.
    """
    batch = one_row_per_key(source, key)
    keyed = target.filter(F.col(key).isNotNull())
    kept = keyed.join(batch.select(key), key, "left_anti")
    return kept.unionByName(target.filter(F.col(key).isNull())).unionByName(batch)


def scd2_open(df: DataFrame, since: str) -> DataFrame:
    """A first load: every row is the current version, valid from column ``since``."""
    kind = df.schema[since].dataType
    return df.withColumns({
        CURRENT: F.lit(True), VALID_FROM: F.col(since), VALID_TO: F.lit(None).cast(kind)})


def scd2_merge(
    target: DataFrame, source: DataFrame, key: str, tracked: Sequence[str], since: str
) -> DataFrame:
    """Keep history: a matched key whose ``tracked`` columns changed gets a new
    current version and its old one is closed; new keys are inserted; unchanged
    matches and closed versions stay as they are.

    One full outer join on the key: each target row meets at most one source
    row, and the pair yields one or two result rows. Closed versions and rows
    without a key stay out of it.
    """
    batch = one_row_per_key(source, key)
    plain = [c for c in target.columns if c not in (CURRENT, VALID_FROM, VALID_TO)]
    joins = F.coalesce(F.col(CURRENT) & F.col(key).isNotNull(), F.lit(False))
    current, rest = target.filter(joins), target.filter(~joins)
    unkeyed = scd2_open(batch.filter(F.col(key).isNull()), since).select(*target.columns)
    batch = batch.filter(F.col(key).isNotNull())

    old = F.struct(*[F.col(c) for c in target.columns])
    since_kind = target.schema[VALID_FROM].dataType
    fresh = F.struct(
        *[F.col(c) for c in plain], F.lit(True).alias(CURRENT),
        F.col(since).cast(since_kind).alias(VALID_FROM),
        F.lit(None).cast(since_kind).alias(VALID_TO))
    left = current.select(F.col(key).alias("_k"), old.alias("_old"))
    right = batch.select(F.col(key).alias("_k"), fresh.alias("_new"))
    both = left.join(right, "_k", "full_outer")

    same = F.lit(True)
    for c in tracked:
        same = same & F.col("_old")[c].eqNullSafe(F.col("_new")[c])
    expired = F.struct(*[
        {CURRENT: F.lit(False), VALID_TO: F.col("_new")[VALID_FROM]}
        .get(c, F.col("_old")[c]).alias(c) for c in target.columns])
    new = F.struct(*[F.col("_new")[c].alias(c) for c in target.columns])
    kept = F.struct(*[F.col("_old")[c].alias(c) for c in target.columns])
    versions = (
        F.when(F.col("_new").isNull(), F.array(kept))
        .when(F.col("_old").isNull(), F.array(new))
        .when(same, F.array(kept))
        .otherwise(F.array(expired, new))
    )
    return both.select(F.inline(versions)).unionByName(rest).unionByName(unkeyed)


def scd_validate(df: DataFrame, key: str, current_only: bool = False) -> DataFrame:
    """(row_count, current_rows, duplicate_keys): the last one must be 0."""
    live = F.col(CURRENT) if current_only else F.lit(True)
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(live).alias("_live"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("_live"), F.lit(0)).alias("current_rows"),
        F.count_if(F.col("_live") > 1).alias("duplicate_keys"),
    )
