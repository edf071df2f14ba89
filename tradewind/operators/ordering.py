"""Windows over a whole table, or over groups of any size, on many tasks.

``ROW_NUMBER() OVER (ORDER BY x)`` has no partition key, so a plain window pulls
every row into one task; a window partitioned by a hot key does the same to that
key. The functions here sort with a range shuffle instead, which splits the table
and every hot group evenly, write the sorted rows once as buckets of their partition
(see ``stage_by``), and then only need one small correction per output partition.
That range shuffle is the only time all rows move: windows inside a partition read
the buckets as they lie.

* row number, ntile   position inside the partition + rows before the partition
* rank, dense rank, cumulative sum
                      the same on one row per *distinct* value, joined back
* lag                 the last row of the partition before
* group aggregates    the groups that reach over a partition border

The tables of per-partition corrections hold one row per partition, which bounds
what is broadcast and what the unpartitioned windows on them see.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import stage, stage_by

PART, POS, INDEX, TOTAL = "_part", "_pos", "_index", "_total"
_POSITION_BITS = 33


def direction(name: str, descending: bool) -> Column:
    """NULL is the smallest value, as in most stores: first going up, last going down."""
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_first()


def sorted_parts(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows in total order, staged; each knows its partition (``_part``) and its
    place in it (``_pos``).

    ``monotonically_increasing_id`` puts the partition number in the upper bits
    and the running number in the lower 33.
    """
    numbered = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())
    lower = F.lit((1 << _POSITION_BITS) - 1).cast("long")
    placed = (
        numbered.withColumn(PART, F.shiftright("_slot", _POSITION_BITS))
        .withColumn(POS, F.col("_slot").bitwiseAND(lower))
        .drop("_slot")
    )
    return stage_by(placed, PART, "ordered")


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi join in which NULL keys meet; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _last_rows(parts: DataFrame, *columns: Column) -> DataFrame:
    """``_part`` and the given columns of the last row of each partition."""
    last = parts.groupBy(PART).agg(F.max(POS).alias(POS))
    return parts.join(F.broadcast(last), [PART, POS]).select(PART, *columns)


def with_position(
    df: DataFrame,
    order: Sequence[Column],
    sums: Sequence[str] = (),
    group: Sequence[str] = (),
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in ``order`` and add running sums.

    Adds ``_index`` and for every ``c`` in ``sums`` ``_upto_c``, the sum of ``c``
    over all rows up to and including this one; without ``group`` also ``_total``,
    the number of rows. With ``group`` numbers and sums restart in every group.
    ``order`` should be unique, otherwise equal rows are numbered arbitrarily.
    """
    if group:
        return _with_group_position(df, list(group), order, sums)
    staged = sorted_parts(df, order)
    per_part = staged.groupBy(PART).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in sums])
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(PART).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_part.select(
        PART,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(everything).alias(TOTAL),
        *[F.sum(f"_s_{c}").over(earlier).alias(f"_before_{c}") for c in sums],
    )
    inside = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    rows = staged.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in sums])
    joined = rows.join(F.broadcast(offsets), PART)
    return joined.select(
        *df.columns, (F.col(POS) + F.col("_before")).alias(INDEX), TOTAL,
        *[_added(F.col(f"_before_{c}"), F.col(f"_in_{c}")).alias(f"_upto_{c}") for c in sums])


def _added(before: Column, here: Column) -> Column:
    """before + here as SUM adds: NULL only if both are."""
    return F.when(before.isNull(), here).otherwise(before + F.coalesce(here, F.lit(0)))


def _with_group_position(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], sums: Sequence[str]
) -> DataFrame:
    """``with_position`` per group.

    Sorted by group first, only the first group of a partition can have rows in
    earlier ones, where it is the last group. What it had collected there is the
    sum over those last groups, worked out on one row per partition.
    """
    staged = sorted_parts(df, [*(F.col(g).asc() for g in group), *order])
    own = F.struct(*group)
    counted = {"n": F.count(F.lit(1)), **{c: F.sum(c) for c in sums}}

    first = staged.filter(F.col(POS) == 0).select(PART, own.alias("_first"))
    last = _last_rows(staged, own.alias("_last"))
    tail = (
        staged.join(F.broadcast(last.withColumnRenamed("_last", "_of")), PART)
        .filter(own.eqNullSafe(F.col("_of")))
        .groupBy(PART).agg(*[v.alias(f"_tail_{n}") for n, v in counted.items()])
    )
    same_group = Window.partitionBy("_last").orderBy(PART).rowsBetween(
        Window.unboundedPreceding, 0)
    by_part = Window.orderBy(PART)
    collected = first.join(last, PART).join(tail, PART).select(
        PART, "_first", "_last",
        *[F.sum(f"_tail_{n}").over(same_group).alias(f"_all_{n}") for n in counted])
    goes_on = F.lag("_last").over(by_part).eqNullSafe(F.col("_first"))
    carried = collected.select(
        PART, "_first",
        *[F.when(goes_on, F.lag(f"_all_{n}").over(by_part)).alias(f"_carry_{n}")
          for n in counted])

    inside = Window.partitionBy(PART, *group).orderBy(POS).rowsBetween(
        Window.unboundedPreceding, 0)
    rows = staged.withColumns({f"_in_{n}": v.over(inside) for n, v in counted.items()})
    joined = rows.join(F.broadcast(carried), PART)

    def upto(n: str) -> Column:
        return _added(F.when(own.eqNullSafe(F.col("_first")), F.col(f"_carry_{n}")),
                      F.col(f"_in_{n}"))

    return joined.select(
        *df.columns, (upto("n") - 1).alias(INDEX), *[upto(c).alias(f"_upto_{c}") for c in sums])


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_num") -> DataFrame:
    """ROW_NUMBER over the whole table; end ``order`` with a unique column."""
    return with_position(df, order).select(*df.columns, (F.col(INDEX) + 1).alias(name))


def global_ntile(
    df: DataFrame, order: Sequence[Column], tiles: int, name: str = "tile"
) -> DataFrame:
    """NTILE over the whole table: the first ``rows mod tiles`` tiles get one more row."""
    placed = with_position(df, order)
    small = F.expr(f"{TOTAL} div {tiles}")
    larger = F.col(TOTAL) % tiles
    edge = larger * (small + 1)
    tile = F.when(F.col(INDEX) < edge, F.floor(F.col(INDEX) / (small + 1))).otherwise(
        larger + F.floor(F.try_divide(F.col(INDEX) - edge, small)))
    return placed.select(*df.columns, (tile + 1).cast("int").alias(name))


def ranks(
    df: DataFrame,
    key: str,
    group: Sequence[str] = (),
    descending: bool = True,
    rank: str | None = None,
    dense_rank: str | None = None,
    cumulative: dict[str, str] | None = None,
) -> DataFrame:
    """RANK, DENSE_RANK and RANGE-framed running sums over ``key``.

    ``cumulative`` maps a summed column to the name of its running sum; equal
    keys share the value, as in the default window frame. With ``group`` the
    functions restart in every group. All of them are the same for equal keys,
    so they are worked out on one row per distinct key: ties of any size shrink
    to a row before the first shuffle.
    """
    cumulative = cumulative or {}
    group = list(group)
    distinct = df.groupBy(*group, key).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{c}") for c in cumulative])
    sums = [*(["_rows"] if rank else []), *[f"_sum_{c}" for c in cumulative]]
    placed = with_position(distinct, [direction(key, descending)], sums, group)

    out = []
    if rank:
        out.append((F.col("_upto__rows") - F.col("_rows") + 1).alias(rank))
    if dense_rank:
        out.append((F.col(INDEX) + 1).alias(dense_rank))
    for c, name in cumulative.items():
        out.append(F.col(f"_upto__sum_{c}").alias(name))
    return _null_safe(df, placed.select(*group, key, *out), [*group, key], "inner")


def with_group_values(
    parts: DataFrame, group: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """Add aggregates of each group to all of its rows, for groups of any size.

    ``parts`` must be sorted by ``group`` first. Only the first and the last group
    of a partition can reach into another one, so the aggregate of every other
    group is a window inside its partition, without a further shuffle; the few
    groups at the borders are aggregated apart and broadcast, at most two rows per
    partition.
    """
    group = list(group)
    inside = Window.partitionBy(PART, *group)
    local = parts.withColumns({n: v.over(inside) for n, v in values.items()})
    ends = parts.filter(F.col(POS) == 0).select(*group).unionByName(
        _last_rows(parts, *[F.col(g) for g in group]).select(*group))
    border = ends.distinct()
    whole = (
        _null_safe(parts, F.broadcast(border), group, "inner")
        .groupBy(*group).agg(*[v.alias(f"_whole_{n}") for n, v in values.items()])
    )
    joined = _null_safe(local, F.broadcast(whole), group, "left")
    return joined.withColumns(
        {n: F.coalesce(F.col(f"_whole_{n}"), F.col(n)) for n in values}
    ).drop(*[f"_whole_{n}" for n in values])


def global_rank(df: DataFrame, key: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """RANK over the whole table, with gaps after ties."""
    return ranks(df, key, descending=descending, rank=name)


def global_dense_rank(
    df: DataFrame, key: str, name: str = "dense_rank", descending: bool = True
) -> DataFrame:
    """DENSE_RANK over the whole table, without gaps."""
    return ranks(df, key, descending=descending, dense_rank=name)


def rank_in_group(
    df: DataFrame, group: Sequence[str], key: str, name: str, descending: bool = True
) -> DataFrame:
    """DENSE_RANK inside groups of any size."""
    return ranks(df, key, group=group, descending=descending, dense_rank=name)


def global_cumulative(
    df: DataFrame, key: str, value: str, name: str, descending: bool = True
) -> DataFrame:
    """SUM(value) OVER (ORDER BY key): equal keys share their running sum."""
    return ranks(df, key, descending=descending, cumulative={value: name})


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str, name: str
) -> DataFrame:
    """Row-by-row running sum per group, for groups of any size.

    ``order`` should end with a unique column.
    """
    placed = with_position(df, order, [value], group)
    return placed.select(*df.columns, F.col(f"_upto_{value}").alias(name))


def lag_in_parts(parts: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """LAG(value, 1) per group over ``parts`` sorted by ``group`` first.

    The first row of a partition takes over from the last row of the one before.
    """
    row = F.struct(*[F.col(g).alias(f"g{i}") for i, g in enumerate(group)], F.col(value).alias("v"))
    carried = _last_rows(parts, row.alias("_end")).select(
        PART, F.lag("_end").over(Window.orderBy(PART)).alias("_carry"))
    before = F.lag(row).over(Window.partitionBy(PART).orderBy(POS))
    joined = parts.withColumn("_prev", before).join(F.broadcast(carried), PART)
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & prev[f"g{i}"].eqNullSafe(F.col(g))
    return joined.withColumn(
        name, F.when(prev.isNotNull() & same, prev["v"])
    ).drop("_prev", "_carry")


def lag_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str, name: str
) -> DataFrame:
    """LAG(value, 1) per group, for groups of any size."""
    parts = sorted_parts(df, [*(F.col(g).asc() for g in group), *order])
    return lag_in_parts(parts, group, value, name).drop(PART, POS)


def top_n_per_group(
    df: DataFrame, group: Sequence[str], key: str, n: int, name: str = "rank", shares: int = 16
) -> DataFrame:
    """Rows whose DENSE_RANK in their group is at most ``n``.

    Rows are dealt into ``shares`` of their group at random. What is among the best
    ``n`` of the group is so in any share as well, and Spark keeps the best ``n`` of a
    share before the shuffle (WindowGroupLimit): each task sends on ``n`` keys for each
    group and share, with their ties, and neither a hot group nor a key shared by very
    many rows reaches one task. The distinct keys that are left, ``n`` for each share
    at most, are then ranked exactly, and the rows that are left look up their key.
    """
    group = list(group)
    best_first = F.col(key).desc_nulls_last()
    dealt = df.withColumn("_share", (F.rand(5) * shares).cast("int"))
    inside = Window.partitionBy(*group, "_share").orderBy(best_first)
    left = (
        dealt.withColumn("_rank", F.dense_rank().over(inside)).filter(F.col("_rank") <= n)
        .drop("_rank", "_share")
    )
    keys = left.select(*group, key).distinct()
    best = keys.withColumn(
        name, F.dense_rank().over(Window.partitionBy(*group).orderBy(best_first))
    ).filter(F.col(name) <= n)
    return _null_safe(left, best, [*group, key], "inner")


def at_ends(df: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    """Rows that hold the smallest or the largest ``key`` of their group, with all ties; NULL keys are none.

    Two extremes of a plain column are a hash aggregate, which shrinks a hot group before
    the shuffle. What is to be picked out of the ties is then decided among few rows.
    """
    # staged: Spark splits a hot key in a join only if both sides come straight out of a shuffle
    ends = stage(df.groupBy(*group).agg(F.min(key).alias("_least"), F.max(key).alias("_most")), "ends")
    held = _null_safe(df, ends, list(group), "inner")
    return held.filter((F.col(key) == F.col("_least")) | (F.col(key) == F.col("_most"))).drop("_least", "_most")


def first_last(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
    first: str, last: str,
) -> DataFrame:
    """``value`` of the first and of the last row of each group; later columns of ``order`` break ties."""
    by = F.struct(*order)
    return at_ends(df, group, order[0]).groupBy(*group).agg(
        F.min_by(value, by).alias(first), F.max_by(value, by).alias(last))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k; every task keeps only its own first ``k``."""
    return df.orderBy(*order).limit(k)
