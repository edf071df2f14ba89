"""Data-quality checks and cleaning rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tradewind.functions import columns as C
from tradewind.operators import ordering
from tradewind.session import stage

# Hashes that ``drop_few_duplicates`` sends to every task, at most: some 10 MB.
SHARED_HASHES = 200_000


# --- NULLs and duplicates --------------------------------------------------

def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or any of the given) columns."""
    return df.na.drop(subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, value) -> DataFrame:
    """One value for every column, or a value per column.

    A single value also fills text columns, with its text form; columns of other
    types (dates, flags) are left alone.
    """
    if isinstance(value, Mapping):
        return df.fillna(dict(value))
    filled = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, NumericType):
            filled[f.name] = F.coalesce(F.col(f.name), F.lit(value).cast(f.dataType))
        elif isinstance(f.dataType, StringType):
            filled[f.name] = F.coalesce(F.col(f.name), F.lit(str(value)))
    return df.withColumns(filled)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; NULLs count as equal.

    A row is one key, so that it is dealt out by all of its columns: grouped by the
    columns one by one, Spark would reuse the partitioning of a join below on one of
    them, and all rows of a hot value would meet in one task.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    return df.select(row).distinct().select("_row.*")


def drop_few_duplicates(df: DataFrame, most: int = SHARED_HASHES) -> DataFrame:
    """``drop_duplicates`` of staged rows, most of which have no equal.

    The hashes of the rows are counted first; a row whose hash is its own has no equal and
    stays where it is. The others, which are few, go through ``drop_duplicates``, so that equal
    hashes of different rows do no harm. With over ``most`` hashes of several rows, all rows do.
    The rows are read more than once, so they must be staged.
    """
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("_hash")
    counted = df.select(row_hash).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    shared = stage(counted.filter(F.col("_n") > 1).select("_hash"), "shared_hashes")
    found = shared.count()
    if found > most:
        return drop_duplicates(df)
    if not found:
        return df
    hashed, shared = df.select("*", row_hash), F.broadcast(shared)
    single = hashed.join(shared, "_hash", "left_anti").drop("_hash")
    several = hashed.join(shared, "_hash", "left_semi").drop("_hash")
    return single.unionAll(drop_duplicates(several))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows, as one row."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of NULLs of each column, in a single pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def zero_count(df: DataFrame, column: str, name: str = "zero_rows") -> DataFrame:
    return df.agg(F.count_if(F.col(column) == 0).alias(name))


def describe_numeric(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """count, mean, stddev, min and max, one row per column, in a single pass."""
    parts = []
    for c in columns:
        v = F.col(c).cast("double")
        parts.append(F.struct(
            F.lit(c).alias("column_name"),
            F.count(v).alias("count"),
            F.round(F.avg(v), digits).alias("mean"),
            F.round(F.stddev_samp(v), digits).alias("stddev"),
            F.round(F.min(v), digits).alias("min"),
            F.round(F.max(v), digits).alias("max"),
        ))
    return df.agg(F.array(*parts).alias("_all")).select(F.inline("_all"))


# --- single-column rules ---------------------------------------------------

def drop_blank_key(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~C.is_blank(column))


def drop_future(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    """Rows up to and including ``as_of``; NULL dates go as well."""
    return df.filter(F.col(column) <= as_of)


def drop_zero_quantity(df: DataFrame, column: str = "quantity") -> DataFrame:
    """Drop zeros; returns (negative) and NULLs stay."""
    return df.filter(~F.col(column).eqNullSafe(0))


def reset_out_of_range(
    df: DataFrame, column: str = "discount_percent", low=0, high=100, value=0
) -> DataFrame:
    """Replace values outside [low, high]; NULLs stay."""
    c = F.col(column)
    kind = df.schema[column].dataType
    return df.withColumn(
        column, F.when((c < low) | (c > high), F.lit(value).cast(kind)).otherwise(c))


def normalise_date(df: DataFrame, column: str) -> DataFrame:
    """Text to date by the general layouts alone (month first); rows that cannot be read are dropped."""
    return df.withColumn(column, C.parse_timestamp(column, formats=()).cast("date")).filter(
        F.col(column).isNotNull())


def invalid_emails(df: DataFrame, key: str = "customer_id", email: str = "email") -> DataFrame:
    """Keys of rows whose email is missing or malformed; nothing is dropped."""
    return df.filter(C.invalid_email(email)).select(key)


# --- references ------------------------------------------------------------

def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent."""
    return child.join(parent.select(key), key, "left_anti")


def keep_referenced(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows with a parent."""
    return child.join(parent.select(key), key, "left_semi")


# --- declared constraints --------------------------------------------------

def primary_key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that are NULL or repeated, with their row count."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
        .filter((F.col("row_count") > 1) | F.col(key).isNull())
    )


def duplicate_keys(df: DataFrame, key: str | Sequence[str], name: str = "row_count") -> DataFrame:
    """Keys that occur more than once."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def check_violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Failed rows per rule; as with CHECK, an unknown outcome passes."""
    counts = [
        F.struct(F.lit(n).alias("rule"), F.count_if(~F.expr(sql)).alias("violations"))
        for n, sql in rules.items()]
    return df.agg(F.array(*counts).alias("_all")).select(F.inline("_all"))


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column that must not have any."""
    counts = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("violations"))
        for c in columns]
    return df.agg(F.array(*counts).alias("_all")).select(F.inline("_all"))


def foreign_key_violations(
    tables: Mapping[str, DataFrame], keys: Sequence[tuple[str, str, str]], parent_keys: Mapping[str, str]
) -> DataFrame:
    """(child_table, column_name, key_value) of every row without its parent.

    A NULL reference is no violation.
    """
    found = []
    for child, column, parent in keys:
        known = tables[parent].select(F.col(parent_keys[parent]).alias(column))
        missing = tables[child].filter(F.col(column).isNotNull()).join(known, column, "left_anti")
        found.append(missing.select(
            F.lit(child).alias("child_table"), F.lit(column).alias("column_name"),
            F.col(column).cast("string").alias("key_value")))
    return reduce(DataFrame.unionByName, found)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table."""
    counted = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def build_dimension(
    df: DataFrame, key: str, attributes: Sequence[str], policy: str = "error"
) -> DataFrame:
    """The distinct attribute rows of a key.

    A key with several attribute combinations is handled by ``policy``:
    ``error`` fails, ``keep_all`` keeps them all, ``first`` keeps the smallest
    combination, comparing the attributes in the given order with NULL first.
    """
    if policy not in ("error", "keep_all", "first"):
        raise ValueError(f"unknown policy {policy!r}")
    rows = drop_duplicates(df.select(key, *attributes))
    if policy == "keep_all":
        return rows
    packed = F.struct(*[F.col(a) for a in attributes])
    # the key as a struct, so that a join below on the key itself can be split
    one = (
        rows.groupBy(F.struct(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(packed).alias("_row"))
        .select(F.col("_key")[key].alias(key), "_n", "_row")
    )
    if policy == "error":
        message = F.concat(F.lit("several attribute rows for key "), F.col(key).cast("string"))
        one = one.filter(F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.lit(True)))
    return one.select(key, *[F.col("_row")[a].alias(a) for a in attributes])


# --- profile ---------------------------------------------------------------

def schema_profile(df: DataFrame) -> DataFrame:
    """(ordinal, column_name, data_type, row_count, column_count) of a table."""
    fields = [
        F.struct(F.lit(i).alias("ordinal"), F.lit(n).alias("column_name"), F.lit(t).alias("data_type"))
        for i, (n, t) in enumerate(df.dtypes, start=1)]
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.inline(F.array(*fields)), "row_count",
                F.lit(len(df.columns)).alias("column_count"))
    )


def preview(df: DataFrame, n: int = 5, order: Sequence[Column] | None = None) -> DataFrame:
    """The first ``n`` rows; with ``order`` the first in that order.

    Rows have no position of their own, so the *last* rows are the first ones of
    the reversed order.
    """
    return ordering.top_k(df, order, n) if order else df.limit(n)


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text, for checks on pushdown and exchanges."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))
