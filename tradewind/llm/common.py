"""Helpers shared by the text operators: word hashes, small batches, gapless numbering."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import stage

#: bytes of text handled at once by a Python worker
BATCH_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: odd multipliers that mix the hashes of consecutive words into one
_MIX = np.random.default_rng(20).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variation of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(batches, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in batches whose ``column`` holds about ``limit`` bytes.

    A text longer than that makes a batch of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def map_texts(df: DataFrame, column: str, schema: str,
              work: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> DataFrame:
    """``work`` over small batches of ``df``, partition by partition."""
    def run(batches):
        for batch in small(batches, column):
            out = work(batch)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def ascii_words(text: str | None) -> list[bytes]:
    """The maximal runs without ``\\x20`` and ``\\x09`` to ``\\x0D``, as UTF-8."""
    return text.encode().split() if text else []


def hashes(words: list[bytes]) -> np.ndarray:
    """64 bits for each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """64 bits for each run of ``n`` consecutive word hashes."""
    m = max(0, len(h) - n + 1)
    s = np.zeros(m, np.uint64)
    for j in range(n):
        s += h[j:j + m] * _MIX[j]
    s ^= s >> np.uint64(31)
    s *= _MIX[-1]
    s ^= s >> np.uint64(29)
    return s


def number(df: DataFrame, keys: list[str], into: str, name: str) -> DataFrame:
    """Number the rows of each key (none of them null) from 0 without gaps, in the order in which they are read.

    A key may hold any share of the rows: each task counts its own rows of a key, and one small
    row for each pair of task and key tells where a task begins. What a task counted is written
    before it is used, so that a task run again cannot number rows in another way.
    """
    part, base = fresh(df, "_part"), fresh(df, "_base")
    columns = df.columns

    def count(batches):
        seen: dict[tuple, int] = {}
        task = TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                own = pa.Table.from_batches([batch]).select(keys).to_pandas()
                groups = own.groupby(keys, sort=False)
                at = groups.cumcount().to_numpy(np.int64)
                for key, rows in groups.indices.items():
                    key = key if isinstance(key, tuple) else (key,)
                    at[rows] += seen.get(key, 0)
                    seen[key] = seen.get(key, 0) + len(rows)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), pa.array(np.full(len(at), task, np.int32))],
                                                 [*columns, into, part])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    staged = stage(df.mapInArrow(count, f"{kinds}, `{into}` long, `{part}` int"), name)
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (staged.groupBy(*keys, part).agg(F.count("*").alias(base))
              .withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0))))
    return (staged.join(stage(starts, f"{name}_starts"), [*keys, part])
            .withColumn(into, F.col(into) + F.col(base)).select(*columns, into))
