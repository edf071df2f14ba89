"""Customer batches that arrive as files, merged one micro-batch at a time."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tradewind.operators import scd
from tradewind.sources import files


def stream_batches(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1
) -> DataFrame:
    """New CSV files in ``folder``; with one file per micro-batch a key may be in
    several files. Every micro-batch rewrites the table, so take as many files at
    once as are known not to share keys."""
    return (
        spark.readStream.schema(schema).option("header", True).option("escape", '"')
        .option("maxFilesPerTrigger", files_per_batch).csv(folder)
    )


def _version(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/version={number:010d}"


def _system(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, pattern: str, part: int) -> list[int]:
    """The numbers in one part (counted from the end) of the paths that fit."""
    system, at = _system(spark, pattern)
    return sorted(int(f.getPath().toString().split("/")[part].rpartition("=")[2]) for f in system.globStatus(at) or [])


def complete(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of all versions that were written in full."""
    return _numbers(spark, f"{folder.rstrip('/')}/version=*/_SUCCESS", -2)


def version(spark: SparkSession, folder: str, number: int) -> DataFrame:
    return files.read_parquet(spark, _version(folder, number))


def newest(spark: SparkSession, folder: str) -> DataFrame:
    """The table as last written in full, whatever the stream that wrote it."""
    found = complete(spark, folder)
    if not found:
        raise FileNotFoundError(f"no version of a table was written in full below {folder}")
    return version(spark, folder, found[-1])


def expire(spark: SparkSession, folder: str, keep: int) -> list[int]:
    """Delete all but the newest ``keep`` complete versions; returns the numbers of those that went.

    A mark of each stays, so that a repeated batch still knows that it was merged.
    """
    if keep < 1:
        raise ValueError("at least the newest version has to stay")
    gone = complete(spark, folder)[:-keep]
    for number in gone:
        _create(spark, f"{folder.rstrip('/')}/expired/{number:010d}", True)
        system, at = _system(spark, _version(folder, number))
        system.delete(at, True)
    return gone


def first_load(df: DataFrame, folder: str) -> DataFrame:
    return files.write_parquet(df, _version(folder, 0))


def _create(spark: SparkSession, path: str, again: bool = False) -> None:
    """An empty file; an error if it is there, unless ``again``."""
    system, at = _system(spark, path)
    system.create(at, again).close()


def _claim(spark: SparkSession, folder: str, owner: str) -> int:
    """The version after all that exist or are claimed, taken for a batch.

    Creating a file fails if it is there, so two writers never share a version.
    """
    folder = folder.rstrip("/")
    number = 1 + max([*complete(spark, folder), *_numbers(spark, f"{folder}/claims/*", -1)])
    _create(spark, f"{folder}/claims/{number:010d}")
    _create(spark, f"{folder}/owners/{owner}/{number:010d}")
    return number


def _merged(spark: SparkSession, folder: str, owner: str) -> bool:
    """Whether a version of this batch was written in full, even if it has expired since."""
    folder = folder.rstrip("/")
    own = set(_numbers(spark, f"{folder}/owners/{owner}/*", -1))
    return bool(own & {*complete(spark, folder), *_numbers(spark, f"{folder}/expired/*", -1)})


def merge_stream(
    batches: DataFrame, folder: str, checkpoint: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> StreamingQuery:
    """Fold every micro-batch into the table below ``folder``.

    A batch reads the newest complete version and writes the one after all others, claimed in the name of
    the stream (its checkpoint's id) and the batch. So a stream with a new checkpoint goes on where the table
    stands, and a batch repeated after a failure finds out whether it was merged: with a complete
    version of its own it does nothing, otherwise it starts anew from the newest one. Each batch counts exactly
    once. One stream at a time may write a table.
    """
    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
        owner = f"{stream}/{batch_id}"
        if not _merged(spark, folder, owner):
            merged = merge(newest(spark, folder), batch)
            files.write_parquet(merged, _version(folder, _claim(spark, folder, owner)))

    return (
        batches.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def last_batch(query: StreamingQuery) -> int:
    """Wait for the end and return the number of the last batch with rows, or -1."""
    query.awaitTermination()
    return max((p.batchId for p in query.recentProgress if p.numInputRows), default=-1)


def merge_scd1(key: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    return lambda target, source: scd.scd1_merge(target, source, key)


def merge_scd2(
    key: str, tracked: Sequence[str], since: str
) -> Callable[[DataFrame, DataFrame], DataFrame]:
    return lambda target, source: scd.scd2_merge(target, source, key, tracked, since)
