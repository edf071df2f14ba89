"""Session helpers and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tradewind")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def staging_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever chosen for a local master, where the
    driver and the executors are the same process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tradewind-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the staging folder."""
    return f"{staging_root(spark).rstrip('/')}/tradewind/{uuid.uuid4().hex}/{name}"


def stage_by(df: DataFrame, key: str, name: str = "staged") -> DataFrame:
    """``stage``, read back so that the rows of one value of ``key`` lie together.

    The files are buckets of ``key``, so a window or a join on it needs no exchange any more. The table is only
    named while it is read: its files stay, and the name is free again.
    """
    spark = df.sparkSession
    table = f"tradewind_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.format("parquet").bucketBy(buckets, key)
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    read = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return read


def stage(df: DataFrame, name: str = "staged", compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    The result no longer depends on the plan that made it: lost executors cost
    a re-read, and partition numbers taken while writing can never change.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
