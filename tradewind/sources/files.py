"""CSV and parquet files."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None,
    multiline: bool = False, **options,
) -> DataFrame:
    """CSV with a header line.

    Quotes inside a quoted field are doubled (``14 7/8""``), so the escape
    character is the quote itself; with the default backslash such rows shift
    into the wrong columns. ``multiline`` also allows line breaks inside fields,
    but reads each file in one task: convert such files to parquet once. Without
    a schema the types are inferred, which costs a pass over the data.
    """
    reader = (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multiline).options(**options))
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet; a known schema saves the look into the footers."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a parquet folder and read it back.

    Refuses to overwrite its own input: Spark would delete the files before
    reading them.
    """
    _refuse_own_input(df, path)
    df.write.mode("overwrite").parquet(path)
    return read_parquet(df.sparkSession, path, df.schema)


def write_csv(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a CSV folder, quoted so that ``read_csv`` restores every field."""
    _refuse_own_input(df, path)
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return df


def export_csv(df: DataFrame, path: str) -> DataFrame:
    """One CSV file, for small results only: call it after the aggregation.

    The rows are gathered by an exchange, so the work above it stays parallel.
    """
    return write_csv(df.repartition(1), path)


def _qualified(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path with its scheme and host."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(at)


def input_roots(df: DataFrame) -> list[str]:
    """The paths that the file scans behind ``df`` were given, however many files lie below them."""
    def items(seq):
        return [seq.apply(i) for i in range(seq.size())]

    plan = df._jdf.queryExecution().analyzed()
    leaves = [leaf for p in [plan, *items(plan.subqueriesAll())] for leaf in items(p.collectLeaves())]
    roots = []
    for leaf in leaves:
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                roots += [_qualified(df.sparkSession, p.toString())[1].toString() for p in items(relation.location().rootPaths())]
    return roots


def _refuse_own_input(df: DataFrame, path: str) -> None:
    system, target = _qualified(df.sparkSession, path)
    if not system.exists(target):
        return
    target = target.toString().rstrip("/") + "/"
    for root in input_roots(df):
        root = root.rstrip("/") + "/"
        if root.startswith(target) or target.startswith(root):
            raise ValueError(f"{path} is read by the data to be written; stage to a new path")


def source_metadata(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """One row per file: path, size, last change, rows, columns, and that it exists.

    Files are listed by the binary source, which does not open them, so that files without
    rows are there; files without a single byte, which Spark passes over, are added. A path at which
    nothing lies gives one row with ``exists`` false and no size.
    """
    system, at = _qualified(spark, path)
    kind = "file_path string, file_size long, modified timestamp"
    if not system.exists(at):
        missing = spark.createDataFrame([(at.toString(), None, None)], kind)
        return missing.select("*", F.lit(0).cast("long").alias("row_count"), F.lit(None).cast("int").alias("column_count"),
                              F.lit(False).alias("exists"))
    m = F.col("_metadata")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        m["file_path"].alias("file_path"), m["file_size"].alias("file_size"),
        m["file_modification_time"].alias("modified"))
    empty, files = [], system.listFiles(at, True)
    while files.hasNext():
        f = files.next()
        if f.getLen() == 0 and f.getPath().getName()[0] not in "._":
            changed = dt.datetime.fromtimestamp(f.getModificationTime() / 1000)
            empty.append((f.getPath().toUri().toString().replace("file:/", "file:///", 1), 0, changed))
    listed = listed.unionByName(spark.createDataFrame(empty, kind))
    try:
        df = spark.read.format(fmt).options(**options).load(path)
    except AnalysisException:
        if not listed.filter("file_size > 0").isEmpty():
            raise
        df = spark.range(0).select(F.lit(None).cast("string").alias("_none"))  # nothing to take a layout from
        counts = df.select(F.col("_none").alias("file_path"), F.lit(0).cast("long").alias("row_count"))
        columns = 0
    else:
        counts = df.groupBy(m["file_path"].alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))
        columns = len(df.columns)
    return (
        listed.join(counts, "file_path", "left")
        .select("file_path", "file_size", "modified", F.coalesce("row_count", F.lit(0)).alias("row_count"),
                F.lit(columns).alias("column_count"), F.lit(True).alias("exists"))
    )


def copy_dataset(
    spark: SparkSession, source: str, target: str, fmt: str = "csv",
    schema: StructType | None = None,
) -> DataFrame:
    """Copy a data set and check it: (rows_read, rows_written, column_count).

    Rows are counted while they are written and again in the copy; raises unless
    both agree.
    """
    def load(path: str) -> DataFrame:
        if fmt == "csv":
            return read_csv(spark, path, schema)
        return spark.read.format(fmt).load(path)

    data = load(source)
    _refuse_own_input(data, target)
    counted = Observation()
    watched = data.observe(counted, F.count(F.lit(1)).alias("rows_read"))
    if fmt == "csv":
        write_csv(watched, target)
    else:
        watched.write.mode("overwrite").format(fmt).save(target)
    rows_read = counted.get["rows_read"]
    rows_written = load(target).count()
    if rows_read != rows_written:
        raise RuntimeError(f"copy of {source} is incomplete: {rows_written} of {rows_read} rows")
    return spark.range(1).select(
        F.lit(rows_read).alias("rows_read"), F.lit(rows_written).alias("rows_written"),
        F.lit(len(data.columns)).alias("column_count"))
