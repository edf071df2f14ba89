"""Named tables and typed loads."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind import schemas
from tradewind.operators import quality
from tradewind.session import stage
from tradewind.sources import files


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Overwrite a table and read it back by name.

    Without ``path`` the table is managed and lives in the warehouse folder.
    """
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return read_table(df.sparkSession, name)


def fresh_name(prefix: str) -> str:
    """A table name that no other run has."""
    return f"{prefix}_{uuid.uuid4().hex}"


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a table; the files of a managed one go with it."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Overwrite a table with data that may itself come from that table.

    A parquet table has no versions, so the rows are staged before the old
    files go.
    """
    return save_table(stage(df, name.replace(".", "_")), name, path)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of a layout, in order and in its types; bad text becomes NULL."""
    out = []
    for f in schema.fields:
        have = df.schema[f.name].dataType
        c = F.col(f.name)
        out.append((c if have == f.dataType else c.try_cast(f.dataType)).alias(f.name))
    return df.select(*out)


def load_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Cast to the declared layouts, check NOT NULL and CHECK rules, write parquet.

    The checks of a table are one aggregate, fail the load, and run on the
    written copy, so the plan behind the table is executed once.
    """
    loaded = {}
    for name, df in tables.items():
        schema = schemas.SCHEMAS[name]
        written = files.write_parquet(conform(df, schema), f"{folder.rstrip('/')}/{name}")
        rules = {
            **{f"{c} is not null": f"{c} IS NOT NULL" for c in schemas.required_columns(schema)},
            **schemas.CHECKS[name],
        }
        broken = quality.check_violations(written, rules).filter(F.col("violations") > 0)
        failed = [f"{r.rule} ({r.violations} rows)" for r in broken.collect()]
        if failed:
            raise ValueError(f"{name} breaks {', '.join(failed)}")
        loaded[name] = written
    return loaded
