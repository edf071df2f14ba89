import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewind.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    (SparkSession.builder.config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("wh")))
     .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))))
    session = local_session("8", partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def retail(spark):
    from tradewind.catalog.views import Retail

    return Retail(spark, DATA)


@pytest.fixture
def many_partitions(spark):
    """Keep small data in several partitions, so that partition borders matter."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield spark
    spark.conf.set(key, "true")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
