import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def instants(spark, rows, schema):
    """Frame from rows whose timestamps are UTC text."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructField, StructType, StringType, TimestampType

    target = StructType.fromDDL(schema)
    text = StructType(
        [StructField(f.name, StringType() if isinstance(f.dataType, TimestampType) else f.dataType) for f in target]
    )
    df = spark.createDataFrame(rows, text)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])


@pytest.fixture(scope="session")
def frame(spark):
    return lambda rows, schema: instants(spark, rows, schema)
