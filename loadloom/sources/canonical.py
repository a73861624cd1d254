"""The canonical hourly table: schema, reading, writing, projection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import KEYS, TS
from ..functions.clock import as_instant
from ..functions.scalars import nan_to_null
from ..session import require_utc

LOAD, FORECAST = "load_mw", "tso_forecast_mw"
WEATHER = ("temp_c", "wind_ms", "cloud_cover", "humidity_pct")
VALUES = (LOAD, FORECAST, *WEATHER)
COLUMNS = (*VALUES, "is_holiday", "data_source_version")

SCHEMA = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField(TS, T.TimestampType()),
        *[T.StructField(c, T.DoubleType()) for c in VALUES],
        T.StructField("is_holiday", T.BooleanType()),
        T.StructField("data_source_version", T.StringType()),
    ]
)


def new_run_id(now: datetime | None = None) -> str:
    """Identifier of one ingest, kept per row to tell which run wrote it last."""
    return (now or datetime.now(timezone.utc)).strftime("run-%Y%m%dT%H%M%SZ")


def empty(spark: SparkSession, schema: T.StructType = SCHEMA) -> DataFrame:
    """A missing source is a typed empty frame, not an error."""
    return spark.createDataFrame([], schema)


def project(df: DataFrame, run_id: str | None = None, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Canonical columns in order; an absent value column becomes null."""
    values = [
        F.col(c).cast("double").alias(c) if c in df.columns else F.lit(None).cast("double").alias(c)
        for c in VALUES
    ]
    flag = F.col("is_holiday") if "is_holiday" in df.columns else F.lit(None).cast("boolean")
    if run_id is not None:
        version = F.lit(run_id)
    elif "data_source_version" in df.columns:
        version = F.col("data_source_version")
    else:
        version = F.lit(None).cast("string")
    return df.select(*keys, ts, *values, flag.alias("is_holiday"), version.alias("data_source_version"))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = SCHEMA) -> DataFrame:
    """Read with a declared schema; times must be instants, NaN becomes null.

    A column declared zoneless in the files is taken as UTC wall time.
    """
    require_utc(spark)
    df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    for f in df.schema:
        if isinstance(f.dataType, T.TimestampNTZType):
            df = as_instant(df, f.name, "UTC")
    return nan_to_null(df)


def read_if_present(spark: SparkSession, path: str, schema: T.StructType = SCHEMA) -> DataFrame:
    """As ``read_table``; a path that does not exist yields the typed empty frame."""
    return read_table(spark, path, schema) if path_exists(spark, path) else empty(spark, schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def write_table(
    df: DataFrame, path: str, keys: Sequence[str] = KEYS, ts: str = TS, grain: str = "month"
) -> str:
    """Write in folders of one month (or day); only folders present in ``df`` are replaced.

    Partitioning by series would make one folder per series; sorting inside the files
    gives row-group pruning on the key for any number of series. Rows of a folder are
    spread by series and day, so neither a long series nor a month is one writer task.
    """
    pattern = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}[grain]
    spread = df.withColumn("period", F.date_format(ts, pattern))
    (
        spread.repartition(F.col("period"), *[F.col(k) for k in keys], F.to_date(ts))
        .sortWithinPartitions("period", *keys, ts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period")
        .parquet(path)
    )
    return path


def read_periods(
    spark: SparkSession, path: str, only: Sequence[str] | None = None, schema: T.StructType = SCHEMA
) -> DataFrame:
    """Read a table of ``write_table``; ``only`` names the folders to read."""
    with_period = T.StructType([*schema, T.StructField("period", T.StringType())])
    df = read_table(spark, path, with_period)
    return (df if only is None else df.filter(F.col("period").isin(*only))).drop("period")


def value_column(df: DataFrame, preferred: str, out: str, other: Sequence[str] = (*KEYS, TS)) -> DataFrame:
    """The preferred value column when present, else the first that is not a key."""
    candidates = [c for c in df.columns if c not in other]
    if not candidates:
        raise ValueError("no value column")
    chosen = preferred if preferred in candidates else candidates[0]
    return df.select(*[c for c in other if c in df.columns], F.col(chosen).alias(out))
