"""Append-only tables behind the daily loop: predictions, scores, drift checks, runs.

Each is a parquet folder. Appends never rewrite; a table that must be replaced is written
as a new version folder, and readers take the newest version that finished.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.latest import latest_per_key
from .canonical import empty, path_exists, read_if_present

D, S, L, TSN = T.DoubleType(), T.StringType(), T.LongType(), T.TimestampType()


def _schema(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


PREDICTIONS = _schema(
    id=L, series_id=S, predicted_at=TSN, target_time=TSN, horizon_hours=T.IntegerType(), load_mw=D,
    p10=D, p50=D, p90=D, model_name=S, model_version=S, run_id=S, dataset_version=S,
    features=T.MapType(S, D),
)
SCORES = _schema(
    prediction_id=L, actual_mw=D, abs_error_mw=D, ape=D, tso_forecast_mw=D, tso_abs_error_mw=D,
    scored_at=TSN,
)
DRIFT_HISTORY = _schema(
    series_id=S, checked_at=TSN, status=S, drift_share=D, drifted_features=L, monitored_features=L,
    drifted_names=S, reference_strategy=S, reference_rows=L, current_rows=L, rolling_mape=D,
    tso_mape=D, scored_predictions=L,
)
#: ``series_id`` is null for a step of the whole deployment.
EVENTS = _schema(series_id=S, pipeline=S, event=S, at=TSN, reason=S)
RUNS = _schema(
    run_id=S, name=S, model_name=S, version=S, horizon=T.IntegerType(), dataset_version=S, feature_set=S, data_source=S,
    started_at=TSN, params=T.MapType(S, S), metrics=T.MapType(S, D), tags=T.MapType(S, S),
)
ALIASES = _schema(model_name=S, alias=S, version=S, run_id=S, at=TSN)
GATE_DECISIONS = _schema(
    model_name=S, version=S, run_id=S, promote=T.BooleanType(), code=S, reason=S, at=TSN
)

FORECAST_KEY = ("series_id", "target_time", "horizon_hours", "model_version")


def append_predictions(predictions: DataFrame, path: str, batch_id: str | None = None) -> None:
    """Append served predictions; every call is kept, repeats for one target included.

    Ids hash the batch and the row, so a retried task writes the same ids again and two
    calls never share one. Files are laid out by target day for pruned reads.
    """
    named = {f.name for f in PREDICTIONS}
    wanted = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        if f.name in predictions.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in PREDICTIONS
    ]
    rows = predictions.select(*wanted)
    if "id" not in predictions.columns:
        key = [c for c in ("series_id", "predicted_at", "target_time", "horizon_hours", "load_mw", "model_name", "model_version") if c in named]
        rows = rows.withColumn("id", F.xxhash64(F.lit(batch_id or uuid.uuid4().hex), *key))
    (
        rows.withColumn("target_date", F.to_date("target_time")).repartition("target_date")
        .write.mode("append").partitionBy("target_date").parquet(path)
    )


def read_predictions(
    spark: SparkSession, path: str, since=None, until=None, model_version: str | None = None, days: Sequence | None = None
) -> DataFrame:
    """Logged predictions by target hour, both ends inclusive, or by a set of target days.

    The bounds reach the scan twice: as partition pruning on the day and as row-group
    filters on the hour. Order with ``in_log_order`` at the sink.
    """
    if not path_exists(spark, path):
        return empty(spark, PREDICTIONS)
    schema = T.StructType([*PREDICTIONS, T.StructField("target_date", T.DateType())])
    df = spark.read.schema(schema).parquet(path)
    return filter_predictions(df, since, until, model_version, days).drop("target_date")


def filter_predictions(df: DataFrame, since=None, until=None, model_version: str | None = None, days: Sequence | None = None) -> DataFrame:
    by_day = "target_date" in df.columns
    if days is not None:
        df = df.filter((F.col("target_date") if by_day else F.to_date("target_time")).isin(*days))
    if since is not None:
        low = F.lit(since).cast("timestamp")
        df = df.filter(F.col("target_time") >= low)
        df = df.filter(F.col("target_date") >= F.to_date(low)) if by_day else df
    if until is not None:
        high = F.lit(until).cast("timestamp")
        df = df.filter(F.col("target_time") <= high)
        df = df.filter(F.col("target_date") <= F.to_date(high)) if by_day else df
    if model_version is not None:
        df = df.filter(F.col("model_version") == str(model_version))
    return df


def in_log_order(df: DataFrame) -> DataFrame:
    return df.orderBy("target_time", "predicted_at", "id")


def latest_per_target(df: DataFrame, key: Sequence[str] = FORECAST_KEY) -> DataFrame:
    """The forecast that stood: newest per key, the later id on equal times."""
    return latest_per_key(df, [k for k in key if k in df.columns], ["predicted_at", "id"])


def append(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append rows with the declared columns; an absent one is null."""
    cols = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    df.select(*cols).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_if_present(spark, path, schema)


def append_drift_history(checks: DataFrame, path: str) -> None:
    """CSV, one row per check, quiet ones included."""
    cols = [
        (F.col(f.name) if f.name in checks.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in DRIFT_HISTORY
    ]
    checks.select(*cols).write.mode("append").option("header", True).csv(path)


def read_drift_history(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return empty(spark, DRIFT_HISTORY)
    return spark.read.schema(DRIFT_HISTORY).option("header", True).csv(path).orderBy("checked_at")


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Write a full replacement beside the old one; nothing reads it until it finished."""
    df.write.mode("errorifexists").parquet(f"{path}/version={version:08d}")


def latest_version(spark: SparkSession, path: str) -> int:
    """Newest finished version (its success marker exists), 0 when there is none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    newest = 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("version=") and fs.exists(done):
            newest = max(newest, int(name.split("=")[1]))
    return newest


def read_version(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    version = latest_version(spark, path)
    if not version:
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(f"{path}/version={version:08d}")


#: Folder names of the score table: one folder per target day or month.
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


def read_scores(spark: SparkSession, path: str, periods: Sequence[str] | None = None) -> DataFrame:
    """The score table with its ``period``; ``periods`` limits the folders that are read."""
    schema = T.StructType([*SCORES, T.StructField("period", S)])
    if not path_exists(spark, path):
        return empty(spark, schema)
    df = spark.read.schema(schema).parquet(path)
    return df if periods is None else df.filter(F.col("period").isin(*periods))


def write_score_periods(df: DataFrame, path: str) -> None:
    """Replace the folders that ``df`` has rows for; all others keep their files."""
    (
        df.repartition("period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("period").parquet(path)
    )


def export_csv(df: DataFrame, path: str) -> str:
    """Segment and prediction tables for people: CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def load_evidence(spark: SparkSession, candidates: Sequence[tuple[str, str, str]], schema: T.StructType):
    """First existing CSV folder that has the wanted model column.

    ``candidates`` are ``(path, model column, label)`` in order of preference. Returns the
    frame, the model column and the label; the typed empty frame when none fits.
    """
    for path, column, label in candidates:
        if not path_exists(spark, path):
            continue
        header = spark.read.option("header", True).csv(path).columns
        if column not in header:
            continue
        known = {f.name: f.dataType for f in schema}
        fields = T.StructType([T.StructField(c, known.get(c, D)) for c in header])
        return spark.read.schema(fields).option("header", True).csv(path), column, label
    return empty(spark, schema), candidates[-1][1] if candidates else None, ""
