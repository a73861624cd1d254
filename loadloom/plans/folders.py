"""What is known of each folder of a stored table, so that it need not be read again.

One row per folder and series: its hours, their ends, the newest value, and a content hash that
adds up. Each is a mergeable number: a write replaces the rows of the folders it replaced, and
the whole table's resume points, rebuild decision and fingerprint are sums over some rows per
folder, whatever the folders hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import KEYS, TS
from ..sources.canonical import LOAD, path_exists
from ..sources.tables import GRAINS

_SUM = "decimal(38,0)"


def folder_state(
    df: DataFrame, grain: str = "month", value: str = LOAD, keys: Sequence[str] = KEYS, ts: str = TS, without: Sequence[str] = (),
) -> DataFrame:
    """(period, keys, n, first_ts, last_ts, last_value_ts, hash_a, hash_b) of the rows' folders.

    The hashes are sums of two row hashes over all columns but ``without``, nulls included:
    equal rows in any order give equal sums, and sums of parts add up to that of the whole.
    """
    names = sorted(c for c in df.columns if c not in without)
    cells = [*[F.col(c) for c in names], *[F.col(c).isNull() for c in names]]
    hashed = [F.sum(F.xxhash64(F.lit(seed), *cells).cast(_SUM)).cast(_SUM).alias(f"hash_{x}") for seed, x in ((1, "a"), (2, "b"))]
    return df.groupBy(F.date_format(ts, GRAINS[grain]).alias("period"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.max(F.when(F.col(value).isNotNull(), F.col(ts))).alias("last_value_ts"), *hashed,
    )


def merged_state(state: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """The state of whole series (or, without ``by``, of the table) from that of their folders."""
    return state.groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.max("last_value_ts").alias("last_value_ts"), *[F.sum(c).cast(_SUM).alias(c) for c in ("hash_a", "hash_b")],
    )


def fingerprints(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """12 hex digits per group that change if its rows change; no rows: those of an empty group."""
    text = F.concat_ws("|", F.coalesce("n", F.lit(0)).cast("string"), *[F.coalesce(F.col(c), F.lit(0)).cast("string") for c in ("hash_a", "hash_b")])
    return merged_state(state, by).select(*by, F.coalesce("n", F.lit(0)).alias("n"), F.substring(F.sha2(text, 256), 1, 12).alias("fingerprint"))


def write_state(state: DataFrame, path: str) -> None:
    """Replace the rows of the folders in ``state``; all others stay."""
    state.repartition("period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)


def read_state(spark: SparkSession, path: str, keys: Sequence[str] = KEYS, kind: T.DataType | None = None) -> DataFrame:
    """The stored state; no table yet: no rows."""
    key = kind or T.StringType()
    at = [T.StructField(c, T.TimestampType()) for c in ("first_ts", "last_ts", "last_value_ts")]
    sums = [T.StructField(c, T.DecimalType(38, 0)) for c in ("hash_a", "hash_b")]
    schema = T.StructType([*[T.StructField(k, key) for k in keys], T.StructField("n", T.LongType()), *at, *sums, T.StructField("period", T.StringType())])
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def high_water_of(state: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, last_actual): the newest hour with a value, from the state alone."""
    return merged_state(state, keys).select(*keys, F.col("last_value_ts").alias("last_actual"))
