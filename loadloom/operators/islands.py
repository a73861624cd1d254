"""Consecutive hours as runs (first, last, hours)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import KEYS, TS
from ..functions.clock import hour_number, hour_start
from .blocks import BLOCK_HOURS, block_of


def hour_runs(
    df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS, size: int = BLOCK_HOURS
) -> DataFrame:
    """Runs of consecutive hours per key: ``first_ts``, ``last_ts``, ``hours``.

    Two levels. Runs are found inside each time block; only the at most two runs of a
    block that touch its edges can continue elsewhere, so only those meet again per key.
    """
    keys = list(keys)
    inside = Window.partitionBy(*keys, "_b").orderBy("_h")
    pieces = (
        df.select(*keys, hour_number(ts).alias("_h"))
        .withColumn("_b", block_of("_h", size))
        .withColumn("_g", F.col("_h") - F.dense_rank().over(inside))
        .groupBy(*keys, "_b", "_g")
        .agg(F.min("_h").alias("h0"), F.max("_h").alias("h1"))
    )
    edge = (F.pmod("h0", F.lit(size)) == 0) | (F.pmod("h1", F.lit(size)) == size - 1)
    # The edge pieces go into their own window partitions; interior ones pass through it
    # grouped by block, so no partition outgrows a block or the number of blocks.
    pieces = pieces.withColumn("_scope", F.when(edge, F.lit(None).cast("long")).otherwise(F.col("_b")))
    order = Window.partitionBy(*keys, "_scope").orderBy("h0")
    starts = F.when(
        F.col("h0") == F.lag("h1").over(order) + 1, F.lit(0)
    ).otherwise(F.lit(1))
    runs = (
        pieces.withColumn("_new", starts)
        .withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_scope", "_run")
        .agg(F.min("h0").alias("h0"), F.max("h1").alias("h1"))
    )
    return runs.select(
        *keys,
        hour_start("h0").alias("first_ts"),
        hour_start("h1").alias("last_ts"),
        (F.col("h1") - F.col("h0") + 1).alias("hours"),
    )
