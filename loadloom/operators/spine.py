"""The complete hourly axis of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import KEYS, TS
from ..functions.clock import hour_number, hour_start
from .blocks import BLOCK_HOURS, block_of


def bounds(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """First and last hour number per key."""
    h = hour_number(ts)
    return df.groupBy(*keys).agg(F.min(h).alias("h_first"), F.max(h).alias("h_last"))


def hours_between(spans: DataFrame, keys: Sequence[str] = KEYS, size: int = BLOCK_HOURS) -> DataFrame:
    """Every hour from ``h_first`` to ``h_last``, both included.

    Two steps: blocks first, spread over the cluster, then the hours of each block, so a
    single long series is neither one huge array nor one task.
    """
    blocks = spans.filter("h_first <= h_last").select(
        *keys, "h_first", "h_last",
        F.explode(F.sequence(block_of("h_first", size), block_of("h_last", size))).alias("_b"),
    )
    hours = F.sequence(
        F.greatest(F.col("h_first"), F.col("_b") * size),
        F.least(F.col("h_last"), F.col("_b") * size + (size - 1)),
    )
    # A stated partition count: adaptive coalescing would size these tiny rows by their
    # bytes and run the explosion on one task.
    n = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(n, *keys, "_b").select(*keys, F.explode(hours).alias("h"))


def hourly_spine(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """One row per hour between the first and last row of each key."""
    return hours_between(bounds(df, keys, ts), keys).select(*keys, hour_start("h").alias(ts))


def fill_gaps(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Left join onto the spine: a missing hour becomes a row of nulls."""
    return hourly_spine(df, keys, ts).join(df, [*keys, ts], "left")


def missing_hours(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Expected hours minus present hours."""
    return hourly_spine(df, keys, ts).join(df.select(*keys, ts), [*keys, ts], "left_anti")


def duplicate_counts(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Per key, rows beyond the first of each hour."""
    return (
        df.groupBy(*keys, ts)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*keys)
        .agg(F.sum(F.col("n") - 1).alias("duplicates"))
    )


def continuity(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS, size: int = BLOCK_HOURS) -> DataFrame:
    """Breaks of the hourly axis in one pass: ``kind`` is ``gap`` or ``duplicate``.

    A gap row is a whole run of missing hours, a duplicate row one surplus row. Rows are
    compared with their predecessor inside a time block; only the first row of a block
    looks at the end of the block before it. No spine is built and nothing is joined to it.
    """
    keys = list(keys)
    rows = df.select(*keys, hour_number(ts).alias("_h")).withColumn("_b", block_of("_h", size))
    ends = rows.groupBy(*keys, "_b").agg(F.min("_h").alias("_h"), F.max("_h").alias("_end"))
    between = ends.select(
        *keys, "_h", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_b")).alias("_prev")
    )
    inside = rows.select(
        *keys, "_h", F.lag("_h").over(Window.partitionBy(*keys, "_b").orderBy("_h")).alias("_prev")
    )
    step = F.col("_h") - F.col("_prev")
    return (
        inside.unionByName(between)
        .filter((step == 0) | (step > 1))
        .select(
            *keys,
            F.when(step == 0, "duplicate").otherwise("gap").alias("kind"),
            hour_start(F.when(step == 0, F.col("_h")).otherwise(F.col("_prev") + 1)).alias("first_ts"),
            hour_start(F.when(step == 0, F.col("_h")).otherwise(F.col("_h") - 1)).alias("last_ts"),
            F.when(step == 0, 1).otherwise(step - 1).cast("long").alias("hours"),
        )
    )
