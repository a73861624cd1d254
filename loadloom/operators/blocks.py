"""Time blocks: how one long series is spread over many tasks.

A window partitioned by ``series_id`` alone puts a whole series on one task. Every
ordered computation here is partitioned by ``(keys, time block)`` instead. Frames with a
known look-back copy the few rows a block needs from its predecessor (a halo); running
counts carry one total per block. Both are exact, and no task ever holds more than one
block (plus halo) of one series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .. import KEYS
from ..functions.clock import col

BLOCK_HOURS = 4096


def block_of(h, size: int) -> Column:
    """Floor division that also holds before 1970."""
    return ((col(h) - F.pmod(col(h), F.lit(size))) / size).cast("long")


def with_halo(df: DataFrame, h: str, lookback: int, size: int | None = None) -> DataFrame:
    """Copy each row into its own block and any later block whose look-back reaches it.

    Adds ``_block`` and ``_own`` (true in the row's own block). With the default size a
    copy is made for about ``lookback / size`` of the rows.
    """
    size = size or max(BLOCK_HOURS, 8 * lookback)
    own = block_of(h, size)
    last = block_of(F.col(h) + lookback, size)
    return df.withColumn("_block", F.explode(F.sequence(own, last))).withColumn(
        "_own", F.col("_block") == own
    )


def halo_window(h: str, keys: Sequence[str] = KEYS) -> WindowSpec:
    return Window.partitionBy(*keys, "_block").orderBy(h)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter("_own").drop("_block", "_own")


def with_position(
    df: DataFrame, h: str, keys: Sequence[str] = KEYS, size: int = BLOCK_HOURS
) -> DataFrame:
    """Exact 0-based row position per key in order of ``h``, without a per-key window.

    Rows are numbered inside their block; the offset of a block is the running total of
    the (few) block counts before it. ``h`` must be unique per key.
    """
    keys = list(keys)
    blocked = df.withColumn("_block", block_of(h, size))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        blocked.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(h)
    return (
        blocked.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, [*keys, "_block"])
        .withColumn("position", F.col("_offset") + F.col("_rn") - 1)
        .drop("_block", "_rn", "_offset")
    )
