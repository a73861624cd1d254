"""The last row per key, decided by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row that comes last by ``order``.

    ``row_number() = 1`` is planned with a group limit below the shuffle: each task sends
    at most one row per key.
    """
    newest = [F.col(o).desc() if isinstance(o, str) else o.desc() for o in order]
    w = Window.partitionBy(*key).orderBy(*newest)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_n_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows per key, numbered; group limit below the shuffle as above."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def last_block_wins(
    blocks: DataFrame, value: str, origin: str, key: Sequence[str]
) -> DataFrame:
    """Overlapping forecast blocks: the value of the latest origin."""
    return blocks.groupBy(*key).agg(
        F.max_by(value, origin).alias(value), F.max(origin).alias(origin)
    )
