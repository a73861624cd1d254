"""Chronological splits with an embargo of one horizon, as interval tables.

A label for hour T is known at T and a forecast for T is made at T - H, so training must
end H hours before the block it is tested on. Intervals are closed on both ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import KEYS, TS
from ..functions.clock import col, hour_number, hour_start
from ..session import require_positive
from .align import interval_join, with_scalars


def minimum_training_hours(validation_days: int, horizon: int, weekly_lag: int) -> int:
    """History below which a split cannot have both blocks: lags, block, embargo."""
    return weekly_lag + validation_days * 24 + 2 * horizon


def chronological_bounds(
    df: DataFrame, validation_days: int, horizon: int, keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Per key: last training hour and first validation hour (the last N days)."""
    h_last = F.max(hour_number(ts))
    v0 = h_last - validation_days * 24 + 1
    return df.groupBy(*keys).agg(
        hour_start(v0 - horizon).alias("train_end"),
        hour_start(v0).alias("validation_start"),
    )


def chronological_split(
    df: DataFrame, validation_days: int, horizon: int, keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Label each row ``train``, ``validation`` or ``embargo`` in column ``block``. Runs a job.

    ``df`` is read twice (its ends, then its rows): pass a stored frame.
    """
    bounds = chronological_bounds(df, validation_days, horizon, keys, ts)
    return (
        with_scalars(df, bounds, keys)
        .withColumn(
            "block",
            F.when(F.col(ts) <= F.col("train_end"), "train")
            .when(F.col(ts) >= F.col("validation_start"), "validation")
            .otherwise("embargo"),
        )
        .drop("train_end", "validation_start")
    )


def split_shortfalls(labelled: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys whose split lacks a training or a validation row (an error in strict mode)."""
    counts = labelled.groupBy(*keys).agg(
        F.count_if(F.col("block") == "train").alias("train_rows"),
        F.count_if(F.col("block") == "validation").alias("validation_rows"),
    )
    return counts.filter("train_rows = 0 OR validation_rows = 0")


def rolling_origins(
    df: DataFrame, horizon: int, initial_train_days: int, test_days: int, step_days: int,
    max_splits: int | None = None, first_test_start=None,
    keys: Sequence[str] = KEYS, ts: str = TS,
) -> DataFrame:
    """Expanding-window splits per key, computed from the first and last hour alone.

    ``first_test_start`` (a timestamp literal or a column of ``df`` constant per key)
    moves the first origin without shortening training. A block without any row of the
    key ends the schedule, as it would when walking forward.
    """
    require_positive(initial_train_days=initial_train_days, test_days=test_days, step_days=step_days)
    h = hour_number(ts)
    aggs = [F.min(h).alias("h0"), F.max(h).alias("h1")]
    if first_test_start is not None:
        anchor = col(first_test_start) if isinstance(first_test_start, str) else F.lit(first_test_start)
        aggs.append(F.max(hour_number(anchor.cast("timestamp"))).alias("anchor"))
    spans = df.groupBy(*keys).agg(*aggs)
    natural = F.col("h0") + initial_train_days * 24 - 1
    train_end = natural
    if first_test_start is not None:
        train_end = F.when(F.col("anchor") - horizon >= natural, F.col("anchor") - horizon).otherwise(
            F.raise_error(F.lit("first_test_start leaves too few training days")).cast("long")
        )
    step = step_days * 24
    spans = spans.withColumn("_e0", train_end).filter(F.col("_e0") + horizon <= F.col("h1"))
    last_no = F.floor((F.col("h1") - F.col("_e0") - horizon) / step)
    if max_splits is not None:
        last_no = F.least(last_no, F.lit(max_splits - 1))
    test0 = F.col("_e0") + F.col("k") * step + horizon
    table = spans.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last_no))).select(
        *keys,
        (F.col("k") + 1).alias("origin_no"),
        hour_start("h0").alias("train_start"),
        hour_start(test0 - horizon).alias("train_end"),
        hour_start(test0).alias("test_start"),
        hour_start(F.least(test0 + test_days * 24 - 1, F.col("h1"))).alias("test_end"),
        F.lit(horizon).alias("horizon"),
    )
    return _until_first_empty(table, df, keys, ts)


def _until_first_empty(table: DataFrame, df: DataFrame, keys, ts) -> DataFrame:
    """Drop the first split without a test row and all later ones."""
    seen = (
        interval_join(df.select(*keys, ts), table.select(*keys, "origin_no", "test_start", "test_end"), "test_start", "test_end", keys, ts)
        .select(*keys, "origin_no")
        .distinct()
        .withColumn("_seen", F.lit(True))
    )
    marked = table.join(seen, [*keys, "origin_no"], "left")
    empty = marked.filter("_seen IS NULL").groupBy(*keys).agg(F.min("origin_no").alias("_cut"))
    return (
        marked.join(empty, list(keys), "left")
        .filter("_cut IS NULL OR origin_no < _cut")
        .drop("_seen", "_cut")
    )


def end_anchored_start(
    df: DataFrame, step_days: int, max_splits: int, value: str = "load_mw",
    keys: Sequence[str] = KEYS, ts: str = TS,
) -> DataFrame:
    """First test day for which the origins end at the newest actual of each key."""
    last = F.max(F.when(F.col(value).isNotNull(), F.unix_seconds(ts)))
    back = F.timestamp_seconds(last - step_days * max_splits * 86400)
    return df.groupBy(*keys).agg(F.date_trunc("day", back).alias("first_test_start"))


def test_rows(df: DataFrame, splits: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Rows tagged with every origin whose test block contains them."""
    return interval_join(df, splits, "test_start", "test_end", keys, ts)


def train_rows(df: DataFrame, split: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Rows of the training block of one origin per key."""
    return with_scalars(df, split.select(*keys, "train_start", "train_end"), keys).filter(
        F.col(ts).between(F.col("train_start"), F.col("train_end"))
    ).drop("train_start", "train_end")
