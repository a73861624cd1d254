"""Joins on the time index: align, overlay, replace, pair."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import KEYS, TS
from ..functions.clock import hour_number
from ..session import through_table
from .blocks import block_of


#: A side of at most so many bytes, measured first, is broadcast.
BROADCAST_BYTES = 32 << 20


def with_scalars(df: DataFrame, scalars: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a few values per key onto a table. Runs a job: the values are stored and measured.

    Up to ``BROADCAST_BYTES`` they are broadcast, so the table is not shuffled and one hot key
    is not one task. Beyond that the join shuffles, and its skewed keys are split. Arrays count
    with all they hold: the size is that of the rows written out as text.
    """
    scalars = through_table(scalars, "scalars")
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in scalars.columns])))
    few = (scalars.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES
    return df.join(F.broadcast(scalars) if few else scalars, list(keys), how)


def outer_align(left: DataFrame, right: DataFrame, keys=KEYS, ts: str = TS) -> DataFrame:
    """Full outer join: an hour known to either side is kept."""
    return left.join(right, [*keys, ts], "full")


def overlay_cells(first: DataFrame, second: DataFrame, keys=KEYS, ts: str = TS) -> DataFrame:
    """Cell-wise priority: the first frame's value, else the second's, over all rows."""
    on = [*keys, ts]
    names = [c for c in first.columns if c not in on]
    names += [c for c in second.columns if c not in on and c not in names]
    a, b = first.alias("a"), second.alias("b")

    def pick(name):
        sides = [F.col(f"{s}.{name}") for s, d in (("a", first), ("b", second)) if name in d.columns]
        return F.coalesce(*sides).alias(name)

    return a.join(b, on, "full").select(*on, *[pick(n) for n in names])


def replace_rows(existing: DataFrame, incoming: DataFrame, keys=KEYS, ts: str = TS) -> DataFrame:
    """Row-wise replacement: an incoming row wins whole, its nulls included.

    One full join with a presence marker: each side is shuffled once and nothing is
    unioned or anti-joined.
    """
    on = [*keys, ts]
    old = existing.alias("old")
    new = incoming.withColumn("_incoming", F.lit(True)).alias("new")

    def pick(name):
        kept = F.col(f"old.{name}")
        fresh = F.col(f"new.{name}") if name in incoming.columns else F.lit(None)
        return F.when(F.col("_incoming"), fresh).otherwise(kept).alias(name)

    names = [c for c in existing.columns if c not in on]
    return old.join(new, on, "full").select(*on, *[pick(n) for n in names])


def pair_complete(truth: DataFrame, predicted: DataFrame, keys=KEYS, ts: str = TS) -> DataFrame:
    """Pairs with both values present. Filters sit below the join so nulls never shuffle."""
    return truth.filter(F.col("y_true").isNotNull()).join(
        predicted.filter(F.col("y_pred").isNotNull()), [*keys, ts]
    )


def on_common_rows(base: DataFrame, references: Sequence[DataFrame], keys=KEYS, ts: str = TS) -> DataFrame:
    """Left join each reference onto the scored rows, then keep hours every column has."""
    joined = reduce(lambda d, r: d.join(r, [*keys, ts], "left"), references, base)
    return joined.dropna("any")


def matched_rows(long: DataFrame, group: str, expected: int, keys=KEYS, ts: str = TS) -> DataFrame:
    """Keep the hours present in all ``expected`` groups, in one aggregation and a semi join.

    ``collect_set`` is bounded by the number of groups (audit variants), not by rows.
    """
    common = (
        long.groupBy(*keys, ts)
        .agg(F.size(F.collect_set(group)).alias("_n"))
        .filter(F.col("_n") == expected)
        .drop("_n")
    )
    return long.join(common, [*keys, ts], "left_semi")


def interval_join(
    df: DataFrame, intervals: DataFrame, start: str, end: str,
    keys: Sequence[str] = KEYS, ts: str = TS, block_hours: int = 168, how: str = "inner",
) -> DataFrame:
    """Rows with the closed intervals of their key that contain them.

    Intervals are cut into blocks and joined on ``(keys, block)``: an equi-join whose
    keys spread one hot series over many tasks, with the exact bounds as a filter. A row
    meets an interval in exactly one block, so nothing is duplicated.
    """
    cut = intervals.withColumn(
        "_b",
        F.explode(
            F.sequence(
                block_of(hour_number(start), block_hours), block_of(hour_number(end), block_hours)
            )
        ),
    )
    rows = df.withColumn("_b", block_of(hour_number(ts), block_hours))
    a, b = rows.alias("a"), cut.alias("b")
    condition = reduce(
        lambda x, y: x & y,
        [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_b"]],
    ) & F.col(f"a.{ts}").between(F.col(f"b.{start}"), F.col(f"b.{end}"))
    if how in ("left_semi", "left_anti"):
        return a.join(b, condition, how).drop("_b")
    extra = [c for c in intervals.columns if c not in keys]
    return a.join(b, condition, how).select("a.*", *[f"b.{c}" for c in extra]).drop("_b")
