"""As-of joins: what was known at a given time.

Two forms. ``as_known_at`` chooses among the vintages of one hour, which is an aggregation.
``asof_join`` finds the last row before a time, whatever its own time: both sides are put on
one time axis in blocks, the last value is carried along inside each block, and what an empty
start of a block needs comes from one row per block. No range join, no window over a series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import DEFAULT_TZ, KEYS, TS
from ..functions.clock import DEFAULT_PUBLICATION_HOUR, local_midnight, plus_hours
from ..session import require_columns
from .blocks import BLOCK_HOURS, block_of


def publication_time(ts: str | Column = TS, tz: str = DEFAULT_TZ, publication_hour: int = DEFAULT_PUBLICATION_HOUR) -> Column:
    """The instant from which ``lead_hours`` counts: the publication hour of the local day before."""
    return plus_hours(local_midnight(ts, tz), publication_hour - 24)


def issued_before(ts: str, lead_days: str) -> Column:
    """When a vintage of so many days ahead was issued: that long before its hour."""
    return plus_hours(ts, -24 * F.col(lead_days).cast("long"))


def as_known_at(
    vintages: DataFrame, columns: Sequence[str], known_at: Column | None = None, issued: str = "issued_at", seq: str | None = None,
    keys: Sequence[str] = KEYS, ts: str = TS,
) -> DataFrame:
    """(keys, ts, columns, issued): for each hour the newest vintage issued at or before ``known_at``.

    ``known_at`` is an expression of the vintage's row, by default the publication time of its
    hour. Of vintages issued at the same time the one with the greatest ``seq`` counts; without
    it, the one with the greatest values. Vintages without an issue time were never known; an
    hour whose vintages all came later has no row.
    """
    keys, columns = list(keys), list(columns)
    require_columns(vintages, [*keys, ts, issued, *columns, *([seq] if seq else [])], "vintages")
    limit = publication_time(ts) if known_at is None else known_at
    known = vintages.filter(F.col(issued) <= limit)
    order = F.struct(issued, *([seq] if seq else columns))
    return known.groupBy(*keys, ts).agg(F.max_by(F.struct(*columns, issued), order).alias("_v")).select(*keys, ts, "_v.*")


def asof_join(
    left: DataFrame, right: DataFrame, columns: Sequence[str], left_time: str, right_time: str = TS, seq: str | None = None,
    keys: Sequence[str] = KEYS, matched: str = "matched_at", size: int = BLOCK_HOURS,
) -> DataFrame:
    """``left`` with ``columns`` of the last right row of its key at or before its time, and that row's time.

    Equal times count as before; of right rows at one time the one with the greatest ``seq``
    counts, without it the one with the greatest values. Left rows without an earlier right
    row, or with a null time, have nulls. Right rows without a time are never met.
    """
    keys, columns = list(keys), list(columns)
    require_columns(right, [*keys, right_time, *columns], "right side")
    taken = [c for c in [*columns, matched] if c in left.columns]
    if taken:
        raise ValueError(f"columns are in both sides: {taken}")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    found = F.struct(*[F.col(c).alias(c) for c in columns], F.col(right_time).alias(matched))
    order = F.struct(*([F.col(seq)] if seq else [F.col(c) for c in columns]))
    r = right.filter(F.col(right_time).isNotNull()).select(*keys, micros(right_time).alias("_t"), order.alias("_o"), found.alias("_r"))
    r = r.withColumn("_b", block_of("_t", size * 3_600_000_000))
    # One row per time: the window then has nothing to decide.
    r = r.groupBy(*keys, "_b", "_t").agg(F.max_by("_r", "_o").alias("_r"))
    l = left.select(*keys, micros(left_time).alias("_t"), F.struct(*[F.col(c) for c in left.columns]).alias("_l"))
    l = l.withColumn("_b", block_of("_t", size * 3_600_000_000))
    both = r.select(*keys, "_b", "_t", F.lit(0).alias("_side"), "_r").unionByName(
        l.select(*keys, "_b", "_t", F.lit(1).alias("_side"), "_l"), allowMissingColumns=True
    )
    inside = Window.partitionBy(*keys, "_b").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("_in", F.last("_r", ignorenulls=True).over(inside)).filter("_side = 1")
    # What each block starts with: the last right row of the blocks before it.
    ends = r.groupBy(*keys, "_b").agg(F.max_by("_r", "_t").alias("_end"))
    blocks = ends.unionByName(l.select(*keys, "_b").distinct(), allowMissingColumns=True).groupBy(*keys, "_b").agg(F.first("_end", ignorenulls=True).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*keys, "_b", F.last("_end", ignorenulls=True).over(before).alias("_carried")).filter("_carried IS NOT NULL")
    joined = met.join(carried, [*keys, "_b"], "left").withColumn("_m", F.when(F.col("_t").isNotNull(), F.coalesce("_in", "_carried")))
    return joined.select("_l.*", *[F.col(f"_m.{c}").alias(c) for c in [*columns, matched]])
