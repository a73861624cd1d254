"""Which past hours the current window is compared against."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import KEYS, TS
from ..functions.clock import years_back
from .align import with_scalars

SEASONAL, TRAILING = "seasonal", "trailing"
# Default monitoring settings.
CURRENT_DAYS, YEARS_BACK, PAD_DAYS, MIN_ROWS = 14, 3, 7, 500


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def current_windows(df: DataFrame, current_days: int = CURRENT_DAYS, now=None, keys=KEYS, ts: str = TS) -> DataFrame:
    """Per key, the window being judged: the last days up to ``now`` (default: newest row)."""
    end = F.max(ts) if now is None else F.lit(now).cast("timestamp")
    return df.groupBy(*keys).agg((end - days(current_days)).alias("current_start"), end.alias("current_end"))


def in_trailing(ts: str, current_days: int) -> Column:
    return (F.col(ts) >= F.col("current_start") - days(current_days)) & (
        F.col(ts) < F.col("current_start")
    )


def in_year(ts: str, year: int, pad_days: int) -> Column:
    return F.col(ts).between(
        years_back("current_start", year) - days(pad_days),
        years_back("current_end", year) + days(pad_days),
    )


def in_seasonal(ts: str, years: int, pad_days: int) -> Column:
    """One disjunction over the years: overlapping windows cannot duplicate a row."""
    return reduce(lambda a, b: a | b, [in_year(ts, y, pad_days) for y in range(1, years + 1)])


def trailing_reference(df, windows, current_days: int = CURRENT_DAYS, keys=KEYS, ts: str = TS) -> DataFrame:
    return with_scalars(df, windows, keys).filter(in_trailing(ts, current_days)).select(df.columns)


def seasonal_reference(
    df, windows, years: int = YEARS_BACK, pad_days: int = PAD_DAYS, keys=KEYS, ts: str = TS
) -> DataFrame:
    return with_scalars(df, windows, keys).filter(in_seasonal(ts, years, pad_days)).select(df.columns)


def tag_windows(
    df: DataFrame, windows: DataFrame, years: int = YEARS_BACK, pad_days: int = PAD_DAYS,
    current_days: int = CURRENT_DAYS, keys=KEYS, ts: str = TS,
) -> DataFrame:
    """Rows of any window, flagged current / seasonal / trailing, in one pass."""
    tagged = with_scalars(df, windows, keys).withColumns(
        {
            "in_current": F.col(ts).between(F.col("current_start"), F.col("current_end")),
            "in_seasonal": in_seasonal(ts, years, pad_days),
            "in_trailing": in_trailing(ts, current_days),
        }
    )
    return tagged.filter("in_current OR in_seasonal OR in_trailing")


def within_reach(
    df: DataFrame, windows: DataFrame, reach_hours: int, strategy: str = SEASONAL, years: int = YEARS_BACK,
    pad_days: int = PAD_DAYS, current_days: int = CURRENT_DAYS, keys: Sequence[str] = KEYS, ts: str = TS,
) -> DataFrame:
    """Rows of the windows and of the ``reach_hours`` before them. Runs a job.

    The earliest bound over all keys is also given as a literal, which a scan can use.
    """
    back = F.make_dt_interval(hours=F.lit(reach_hours))
    spans = [(F.col("current_start") - days(current_days), F.col("current_end"))]
    if strategy == SEASONAL:
        spans += [
            (years_back("current_start", y) - days(pad_days), years_back("current_end", y) + days(pad_days))
            for y in range(1, years + 1)
        ]
    low = windows.agg(F.min(reduce(F.least, [a - back for a, _ in spans]))).first()[0]
    inside = reduce(lambda a, b: a | b, [F.col(ts).between(a - back, b) for a, b in spans])
    bounded = df if low is None else df.filter(F.col(ts) >= F.lit(low))
    return with_scalars(bounded, windows, keys).filter(inside).select(df.columns)


def choose_reference(
    tagged: DataFrame, strategy: str = SEASONAL, years: int = YEARS_BACK, pad_days: int = PAD_DAYS,
    min_rows: int = MIN_ROWS, fallback_to_trailing: bool = False,
    current_days: int = CURRENT_DAYS, keys: Sequence[str] = KEYS, ts: str = TS,
) -> DataFrame:
    """Per key: the strategy used, the rows of both and a text on the one used.

    The asked strategy is used whatever its size. Only ``fallback_to_trailing`` lets a
    seasonal reference below ``min_rows`` give way to the trailing one.
    """
    per_year = [F.count_if(in_year(ts, y, pad_days)).alias(f"_y{y}") for y in range(1, years + 1)]
    counts = tagged.groupBy(*keys).agg(
        F.min("current_start").alias("current_start"),
        F.min("current_end").alias("current_end"),
        F.count_if("in_current").alias("current_rows"),
        F.count_if("in_seasonal").alias("_s"),
        F.count_if("in_trailing").alias("_t"),
        *per_year,
    )
    seasonal = (
        (F.col("_s") >= min_rows) | F.lit(not fallback_to_trailing)
        if strategy == SEASONAL
        else F.lit(False)
    )
    covered = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"_y{y}") > 0,
                    F.concat_ws(
                        "..",
                        F.date_format(years_back("current_start", y) - days(pad_days), "yyyy-MM-dd"),
                        F.date_format(years_back("current_end", y) + days(pad_days), "yyyy-MM-dd"),
                    ),
                )
                for y in range(1, years + 1)
            ]
        )
    )
    listed = F.when(F.size(covered) > 0, F.array_join(covered, ", ")).otherwise("none available")
    return counts.select(
        *keys, "current_start", "current_end", "current_rows",
        F.when(seasonal, SEASONAL).otherwise(TRAILING).alias("reference_strategy"),
        F.when(seasonal, F.col("_s")).otherwise(F.col("_t")).alias("reference_rows"),
        F.col("_s").alias("seasonal_rows"), F.col("_t").alias("trailing_rows"),
        F.when(
            seasonal,
            F.concat(F.lit("same weeks in "), F.size(covered), F.lit(" previous year(s): "), listed),
        )
        .otherwise(
            F.concat(
                F.lit(f"{current_days} days immediately before "),
                F.date_format("current_start", "yyyy-MM-dd"),
            )
        )
        .alias("reference_detail"),
    )
