"""The public-holiday calendar."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import DEFAULT_TZ
from .clock import local_time

# The Polish public holidays (month, day, first year or None).
FIXED_DATE_HOLIDAYS = (
    (1, 1, None),
    (1, 6, 2011),
    (5, 1, None),
    (5, 3, 1990),
    (8, 15, 1990),
    (11, 1, None),
    (11, 11, 1990),
    (12, 24, 2025),
    (12, 25, None),
    (12, 26, None),
)
# Days after Easter Sunday (Sunday, Monday, Pentecost, Corpus Christi).
EASTER_OFFSETS = (0, 1, 49, 60)


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter of any year, by integer arithmetic: golden year, epact, then days to
    the Sunday."""
    golden, c, yy = year % 19, F.floor(year / 100), year % 100
    epact = (19 * golden + c - F.floor(c / 4) - F.floor((c - F.floor((c + 8) / 25) + 1) / 3) + 15) % 30
    shift = (32 + 2 * (c % 4) + 2 * F.floor(yy / 4) - epact - yy % 4) % 7
    code = epact + shift - 7 * F.floor((golden + 11 * epact + 22 * shift) / 451) + 114
    return F.make_date(year.cast("int"), F.floor(code / 31).cast("int"), (code % 31 + 1).cast("int"))


def is_public_holiday(day: Column) -> Column:
    """Whether a date is a public holiday, from its own year alone: no range, no join."""
    month, dom, year = F.month(day), F.dayofmonth(day), F.year(day)
    fixed = [
        (month == m) & (dom == d) & (F.lit(True) if since is None else year >= since) for m, d, since in FIXED_DATE_HOLIDAYS
    ]
    movable = F.datediff(day, easter_sunday(year)).isin(*EASTER_OFFSETS)
    return reduce(lambda a, b: a | b, fixed, movable)


def holiday_dimension(spark: SparkSession, first: int, last: int) -> DataFrame:
    """One row per public holiday of the given years: at most 14 rows a year."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.make_date(F.lit(first), F.lit(1), F.lit(1)), F.make_date(F.lit(last), F.lit(12), F.lit(31)))).alias("holiday_date")
    )
    return days.where(is_public_holiday(F.col("holiday_date")))


def with_holiday_flag(
    df: DataFrame, ts: str = "ts", tz: str = DEFAULT_TZ, name: str = "is_holiday",
    dimension: DataFrame | None = None,
) -> DataFrame:
    """Flag by the *local* date; null times have a false flag.

    The public calendar is an expression. A calendar of one's own (``dimension`` with
    ``holiday_date``) is joined.
    """
    day = F.to_date(local_time(ts, tz))
    if dimension is None:
        return df.withColumn(name, F.coalesce(is_public_holiday(day), F.lit(False)))
    marked = dimension.select(F.col("holiday_date").alias("_holiday")).distinct()
    joined = df.drop(name).join(marked, day == F.col("_holiday"), "left")
    return joined.withColumn(name, F.col("_holiday").isNotNull()).drop("_holiday")


def is_christmas_week(local: Column) -> Column:
    """24 to 31 December and 1 January on the local calendar."""
    month, day = F.month(local), F.dayofmonth(local)
    return ((month == 12) & (day >= 24)) | ((month == 1) & (day == 1))
