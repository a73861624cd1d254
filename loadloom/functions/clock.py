"""Hour arithmetic, the local wall clock and lead times, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import DEFAULT_TZ

DEFAULT_PUBLICATION_HOUR = 10


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_number(ts) -> Column:
    """Whole hours since the epoch, the integer axis every time frame is expressed on."""
    return F.floor(F.unix_seconds(col(ts)) / 3600)


def hour_start(h) -> Column:
    return F.timestamp_seconds(col(h) * 3600)


def plus_hours(ts, hours) -> Column:
    shift = hours if isinstance(hours, Column) else F.lit(int(hours))
    return F.timestamp_seconds(F.unix_seconds(col(ts)) + shift * 3600)


def as_instant(df: DataFrame, ts: str, zone: str | None = None) -> DataFrame:
    """Make ``ts`` an instant. A zoneless column is refused unless its zone is named."""
    kind = df.schema[ts].dataType
    if isinstance(kind, T.TimestampType):
        return df
    if not isinstance(kind, T.TimestampNTZType):
        raise TypeError(f"{ts} must be a timestamp, found {kind.simpleString()}")
    if zone is None:
        raise ValueError(f"{ts} has no time zone; name the zone it was recorded in")
    wall = F.col(ts).cast("timestamp")
    return df.withColumn(ts, wall if zone == "UTC" else F.to_utc_timestamp(wall, zone))


def local_time(ts, tz: str = DEFAULT_TZ) -> Column:
    return F.from_utc_timestamp(col(ts), tz)


def local_midnight(ts, tz: str = DEFAULT_TZ) -> Column:
    """The UTC instant at which the local day of ``ts`` began."""
    return F.to_utc_timestamp(F.date_trunc("day", local_time(ts, tz)), tz)


def calendar_columns(ts, tz: str = DEFAULT_TZ) -> dict[str, Column]:
    """Local hour, day of week (Monday is 0), month, weekend and their cyclic encodings."""
    local = local_time(ts, tz)
    hour, dow = F.hour(local), F.weekday(local)
    turn = 2 * F.pi()
    return {
        "hour": hour,
        "dow": dow,
        "month": F.month(local),
        "is_weekend": (dow >= 5).cast("int"),
        "hour_sin": F.sin(turn * hour / 24),
        "hour_cos": F.cos(turn * hour / 24),
        "dow_sin": F.sin(turn * dow / 7),
        "dow_cos": F.cos(turn * dow / 7),
    }


def lead_hours(
    ts, tz: str = DEFAULT_TZ, publication_hour: int = DEFAULT_PUBLICATION_HOUR
) -> Column:
    """Hours from the publication hour on the local day before to ``ts``.

    Counted between instants, so the 23- and 25-hour days come out right.
    """
    elapsed = F.unix_seconds(col(ts)) - F.unix_seconds(local_midnight(ts, tz))
    return (F.floor(elapsed / 3600) + F.lit(24 - publication_hour)).cast("int")


def floor_to(unit: str, ts) -> Column:
    return F.date_trunc(unit, col(ts))


def ceil_to(unit: str, ts) -> Column:
    """Round up to a whole hour or day; a value already on the boundary stays."""
    seconds = {"hour": 3600, "day": 86400}[unit]
    floor = F.date_trunc(unit, col(ts))
    return F.when(floor == col(ts), floor).otherwise(
        F.timestamp_seconds(F.unix_seconds(floor) + seconds)
    )


def years_back(ts, years: int) -> Column:
    """Calendar-year shift; 29 February lands on 28 February."""
    return col(ts) - F.make_ym_interval(F.lit(int(years)))


def iso_text(ts) -> Column:
    """ISO-8601 UTC text, for the edges of the system only."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
