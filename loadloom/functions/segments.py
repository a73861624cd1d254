"""Labels that cut target hours into the segments errors are reported by."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import DEFAULT_TZ
from .clock import local_time
from .holidays import is_christmas_week, with_holiday_flag

# Segment kinds, label texts and the local peak hours [start, end).
SEGMENT_KINDS = ("period", "daytype", "holiday", "season", "special")
DEFAULT_PEAK_HOURS = (7, 22)
PEAK, OFF_PEAK = "peak", "off-peak"
WEEKEND, WEEKDAY = "weekend", "weekday"
HOLIDAY, ORDINARY = "holiday", "ordinary day"
WINTER, SPRING, SUMMER, AUTUMN = "winter", "spring", "summer", "autumn"
CHRISTMAS, REST = "christmas–new year", "rest of year"


def with_segments(
    df: DataFrame, ts: str = "ts", tz: str = DEFAULT_TZ, peak_hours=DEFAULT_PEAK_HOURS
) -> DataFrame:
    """Add the five label columns, all on the local clock and calendar."""
    start, end = peak_hours
    local = local_time(ts, tz)
    hour, quarter = F.hour(local), F.floor((F.month(local) % 12) / 3)
    return with_holiday_flag(df, ts, tz, name="_is_holiday").withColumns(
        {
            "period": F.when((hour >= start) & (hour < end), PEAK).otherwise(OFF_PEAK),
            "daytype": F.when(F.weekday(local) >= 5, WEEKEND).otherwise(WEEKDAY),
            "holiday": F.when(F.col("_is_holiday"), HOLIDAY).otherwise(ORDINARY),
            "season": F.when(quarter == 0, WINTER)
            .when(quarter == 1, SPRING)
            .when(quarter == 2, SUMMER)
            .otherwise(AUTUMN),
            "special": F.when(is_christmas_week(local), CHRISTMAS).otherwise(REST),
        }
    ).drop("_is_holiday")
