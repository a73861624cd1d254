"""Feature names: families are recognised by name, so selection needs no second builder."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clock import col

# The feature naming scheme.
TARGET = "target"
LAG_PATTERN = r"^load_lag_(\d+)$"
ROLLING_PATTERN = r"^load_roll_(mean|std)_(\d+)$"
WEATHER_FEATURES = ("temp_c", "temp_sq", "wind_ms", "cloud_cover")


def _from_load(name: str) -> bool:
    return bool(re.match(LAG_PATTERN, name) or re.match(ROLLING_PATTERN, name))


def feature_columns(names, include_weather: bool = True, include_lags: bool = True) -> list[str]:
    """Features in their given order, never the target, optionally without a family."""
    return [
        n
        for n in names
        if n != TARGET
        and (include_lags or not _from_load(n))
        and (include_weather or n not in WEATHER_FEATURES)
    ]


def target_derived_columns(names) -> list[str]:
    return [n for n in names if _from_load(n) or n == TARGET]


def monitored_columns(names) -> list[str]:
    """Inputs that can drift: load history and weather, never the calendar."""
    return [n for n in names if _from_load(n) or n in WEATHER_FEATURES]


def feature_set_id(names) -> str:
    joined = "|".join(sorted(n for n in names if n != TARGET))
    return hashlib.sha256(joined.encode()).hexdigest()[:10]


def feature_set_id_of(names_array) -> Column:
    """The same id for an array column, one per row."""
    kept = F.filter(col(names_array), lambda n: n != F.lit(TARGET))
    return F.substring(F.sha2(F.array_join(F.array_sort(kept), "|"), 256), 1, 10)


def family(name) -> Column:
    """Family of a feature name held in a column: lag, rolling, weather, target, calendar."""
    n = col(name)
    return (
        F.when(n == TARGET, "target")
        .when(n.rlike(LAG_PATTERN), "lag")
        .when(n.rlike(ROLLING_PATTERN), "rolling")
        .when(n.isin(*WEATHER_FEATURES), "weather")
        .otherwise("calendar")
    )


def lag_of(name) -> Column:
    """The lag in hours named by a lag column, null for every other column."""
    return F.nullif(F.regexp_extract(col(name), LAG_PATTERN, 1), F.lit("")).cast("int")
