"""The feature build: one implementation for training and for serving.

A row is indexed by its target hour T and made at T - H. Nothing derived from load is
younger than load[T - H]; weather and calendar are those of T.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import DEFAULT_TZ, KEYS, TS
from ..functions.clock import calendar_columns, hour_number, lead_hours, plus_hours
from ..functions.holidays import with_holiday_flag
from ..functions.names import TARGET
from ..operators.align import overlay_cells, with_scalars
from ..operators.history import (
    DEFAULT_ROLLING_WINDOW,
    DEFAULT_WEEKLY_LAG,
    lag_hours,
    look_back_hours,
    with_history,
)
from ..operators.spine import hours_between
from ..session import require_columns, require_rows, through_table
from ..sources.canonical import FORECAST, LOAD, WEATHER
from .dataset import build_dataset, high_water

REQUIRED = (LOAD, "temp_c", "wind_ms", "cloud_cover")
CALENDAR = (
    "hour", "dow", "month", "is_weekend", "is_holiday", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
)
WEATHER_OUT = ("temp_c", "temp_sq", "wind_ms", "cloud_cover")


def feature_names(horizon: int, rolling_window: int = DEFAULT_ROLLING_WINDOW, weekly_lag: int = DEFAULT_WEEKLY_LAG) -> list[str]:
    return [
        *CALENDAR,
        *[f"load_lag_{n}" for n in lag_hours(horizon, weekly_lag)],
        f"load_roll_mean_{rolling_window}",
        f"load_roll_std_{rolling_window}",
        *WEATHER_OUT,
    ]


def _with_calendar(df: DataFrame, tz: str, ts: str) -> DataFrame:
    flagged = with_holiday_flag(df, ts, tz)
    return flagged.withColumns(
        {**calendar_columns(ts, tz), "temp_sq": F.pow("temp_c", 2), "is_holiday": F.col("is_holiday").cast("int")}
    )


def make_features(
    df: DataFrame, horizon: int, rolling_window: int = DEFAULT_ROLLING_WINDOW,
    weekly_lag: int = DEFAULT_WEEKLY_LAG, include_target: bool = True, tz: str = DEFAULT_TZ,
    keys: Sequence[str] = KEYS, ts: str = TS, require: Sequence[str] | None = None,
) -> DataFrame:
    """Feature rows with every value present, as doubles.

    One shuffle and one sort serve all lags and rolling statistics. No spine is built: a
    gap row could never survive, since its own weather (and target) is missing. Rows with
    missing weather are dropped only after the window, as their load is still history.
    """
    require_columns(df, REQUIRED, "make_features input")
    lags = lag_hours(horizon, weekly_lag)
    history = with_history(
        df.select(*keys, ts, *REQUIRED), lags, [(horizon, rolling_window)], keys=keys, ts=ts
    ).withColumnRenamed(LOAD, TARGET)
    names = feature_names(horizon, rolling_window, weekly_lag)
    out = [*names, TARGET] if include_target else names
    inputs = [c for c in history.columns if c not in (*keys, ts, TARGET)]
    whole = history.dropna("any", subset=[*inputs, TARGET] if include_target else inputs)
    return _with_calendar(whole, tz, ts).select(*keys, ts, *[F.col(c).cast("double").alias(c) for c in out])


def lead_horizons(publication_hour: int = 10) -> list[int]:
    """The lead times that hours of a published day can have, with the longest local day."""
    return list(range(24 - publication_hour, 24 - publication_hour + 25))


def lead_history(
    df: DataFrame, rolling_window: int = DEFAULT_ROLLING_WINDOW, weekly_lag: int = DEFAULT_WEEKLY_LAG,
    publication_hour: int = 10, horizons: Sequence[int] | None = None, keys: Sequence[str] = KEYS, ts: str = TS,
) -> DataFrame:
    """One wide row per hour with the lags and rolling values of *all* lead-matched horizons.

    Horizons share most lags, so this is about a third of one row per horizon; it is the
    form to store. ``by_lead`` unfolds it while it is read.
    """
    horizons = list(horizons or lead_horizons(publication_hour))
    if max(horizons) > weekly_lag:
        raise ValueError("lead-matched features need horizons within the weekly lag")
    lags = sorted({lag for h in horizons for lag in lag_hours(h, weekly_lag)})
    rows = with_history(
        df.select(*keys, ts, *REQUIRED), lags, [(h, rolling_window) for h in horizons], keys=keys, ts=ts
    )
    return rows.dropna("any", subset=list(REQUIRED))


def by_lead(
    wide: DataFrame, rolling_window: int = DEFAULT_ROLLING_WINDOW, weekly_lag: int = DEFAULT_WEEKLY_LAG,
    tz: str = DEFAULT_TZ, publication_hour: int = 10, horizons: Sequence[int] | None = None, own_only: bool = False,
    keys: Sequence[str] = KEYS, ts: str = TS,
) -> DataFrame:
    """Rows per (hour, horizon) of a ``lead_history`` frame, with that horizon's values under
    common names (``lag_h, lag_h1, lag_h24, lag_week, lag_week_h, roll_mean, roll_std``).

    ``is_own_lead`` marks the horizon an hour is served at; ``own_only`` unfolds no other.
    """
    horizons = list(horizons or lead_horizons(publication_hour))
    tail = (lambda h: f"_h{h}") if len(set(horizons)) > 1 else (lambda h: "")
    per_horizon = [
        F.struct(
            F.lit(h).alias("horizon"),
            F.col(f"load_lag_{h}").alias("lag_h"),
            F.col(f"load_lag_{h + 1}").alias("lag_h1"),
            F.col(f"load_lag_{h + 24}").alias("lag_h24"),
            F.col(f"load_lag_{weekly_lag}").alias("lag_week"),
            F.col(f"load_lag_{weekly_lag + h}").alias("lag_week_h"),
            F.col(f"load_roll_mean_{rolling_window}{tail(h)}").alias("roll_mean"),
            F.col(f"load_roll_std_{rolling_window}{tail(h)}").alias("roll_std"),
        )
        for h in horizons
    ]
    timed = wide.withColumn("lead_h", lead_hours(ts, tz, publication_hour))
    wanted = F.array(*per_horizon)
    if own_only:
        wanted = F.array_compact(F.array(*[F.when(F.col("lead_h") == h, x) for h, x in zip(horizons, per_horizon)]))
    long = (
        timed.select(*keys, ts, *REQUIRED, "lead_h", F.explode(wanted).alias("_f"))
        .select(*keys, ts, *REQUIRED, "lead_h", "_f.*")
        .dropna("any", subset=["horizon", "lag_h", "lag_h1", "lag_h24", "lag_week", "lag_week_h", "roll_mean", "roll_std"])
        .withColumnRenamed(LOAD, TARGET)
    )
    return _with_calendar(long, tz, ts).withColumn("is_own_lead", F.col("lead_h") == F.col("horizon"))


def make_features_by_lead(
    df: DataFrame, rolling_window: int = DEFAULT_ROLLING_WINDOW, weekly_lag: int = DEFAULT_WEEKLY_LAG,
    tz: str = DEFAULT_TZ, publication_hour: int = 10, horizons: Sequence[int] | None = None,
    keys: Sequence[str] = KEYS, ts: str = TS,
) -> DataFrame:
    """Feature rows of *all* lead-matched horizons at once, long in ``horizon``.

    Every horizon needs the same frames shifted, so one sorted pass computes the union of
    their lags. This replaces one full feature build per horizon.
    """
    wide = lead_history(df, rolling_window, weekly_lag, publication_hour, horizons, keys, ts)
    return by_lead(wide, rolling_window, weekly_lag, tz, publication_hour, horizons, False, keys, ts)


LEAD_FEATURES = (
    *CALENDAR, "lag_h", "lag_h1", "lag_h24", "lag_week", "lag_week_h", "roll_mean", "roll_std", *WEATHER_OUT,
)


def inference_frame(
    history: DataFrame, weather_forecast: DataFrame, tz: str = DEFAULT_TZ, keys=KEYS, ts: str = TS,
    strict: bool = False,
) -> DataFrame:
    """Recorded history with forecast weather behind it: observed weather wins per cell."""
    if strict:
        require_rows(history, "cannot build an inference frame without any history")
    known = history.select(*keys, ts, *[c for c in WEATHER if c in history.columns])
    load = history.select(*keys, ts, *[c for c in (LOAD, FORECAST) if c in history.columns])
    return build_dataset(load, overlay_cells(known, weather_forecast, keys, ts), "serving", tz, keys, ts)


def features_for_targets(
    history: DataFrame, weather_forecast: DataFrame, horizon: int, targets: DataFrame,
    rolling_window: int = DEFAULT_ROLLING_WINDOW, weekly_lag: int = DEFAULT_WEEKLY_LAG,
    tz: str = DEFAULT_TZ, keys=KEYS, ts: str = TS,
) -> DataFrame:
    """Feature rows for the requested hours that can be built. Runs a job.

    The history is cut to what those hours can reach before anything is joined or sorted: by
    a literal, so that a partitioned table is read from there on only, and by each series' own
    reach behind it, so that one series that lags does not widen the others' windows.
    """
    reach = look_back_hours(horizon, weekly_lag, rolling_window)
    h = hour_number(ts)
    spans = through_table(targets.groupBy(*keys).agg((F.min(h) - reach).alias("_low"), F.max(h).alias("_high")), "target-spans")
    span = spans.agg(F.min("_low").alias("a"), F.max("_high").alias("b")).first()
    from_reach = F.col(ts) >= F.timestamp_seconds(F.lit((span["a"] or 0) * 3600))
    upto = F.col(ts) < F.timestamp_seconds(F.lit(((span["b"] or 0) + 1) * 3600))

    def reached(df: DataFrame) -> DataFrame:
        own = with_scalars(df.filter(from_reach & upto), spans, keys)
        return own.filter(h.between(F.col("_low"), F.col("_high"))).drop("_low", "_high")

    frame = inference_frame(reached(history), reached(weather_forecast), tz, keys, ts)
    built = make_features(frame, horizon, rolling_window, weekly_lag, False, tz, keys, ts)
    return built.join(targets.select(*keys, ts), [*keys, ts], "left_semi")


def lost_targets(targets: DataFrame, served: DataFrame, keys=KEYS, ts: str = TS) -> DataFrame:
    """Requested hours that were not served."""
    return targets.select(*keys, ts).join(served.select(*keys, ts), [*keys, ts], "left_anti")


def servable_until(history: DataFrame, horizon: int, keys=KEYS, ts: str = TS) -> DataFrame:
    """Newest actual and the furthest hour it supports; both null without actuals."""
    return high_water(history, keys=keys, ts=ts).withColumn(
        "servable_until", plus_hours("last_actual", horizon)
    )


def target_hours(history: DataFrame, horizon: int, keys=KEYS, ts: str = TS) -> DataFrame:
    """Hours to forecast: after the newest actual, out to the horizon. Runs tile."""
    last = high_water(history, keys=keys, ts=ts).filter("last_actual IS NOT NULL")
    spans = last.select(
        *keys,
        (hour_number("last_actual") + 1).alias("h_first"),
        (hour_number("last_actual") + horizon).alias("h_last"),
    )
    return hours_between(spans, keys).select(*keys, F.timestamp_seconds(F.col("h") * 3600).alias(ts))


def local_day_hours(days: DataFrame, hours: int = 24, tz: str = DEFAULT_TZ, day: str = "day", ts: str = TS) -> DataFrame:
    """UTC hours of requested local days, counted from local midnight."""
    start = F.to_utc_timestamp(F.col(day).cast("timestamp"), tz)
    offsets = F.explode(F.sequence(F.lit(0), F.lit(hours - 1)))
    return days.withColumn("_k", offsets).withColumn(ts, plus_hours(start, F.col("_k"))).drop("_k")


def swap_weather(
    frame: DataFrame, archived: DataFrame, columns: Sequence[str] = ("temp_c",), keys=KEYS, ts: str = TS
) -> DataFrame:
    """Replace observed weather by archived forecasts over the span they cover.

    Outside the covered span rows are dropped; inside it a missing forecast stays null:
    falling back to observed values would hide the effect being measured.
    """
    columns = list(columns)
    unknown = [c for c in columns if c not in frame.columns or c not in archived.columns]
    if unknown:
        raise ValueError(f"cannot swap {unknown}: not present in both frames")
    fresh = archived.select(*keys, ts, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    complete = F.col("_hit")
    for c in columns:
        complete = complete & F.col(f"_new_{c}").isNotNull()
    # The span comes from the archive's hours that the frame has, the join is made once.
    whole = fresh.filter(complete).join(frame.select(*keys, ts), [*keys, ts], "left_semi")
    span = whole.groupBy(*keys).agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"))
    inside = with_scalars(frame, span, keys).filter(F.col(ts).between(F.col("_from"), F.col("_to")))
    swapped = inside.join(fresh, [*keys, ts], "left")
    return swapped.select(
        *[F.col(f"_new_{c}").alias(c) if c in columns else F.col(c) for c in frame.columns]
    )


def recent_actuals(df: DataFrame, days: int = 14, keys=KEYS, ts: str = TS) -> DataFrame:
    """Load and reference over the last days up to the newest actual, both ends inclusive."""
    last = high_water(df, keys=keys, ts=ts)
    return (
        with_scalars(df, last, keys)
        .filter(
            F.col(ts).between(
                F.timestamp_seconds(F.unix_seconds("last_actual") - days * 86400), F.col("last_actual")
            )
        )
        .select(*keys, ts, *[c for c in (LOAD, FORECAST) if c in df.columns])
    )
