"""Assembling, merging and ingesting the canonical hourly table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import DEFAULT_TZ, KEYS, TS
from ..functions.clock import ceil_to, floor_to, hour_number
from ..functions.holidays import with_holiday_flag
from ..operators.align import outer_align, overlay_cells, replace_rows
from ..operators.quality import validate
from ..operators.spine import hours_between
from ..operators.splits import minimum_training_hours
from ..session import require_positive, through_table
from ..sources import canonical, tables
from . import folders

# Re-pull and weather-archive settings.
TRAILING_DAYS = 14
ARCHIVE_LAG_DAYS = 7


def build_dataset(
    load: DataFrame, weather: DataFrame, run_id: str | None = None, tz: str = DEFAULT_TZ,
    keys: Sequence[str] = KEYS, ts: str = TS,
) -> DataFrame:
    """Load, reference forecast, weather and holidays on one complete hourly axis.

    The axis spans the union of both inputs, so weather reaching past the last actual
    yields rows with a null load. An input hour off the whole hour takes no part.
    """
    joined = outer_align(load, weather, keys, ts)
    h = hour_number(ts)
    # Bounds come from the two inputs directly: two map-side-combined aggregations, not a
    # second reading of the join.
    spans = [
        d.groupBy(*keys).agg(F.min(h).alias("h_first"), F.max(h).alias("h_last"))
        for d in (load, weather)
    ]
    span = spans[0].unionByName(spans[1]).groupBy(*keys).agg(
        F.min("h_first").alias("h_first"), F.max("h_last").alias("h_last")
    )
    axis = hours_between(span, keys).select(*keys, F.timestamp_seconds(F.col("h") * 3600).alias(ts))
    filled = axis.join(joined, [*keys, ts], "left")
    flagged = with_holiday_flag(filled, ts, tz)
    return canonical.project(flagged, run_id or canonical.new_run_id(), keys, ts)


def merge_datasets(
    existing: DataFrame, incoming: DataFrame, tz: str = DEFAULT_TZ, keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Overlay a fresh pull: incoming rows win whole, other rows keep value and version.

    An hour neither side covers becomes a null row; its holiday flag comes from the
    calendar and its version stays null.
    """
    replaced = replace_rows(existing, incoming, keys, ts)
    h = hour_number(ts)
    spans = reduce(
        DataFrame.unionByName,
        [d.groupBy(*keys).agg(F.min(h).alias("h_first"), F.max(h).alias("h_last")) for d in (existing, incoming)],
    ).groupBy(*keys).agg(F.min("h_first").alias("h_first"), F.max("h_last").alias("h_last"))
    axis = hours_between(spans, keys).select(*keys, F.timestamp_seconds(F.col("h") * 3600).alias(ts))
    filled = axis.join(replaced, [*keys, ts], "left")
    return canonical.project(with_holiday_flag(filled, ts, tz), None, keys, ts)


def archive_then_forecast(archive: DataFrame, forecast: DataFrame, archive_end, keys=KEYS, ts: str = TS) -> DataFrame:
    """Observed weather up to the archive's reach, forecast for every cell it lacks."""
    cut = archive_end if isinstance(archive_end, Column) else F.lit(archive_end).cast("timestamp")
    return overlay_cells(archive.filter(F.col(ts) <= cut), forecast, keys, ts)


def high_water(df: DataFrame, value: str = "load_mw", keys=KEYS, ts: str = TS) -> DataFrame:
    """Newest hour with a value, per key; null when there is none."""
    return df.groupBy(*keys).agg(F.max(F.when(F.col(value).isNotNull(), F.col(ts))).alias("last_actual"))


def trailing_window(
    state: DataFrame, now, trailing_days: int = TRAILING_DAYS, resume: str = "resume_from"
) -> DataFrame:
    """Window to pull per row of ``state``: trailing days, widened back to ``resume``."""
    require_positive(trailing_days=trailing_days)
    at = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    start = floor_to("day", F.timestamp_seconds(F.unix_seconds(at) - trailing_days * 86400))
    end = ceil_to("day", F.timestamp_seconds(F.unix_seconds(at) + 86400))
    widened = F.when(F.col(resume) < start, floor_to("day", resume)).otherwise(start)
    return state.withColumn("window_start", widened).withColumn("window_end", end)


def resume_points(existing: DataFrame, successes: DataFrame, keys=KEYS, ts: str = TS, state: DataFrame | None = None) -> DataFrame:
    """Where an ingest resumes: its last success, else the newest stored actual; with the
    table's folder ``state`` that is found without reading it."""
    return (
        (high_water(existing, keys=keys, ts=ts) if state is None else folders.high_water_of(state, keys))
        .join(successes, list(keys), "full")
        .withColumn("resume_from", F.coalesce("last_success", "last_actual"))
    )


def rebuild_decision(
    known: DataFrame, existing: DataFrame, configured_start, validation_days: int, horizon: int,
    weekly_lag: int, keys=KEYS, ts: str = TS, state: DataFrame | None = None,
) -> DataFrame:
    """Rebuild the full history? With no data at all, or when the stored rows are both too
    few to train on and start more than a day later than configured. ``state``: the table's
    folder state, read in its place."""
    needed = minimum_training_hours(validation_days, horizon, weekly_lag)
    start = configured_start if isinstance(configured_start, Column) else F.lit(configured_start).cast("timestamp")
    if state is None:
        stored = existing.groupBy(*keys).agg(F.count(F.lit(1)).alias("hours"), F.min(ts).alias("first_ts"))
    else:
        stored = folders.merged_state(state, keys).select(*keys, F.col("n").alias("hours"), "first_ts")
    late = F.unix_seconds("first_ts") > F.unix_seconds(start) + 86400
    return known.join(stored, list(keys), "left").select(
        *known.columns,
        F.coalesce("hours", F.lit(0)).alias("hours"),
        F.lit(needed).alias("needed"),
        F.when(F.col("hours").isNull(), "no dataset")
        .when((F.col("hours") < needed) & late, "too short and starts late")
        .otherwise("none")
        .alias("rebuild_reason"),
    )


def touched_periods(
    stored: DataFrame, incoming: DataFrame, pattern: str, keys=KEYS, ts: str = TS, state: DataFrame | None = None
) -> list[str]:
    """Folders a merge can change, over all series: those of the pulled hours, and those of
    the hole between a series' stored hours and them. A list of months or days for the driver.
    With the table's folder ``state`` no stored row is read.
    """
    hours = incoming.select(F.date_format(ts, pattern).alias("p")).distinct()
    ends = stored.select(*keys, F.col(ts).alias("first_ts"), F.col(ts).alias("last_ts")) if state is None else state
    low, high = F.min(hour_number("first_ts")), F.max(hour_number("last_ts"))
    there = ends.groupBy(*keys).agg(low.alias("s_lo"), high.alias("s_hi"))
    h = hour_number(ts)
    both = there.join(incoming.groupBy(*keys).agg(F.min(h).alias("i_lo"), F.max(h).alias("i_hi")), list(keys))
    # Hours after the stored end and before the pull, or after the pull and before the stored start.
    hole = both.select(
        F.explode(F.array(
            F.struct((F.col("s_hi") + 1).alias("a"), (F.col("i_lo") - 1).alias("b")),
            F.struct((F.col("i_hi") + 1).alias("a"), (F.col("s_lo") - 1).alias("b")),
        )).alias("x")
    ).select("x.*").filter("a <= b")
    step = F.expr("INTERVAL 1 DAY")
    days = F.sequence(F.to_date(F.timestamp_seconds(F.col("a") * 3600)), F.to_date(F.timestamp_seconds(F.col("b") * 3600)), step)
    filled = hole.select(F.explode(days).alias("d")).select(F.date_format("d", pattern).alias("p")).distinct()
    return sorted(r["p"] for r in hours.union(filled).distinct().collect())


def ingest(
    spark, path: str, load: DataFrame, weather: DataFrame, run_id: str | None = None,
    events_path: str | None = None, at=None, tz: str = DEFAULT_TZ, grain: str = "month", whole: bool = True,
    state_path: str | None = None,
) -> DataFrame:
    """Merge one pull into the stored table, write, then record the success. Runs jobs.

    The same pull twice gives the same table. Only the folders the pull can change, for any
    series, are read, merged and replaced; the merged rows are stored aside first, so the
    table is never read and overwritten in one plan. Data is written also when it has
    issues: the returned issue table is that of the whole stored table (``whole=False``:
    of the rewritten folders). The success marker comes last.

    ``state_path`` names the table's folder state: the folders to touch are then found without
    reading the table, and the state of the rewritten ones is replaced. A table that has no
    state yet gets one from a single full reading.
    """
    # The pull is landed first: assembling it reads each input twice.
    load, weather = through_table(load, "pull-load"), through_table(weather, "pull-weather")
    incoming = through_table(build_dataset(load, weather, run_id, tz), "incoming")
    if canonical.path_exists(spark, path):
        pattern = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}[grain]
        stored = canonical.read_periods(spark, path)
        state = None
        if state_path is not None:
            if not canonical.path_exists(spark, state_path):
                folders.write_state(folders.folder_state(stored, grain), state_path)
            state = folders.read_state(spark, state_path)
        periods = touched_periods(stored, incoming, pattern, state=state)
        touched = canonical.read_periods(spark, path, periods)
        # Folders between touched ones are complete as they are and stay out of the merge.
        rows = merge_datasets(touched, incoming, tz).filter(F.date_format(TS, pattern).isin(*periods))
        merged = through_table(rows, "merged")
    else:
        merged = incoming
    canonical.write_table(merged, path, grain=grain)
    if state_path is not None:
        folders.write_state(folders.folder_state(merged, grain), state_path)
    if events_path is not None:
        marker = spark.range(1).select(
            F.lit(None).cast("string").alias("series_id"),
            F.lit("ingest").alias("pipeline"),
            F.lit("success").alias("event"),
            (F.current_timestamp() if at is None else F.lit(at).cast("timestamp")).alias("at"),
        )
        tables.append(marker, events_path, tables.EVENTS)
    return validate(canonical.read_periods(spark, path) if whole else merged)
