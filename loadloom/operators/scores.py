"""Error tables over long predictions ``(keys, ts, model, y_true, y_pred)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import DEFAULT_TZ, KEYS, TS
from ..functions.clock import DEFAULT_PUBLICATION_HOUR, lead_hours, local_time
from ..functions.errors import ape, error_sums, merge_sums, metrics_from_sums, pinball
from ..functions.segments import DEFAULT_PEAK_HOURS, SEGMENT_KINDS, with_segments

NAIVE, REFERENCE, LINEAR = "naive_seasonal", "day_ahead_reference", "linear_calendar_weather"
CALENDAR_TREES, WEATHER_TREES, TUNED_TREES = "trees_calendar", "trees_weather", "trees_weather_tuned"
TABLE_ORDER = (NAIVE, LINEAR, REFERENCE, CALENDAR_TREES, WEATHER_TREES, TUNED_TREES)
PREFERENCE = (TUNED_TREES, WEATHER_TREES, CALENDAR_TREES)
WINS, LOSES = "model wins", "reference wins"


def to_long(wide: DataFrame, models: Sequence[str], actual: str = "actual", keys=KEYS, ts: str = TS) -> DataFrame:
    """One row per model from a frame with one column per model."""
    return wide.withColumnRenamed(actual, "y_true").unpivot(
        [*keys, ts, "y_true"], list(models), "model", "y_pred"
    )


def point_metrics(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """MAPE, RMSE, MAE and bias per group, in one aggregation."""
    sums = df.groupBy(*by).agg(*error_sums())
    return sums.select(*by, "n", "n_scored", *[c.alias(k) for k, c in metrics_from_sums().items()])


def overall(df: DataFrame, reference: str = REFERENCE, by: Sequence[str] = ()) -> DataFrame:
    """Metrics per model and the gap to the reference model of the same group."""
    table = point_metrics(df, [*by, "model"])
    # A group holds one row per model here, so the gap needs no second pass and no join.
    own = F.max(F.when(F.col("model") == reference, F.col("mape"))).over(Window.partitionBy(*by))
    return table.withColumn("mape_vs_reference", F.col("mape") - own)


def present_in_order(table: DataFrame, order: Sequence[str] = TABLE_ORDER, model: str = "model") -> DataFrame:
    """Preferred models first in their order, any other after them by name."""
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col(model))
    return table.orderBy(F.when(rank == 0, len(order) + 1).otherwise(rank), model)


def primary_model(df: DataFrame, by: Sequence[str] = (), preference: Sequence[str] = PREFERENCE) -> DataFrame:
    """First available model of a preference list."""
    rank = F.array_position(F.array(*[F.lit(m) for m in preference]), F.col("model"))
    ranked = df.withColumn("_rank", rank).filter("_rank > 0")
    return ranked.groupBy(*by).agg(F.min_by("model", "_rank").alias("model"))


def by_segment(
    df: DataFrame, by: Sequence[str] = ("model",), ts: str = TS, tz: str = DEFAULT_TZ,
    peak_hours=DEFAULT_PEAK_HOURS,
) -> DataFrame:
    """Metrics per (segment kind, segment) and group.

    The data is read once into sums per *combination* of the five labels (at most 64 per
    group); only those few rows are spread over the five kinds and merged again.
    """
    sums = with_segments(df, ts, tz, peak_hours).groupBy(*by, *SEGMENT_KINDS).agg(*error_sums())
    spread = sums.unpivot(
        [*by, "n", "n_scored", "n_ape", "s_ape", "s_sq", "s_abs", "s_err"],
        list(SEGMENT_KINDS), "segment_kind", "segment",
    )
    merged = spread.groupBy("segment_kind", "segment", *by).agg(*merge_sums())
    return merged.select(
        "segment_kind", "segment", *by, "n", "n_scored",
        *[c.alias(k) for k, c in metrics_from_sums().items()],
    )


def versus_reference(
    segments: DataFrame, model: str, reference: str = REFERENCE, by: Sequence[str] = ()
) -> DataFrame:
    """Model and reference side by side per segment, with gap and verdict.

    Present with ``orderBy(desc("gap"))``: the losses come first.
    """
    wide = (
        segments.groupBy(*by, "segment_kind", "segment", "n")
        .pivot("model", [model, reference])
        .agg(F.first("mape"))
        .withColumnsRenamed({model: "model_mape", reference: "reference_mape"})
    )
    gap = F.col("model_mape") - F.col("reference_mape")
    return wide.withColumn("gap", gap).withColumn("verdict", F.when(gap < 0, WINS).otherwise(LOSES))


def by_local_hour(
    df: DataFrame, by: Sequence[str] = ("model",), ts: str = TS, tz: str = DEFAULT_TZ,
    publication_hour: int = DEFAULT_PUBLICATION_HOUR,
) -> DataFrame:
    """Mean APE and mean lead time per local hour of day."""
    return (
        df.withColumn("local_hour", F.hour(local_time(ts, tz)))
        .groupBy("local_hour", *by)
        .agg(
            F.avg(lead_hours(ts, tz, publication_hour)).alias("lead_h"),
            (F.avg(ape("y_true", "y_pred")) * 100).alias("mape"),
        )
    )


def pinball_table(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean pinball loss over long quantile predictions ``(..., quantile, y_true, y_pred)``."""
    loss = pinball("y_true", "y_pred", F.col("quantile"))
    return df.groupBy(*by, "quantile").agg(F.avg(loss).alias("pinball"))


def coverage_days(df: DataFrame, by: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Row count, first and last hour, and days covered (whole days between them, plus one)."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        (
            F.floor((F.unix_seconds(F.max(ts)) - F.unix_seconds(F.min(ts))) / 86400) + 1
        ).alias("coverage_days"),
    )


def ranked(table: DataFrame, by: Sequence[str] = (), metric: str = "mape") -> DataFrame:
    """Rank models by a metric inside each small metrics table."""
    return table.withColumn("rank", F.rank().over(Window.partitionBy(*by).orderBy(metric)))


def correlations(df: DataFrame, features: Sequence[str], target: str = "target", by=KEYS) -> DataFrame:
    """Pearson correlation of each feature with the target, all in one aggregation."""
    wide = df.groupBy(*by).agg(*[F.corr(f, target).alias(f) for f in features])
    return wide.unpivot(list(by), list(features), "feature", "correlation")


