"""The prediction log: scoring against revised actuals and served performance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import DEFAULT_TZ, KEYS, TS
from ..functions.errors import ape, error_sums, metrics_from_sums, signed_ape
from ..functions.scalars import optional
from ..operators.align import with_scalars
from ..operators.latest import latest_per_key
from ..session import through_table
from ..sources import tables
from .features import features_for_targets, target_hours
from .models import with_band

# Monitoring thresholds.
MIN_SCORED, MAPE_THRESHOLD = 168, 4.0
EMPTY, ACCUMULATING, MEASURING = "empty", "accumulating", "measuring"


def score(
    predictions: DataFrame, actuals: DataFrame, scored_at=None, keys=KEYS, arrival: str | None = None
) -> DataFrame:
    """Scores of every prediction whose hour has a non-zero actual, one row per prediction.

    Everything is scored again on each run, since actuals are revised. Of several revisions
    of an hour the last one counts: the largest ``arrival``, or without that column the
    largest load. A missing reference forecast leaves its two columns null.
    """
    if "load_mw" not in actuals.columns:
        raise ValueError("scoring needs actuals with a load_mw column")
    reference = F.col("tso_forecast_mw") if "tso_forecast_mw" in actuals.columns else F.lit(None).cast("double")
    order = F.struct(*([F.col(arrival)] if arrival else []), F.col("load_mw"), reference.alias("r"))
    known = (
        actuals.withColumn("tso_forecast_mw", reference).groupBy(*keys, F.col(TS).alias("target_time"))
        .agg(F.max_by(F.struct("load_mw", "tso_forecast_mw"), order).alias("_a"))
        .select(*keys, "target_time", F.col("_a.load_mw").alias("actual_mw"), F.col("_a.tso_forecast_mw").alias("tso_forecast_mw"))
        .filter("actual_mw IS NOT NULL AND actual_mw <> 0")
    )
    made = predictions.select("id", *keys, "target_time", F.col("load_mw").alias("_p"))
    when = F.current_timestamp() if scored_at is None else F.lit(scored_at).cast("timestamp")
    return made.join(known, [*keys, "target_time"]).select(
        F.col("id").alias("prediction_id"),
        "actual_mw",
        F.abs(F.col("_p") - F.col("actual_mw")).alias("abs_error_mw"),
        signed_ape("actual_mw", "_p").alias("ape"),
        "tso_forecast_mw",
        F.abs(F.col("tso_forecast_mw") - F.col("actual_mw")).alias("tso_abs_error_mw"),
        when.alias("scored_at"),
    )


def upsert_scores(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Fresh scores replace old ones by prediction id; old ones without a fresh one stay."""
    return existing.join(fresh, "prediction_id", "left_anti").unionByName(fresh)


def rescore(
    spark, predictions: DataFrame | str, scores_path: str, actuals: DataFrame, scored_at=None, arrival: str | None = None,
    grain: str = "day",
) -> None:
    """Score the hours of ``actuals`` and put the scores into their day (or month) folders. Runs jobs.

    The log (a frame or its path) is read on the days of those hours, and on no day between
    them. Only the folders that get a score are read, merged with one join and replaced;
    the merged rows are stored aside first. The same actuals twice change nothing.
    """
    days = [r["d"] for r in actuals.select(F.to_date(TS).alias("d")).filter("d IS NOT NULL").distinct().collect()]  # a calendar
    if not days:
        return
    if isinstance(predictions, str):
        log = tables.read_predictions(spark, predictions, days=days)
    else:
        log = tables.filter_predictions(predictions, days=days)
    day = log.select(F.col("id").alias("prediction_id"), F.date_format("target_time", tables.GRAINS[grain]).alias("period"))
    fresh = through_table(score(log, actuals, scored_at, arrival=arrival).join(day, "prediction_id"), "fresh-scores")
    periods = [r["period"] for r in fresh.select("period").distinct().collect()]  # the calendar of one pull
    if not periods:
        return
    old = tables.read_scores(spark, scores_path, periods).withColumn("_old", F.lit(True)).alias("o")
    new = fresh.withColumn("_new", F.lit(True)).alias("n")
    merged = old.join(new, F.col("o.prediction_id") == F.col("n.prediction_id"), "full").select(
        *[F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in fresh.columns]
    )
    tables.write_score_periods(through_table(merged, "merged-scores"), scores_path)


def scored_predictions(
    predictions: DataFrame, scores: DataFrame, since=None, until=None, latest_only: bool = True,
    key: Sequence[str] = tables.FORECAST_KEY,
) -> DataFrame:
    """Predictions with their scores; by default only the standing forecast per target."""
    made = tables.filter_predictions(predictions, since, until)
    renamed = scores.withColumnRenamed("tso_forecast_mw", "tso_mw").withColumnRenamed("prediction_id", "id")
    joined = made.join(renamed, "id")
    return tables.latest_per_target(joined, key) if latest_only else joined


def served_forecast(predictions: DataFrame, days: int = 3, keys=KEYS) -> DataFrame:
    """Standing forecasts of the last days of targets, per series."""
    newest = predictions.groupBy(*keys).agg(F.max("target_time").alias("_newest"))
    recent = with_scalars(predictions, newest, keys).filter(
        F.col("target_time") >= F.timestamp_seconds(F.unix_seconds("_newest") - days * 86400)
    )
    return tables.latest_per_target(recent.drop("_newest"))


def performance(
    scored: DataFrame, by: Sequence[str] = (), min_scored: int = MIN_SCORED,
    threshold: float = MAPE_THRESHOLD, groups: DataFrame | None = None,
) -> DataFrame:
    """Served error with a sufficiency gate, and the reference on the same hours.

    ``groups`` adds groups without any scored row, reported as empty. The numbers are always
    there; ``sufficient`` says whether ``min_scored`` rows stand behind them, and only then
    is a breach claimed.
    """
    aggs = [
        F.count(F.lit(1)).alias("scored"),
        (F.avg("ape") * 100).alias("_mape"),
        (F.avg(ape("actual_mw", "tso_mw")) * 100).alias("_tso"),
        *[c for c in error_sums("actual_mw", "load_mw")],
    ]
    table = scored.groupBy(*by).agg(*aggs)
    if groups is not None:
        table = groups.join(table, list(by), "left").withColumn("scored", F.coalesce("scored", F.lit(0)))
    enough = F.col("scored") >= min_scored
    sums = metrics_from_sums()
    return table.select(
        *by,
        "scored",
        F.when(F.col("scored") == 0, EMPTY).when(enough, MEASURING).otherwise(ACCUMULATING).alias("status"),
        enough.alias("sufficient"), F.col("_mape").alias("model_mape"), F.col("_tso").alias("tso_mape"),
        *[sums[m].alias(m) for m in ("rmse_mw", "mae_mw", "bias_mw")],
        (enough & F.coalesce(F.col("_mape") > threshold, F.lit(False))).alias("breached"),
    )


def evaluate(
    predictions: DataFrame, actuals: DataFrame, now=None, window_days: int = 14,
    by: Sequence[str] = KEYS, min_scored: int = MIN_SCORED,
) -> DataFrame:
    """The daily evaluation: re-score, then performance over the trailing window.

    The window ends at ``now``, or per series at its newest prediction's target.
    """
    groups = predictions.select(*by).distinct()
    if now is None:
        ends = predictions.groupBy(*by).agg(F.max("target_time").alias("_end"))
        predictions, end = with_scalars(predictions, ends, by), F.col("_end")
    else:
        end = F.lit(now).cast("timestamp")
    # The window comes first: only its forecasts are ranked, joined and scored.
    inside = F.col("target_time").between(F.timestamp_seconds(F.unix_seconds(end) - window_days * 86400), end)
    recent = predictions.filter(inside).drop("_end")
    table = performance(scored_predictions(recent, score(recent, actuals)), by, min_scored, groups=groups)
    return table.withColumn("gap", F.col("model_mape") - F.col("tso_mape"))


def forecast_records(
    scored_features: DataFrame, features: Sequence[str], made_at, horizon: int, model_name: str,
    model_version: str, run_id: str | None = None, dataset_version: str | None = None,
) -> DataFrame:
    """Log records from feature rows with a prediction; band values rounded to 0.1."""
    feature_map = F.map_from_arrays(
        F.array(*[F.lit(f) for f in features]), F.array(*[F.col(f) for f in features])
    )
    band = {
        q: (optional(q) if q in scored_features.columns else F.lit(None).cast("double")).alias(q)
        for q in ("p10", "p50", "p90")
    }
    made = made_at if isinstance(made_at, Column) else F.lit(made_at).cast("timestamp")
    return scored_features.select(
        *KEYS,
        made.alias("predicted_at"),
        F.col(TS).alias("target_time"),
        F.lit(horizon).alias("horizon_hours"),
        F.col("prediction").alias("load_mw"),
        *band.values(),
        F.lit(model_name).alias("model_name"),
        F.lit(str(model_version)).alias("model_version"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(dataset_version).cast("string").alias("dataset_version"),
        feature_map.alias("features"),
    )


def forecast(
    history: DataFrame, weather_forecast: DataFrame, champion, made_at, tz: str = DEFAULT_TZ, **features
) -> DataFrame:
    """Records for every reachable hour: targets, features, model, log shape.

    ``champion`` is a ``plans.models.Champion``; with residual offsets it serves a band
    (p10, p50, p90) around the point. Without actuals or buildable hours the
    result is empty, which is a state and not a fault.
    """
    targets = target_hours(history, champion.horizon)
    rows = features_for_targets(history, weather_forecast, champion.horizon, targets, tz=tz, **features)
    predicted = champion.predict(rows)
    if champion.offsets is not None:
        predicted = with_band(predicted, champion.offsets, tz=tz)
    return forecast_records(
        predicted, champion.columns, made_at, champion.horizon, champion.name, champion.version,
        champion.run_id, champion.dataset_version,
    )


def newest(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Newest row per key, e.g. the latest check or report."""
    return latest_per_key(df, key, [order])
