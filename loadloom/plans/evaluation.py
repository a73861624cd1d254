"""Backtests: rolling origin, lead-time matched, and the fairness audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import DEFAULT_TZ, KEYS, TS
from ..functions.names import TARGET, feature_columns
from ..operators.align import matched_rows, on_common_rows, with_scalars
from ..operators.asof import as_known_at, publication_time
from ..operators.history import seasonal_naive
from ..operators.latest import last_block_wins
from ..operators.scores import (
    CALENDAR_TREES,
    LINEAR,
    NAIVE,
    REFERENCE,
    TUNED_TREES,
    WEATHER_TREES,
    overall,
    to_long,
)
from ..operators.splits import chronological_split, rolling_origins, test_rows, train_rows
from ..session import require_rows, through_table
from . import models
from .features import (
    LEAD_FEATURES,
    by_lead,
    feature_names,
    lead_history,
    lead_horizons,
    make_features,
    swap_weather,
)
from .quantiles import band_by_origin

GATE_MODEL = "gate_closure"
QUANTILE_BAND = "quantile_band"
FLAT, GATE_OBSERVED, GATE_FORECAST = "A", "B", "C"


def references(frame: DataFrame, weekly_lag: int = 168, keys=KEYS, ts: str = TS) -> DataFrame:
    """Seasonal naive and the competing published forecast per hour, side by side."""
    naive = seasonal_naive(
        frame.select(*keys, ts, "load_mw", "tso_forecast_mw"), weekly_lag, out=NAIVE, keys=keys, ts=ts
    )
    return naive.select(*keys, ts, NAIVE, F.col("tso_forecast_mw").alias(REFERENCE))


def linear_by_origin(
    features: DataFrame, splits: DataFrame, columns: Sequence[str], keys=KEYS, ts: str = TS, extra: Sequence[str] = (),
    served: DataFrame | None = None,
) -> DataFrame:
    """Least squares refitted at every origin of every series, in one pass.

    Each row is placed in the first origin whose training reaches it; prefix sums over
    origins give every expanding window. ``extra`` adds independent groups (a horizon).
    ``served`` are the rows to predict, by default all of ``features``.
    """
    keys, extra = list(keys), list(extra)
    ends = splits.select(*keys, "origin_no", "train_end")
    schedule = ends.groupBy(*keys).agg(F.array_sort(F.collect_list("train_end")).alias("_ends"))
    # One end per origin: a decade of weekly origins is some 500 numbers.
    placed = (
        with_scalars(features, schedule, keys)
        .withColumn("origin_no", F.size(F.filter("_ends", lambda e: e < F.col(ts))) + 1)
        .filter(F.col("origin_no") <= F.size("_ends"))
        .withColumn("origin_no", F.col("origin_no").cast("long"))
    )
    gram = models.grouped_gram(placed, columns, [*keys, *extra, "origin_no"])
    steps = schedule.select(*keys, F.size("_ends").cast("long").alias("n_origins"))
    coefficients = models.solve_expanding(gram, columns, [*keys, *extra], steps)
    rows = features if served is None else served
    tested = test_rows(rows, splits.select(*keys, "origin_no", "test_start", "test_end"), keys, ts)
    joined = tested.join(coefficients, [*keys, *extra, "origin_no"])
    predicted = models.apply_linear(joined, columns, "y_pred")
    return last_block_wins(predicted, "y_pred", "origin_no", [*keys, *extra, ts])


def _origin_numbers(splits: DataFrame) -> list[int]:
    """Origin numbers in play: one small integer per step of the schedule."""
    return [r["origin_no"] for r in splits.select("origin_no").distinct().orderBy("origin_no").collect()]


def trees_by_origin(
    features: DataFrame, splits: DataFrame, variants: dict[str, tuple[Sequence[str], dict | None]],
    horizon: int, inner_validation_days: int = 45, seed: int = models.SEED, keys=KEYS, ts: str = TS,
) -> DataFrame:
    """Boosted trees refitted at each origin; long blocks ``(keys, ts, origin_no, model, y_pred)``.

    A driver loop over origins and variants whose every fit is a distributed job. Each
    origin stops early on the tail of its own training block, behind an embargo. A block is
    stored as soon as it is fitted, so the plan does not grow with the schedule.
    """
    blocks = None
    for number in _origin_numbers(splits):
        split = splits.filter(F.col("origin_no") == number)
        labelled = chronological_split(train_rows(features, split, keys, ts), inner_validation_days, horizon, keys, ts)
        train, later = labelled.filter("block = 'train'"), labelled.filter("block = 'validation'")
        tested = test_rows(features, split.select(*keys, "origin_no", "test_start", "test_end"), keys, ts)
        for name, (columns, params) in variants.items():
            fitted = models.fit_trees(train, later, columns, params=params, seed=seed)
            block = through_table(fitted.predict(tested).select(
                *keys, ts, "origin_no", F.lit(name).alias("model"), F.col(models.PREDICTION).alias("y_pred")
            ), "origin-block")
            blocks = block if blocks is None else blocks.unionByName(block)
    return blocks


def run_backtest(
    frame: DataFrame, horizon: int, initial_train_days: int, test_days: int, step_days: int,
    max_splits: int | None = None, first_test_start=None, trees: Sequence[str] = (CALENDAR_TREES, WEATHER_TREES),
    tuned_params: dict | None = None, inner_validation_days: int = 45, rolling_window: int = 24,
    weekly_lag: int = 168, tz: str = DEFAULT_TZ, seed: int = models.SEED, keys=KEYS, ts: str = TS,
    quantiles: Sequence[float] = (), band_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rolling-origin backtest: ``(keys, ts, y_true, model, y_pred)`` on common hours. Runs jobs.

    Every model and reference is scored on exactly the hours all of them have. Pass the
    parameters found once on the first origin (``tune_first_origin``) as ``tuned_params``.

    With ``quantiles`` a column ``quantile`` is added, null for the point models, and the rows
    of model ``quantile_band`` hold each origin's fitted quantiles on all its test hours. They
    use ``band_columns``, by default all features; none make the trailing sample quantiles.
    """
    keys = list(keys)
    features = through_table(
        make_features(frame, horizon, rolling_window, weekly_lag, tz=tz, keys=keys, ts=ts), "features"
    )
    splits = rolling_origins(
        features, horizon, initial_train_days, test_days, step_days, max_splits, first_test_start, keys, ts
    )
    splits = through_table(splits, "splits")
    require_rows(splits, "no split fits: too little history for the training and test days asked for")
    names = feature_names(horizon, rolling_window, weekly_lag)
    specs: dict[str, tuple[Sequence[str], dict | None]] = {}
    if CALENDAR_TREES in trees:
        specs[CALENDAR_TREES] = (feature_columns(names, include_weather=False), None)
    if WEATHER_TREES in trees:
        specs[WEATHER_TREES] = (names, None)
    if tuned_params is not None:
        specs[TUNED_TREES] = (names, tuned_params)
    used = feature_columns(names, include_lags=False)
    linear = linear_by_origin(features, splits, used, keys, ts).select(*keys, ts, F.col("y_pred").alias(LINEAR))
    tested = test_rows(features, splits.select(*keys, "origin_no", "test_start", "test_end"), keys, ts)
    base = tested.select(*keys, ts, F.col(TARGET).alias("actual")).dropDuplicates([*keys, ts])
    sides = [references(frame, weekly_lag, keys, ts), linear]
    if specs:
        blocks = trees_by_origin(features, splits, specs, horizon, inner_validation_days, seed, keys, ts)
        winner = last_block_wins(blocks, "y_pred", "origin_no", [*keys, ts, "model"])
        sides.append(winner.groupBy(*keys, ts).pivot("model", list(specs)).agg(F.first("y_pred")))
    wide = on_common_rows(base, sides, keys, ts)
    long = to_long(wide, [NAIVE, REFERENCE, LINEAR, *specs], "actual", keys, ts)
    if not quantiles:
        return long
    band = band_by_origin(features, splits, names if band_columns is None else band_columns, quantiles, keys, ts)
    point = long.withColumn("quantile", F.lit(None).cast("double"))
    return point.unionByName(band.withColumn("model", F.lit(QUANTILE_BAND)))


def tune_first_origin(
    features: DataFrame, splits: DataFrame, columns: Sequence[str], horizon: int,
    inner_validation_days: int, grid: dict[str, Sequence], keys=KEYS, ts: str = TS,
) -> tuple[dict, list]:
    """Search once, on the first origin's training block, and freeze the result."""
    first = splits.filter("origin_no = 1")
    labelled = chronological_split(train_rows(features, first, keys, ts), inner_validation_days, horizon, keys, ts)
    labelled = through_table(labelled, "tuning")
    return models.tune(
        labelled.filter("block = 'train'"), labelled.filter("block = 'validation'"), columns, grid
    )


def run_gate_closure_backtest(
    frame: DataFrame, initial_train_days: int, test_days: int, step_days: int,
    max_splits: int | None = None, first_test_start=None, publication_hour: int = 10,
    horizons: Sequence[int] | None = None, learner: str = "linear", inner_validation_days: int = 45,
    rolling_window: int = 24, weekly_lag: int = 168, tz: str = DEFAULT_TZ, seed: int = models.SEED,
    keys=KEYS, ts: str = TS,
) -> DataFrame:
    """Each hour forecast by the model of its own lead time. Runs jobs.

    Origins come from the widest horizon's rows and are shared by all; each horizon keeps
    its own embargo inside the training block. ``learner="linear"`` fits every
    (series, horizon, origin) model on all features in one pass; ``"trees"`` loops over
    horizons and origins.
    """
    keys = list(keys)
    horizons = list(horizons or lead_horizons(publication_hour))
    wide = through_table(
        lead_history(frame, rolling_window, weekly_lag, publication_hour, horizons, keys, ts), "lead-history"
    )

    def unfolded(own_only: bool = False) -> DataFrame:
        """Rows per horizon, made while the stored wide rows are read."""
        return by_lead(wide, rolling_window, weekly_lag, tz, publication_hour, horizons, own_only, keys, ts)

    long, own_rows = unfolded(), unfolded(own_only=True)
    # Horizons no hour has a lead of (the 25-hour day's, mostly) serve nothing.
    in_play = [
        r["lead_h"]
        for r in long.select("lead_h").distinct().filter("lead_h >= 1").orderBy("lead_h").collect()
        if r["lead_h"] in horizons
    ]
    if not in_play:
        raise ValueError("no split fits the lead-matched backtest: no hour has features at its own lead")
    widest = max(in_play)
    anchor_rows = long.filter(F.col("horizon") == widest)
    splits = through_table(
        rolling_origins(
            anchor_rows, widest, initial_train_days, test_days, step_days, max_splits, first_test_start, keys, ts
        ),
        "lead-splits",
    )
    require_rows(splits, "no split fits the lead-matched backtest")
    used = long.filter(F.col("horizon").isin(in_play))
    if learner == "linear":
        predicted = linear_by_origin(used, splits, LEAD_FEATURES, keys, ts, extra=["horizon"], served=own_rows)
    else:
        blocks = None
        for h in in_play:
            block = trees_by_origin(
                used.filter(F.col("horizon") == h), splits, {GATE_MODEL: (LEAD_FEATURES, None)}, h,
                inner_validation_days, seed, keys, ts,
            ).withColumn("horizon", F.lit(h))
            blocks = block if blocks is None else blocks.unionByName(block)
        predicted = last_block_wins(blocks, "y_pred", "origin_no", [*keys, ts, "horizon"])
    own = own_rows.select(*keys, ts, "horizon", F.col(TARGET).alias("actual"))
    served = own.join(predicted, [*keys, ts, "horizon"]).select(
        *keys, ts, "horizon", "actual", F.col("y_pred").alias(GATE_MODEL)
    )
    wide = on_common_rows(served, [references(frame, weekly_lag, keys, ts)], keys, ts)
    return wide.withColumnRenamed("actual", "y_true").unpivot(
        [*keys, ts, "horizon", "y_true"], [GATE_MODEL, NAIVE, REFERENCE], "model", "y_pred"
    )


def audit(
    frame: DataFrame, day_ahead_weather: DataFrame, swap: Sequence[str] = ("temp_c",), horizon: int = 24,
    learner: str = "linear", tz: str = DEFAULT_TZ, publication_hour: int = 10, keys=KEYS, ts: str = TS,
    issued: str | None = None, **schedule,
) -> DataFrame:
    """Variants A (flat horizon), B (lead-matched), C (B with forecast weather), matched. Runs jobs.

    With ``issued``, the name of an issue time, ``day_ahead_weather`` holds vintages, and each
    hour is served the newest one that was out at its publication time.

    All three see the same span, the one archived forecasts cover, and are scored on the
    hours all three scored. Long, with column ``variant`` and models ``model`` (the
    variant's own), the seasonal naive and the reference.
    """
    keys = list(keys)
    if issued is not None:
        known = publication_time(ts, tz, publication_hour)
        day_ahead_weather = as_known_at(day_ahead_weather, swap, known, issued, keys=keys, ts=ts)
    forecast_frame = through_table(swap_weather(frame, day_ahead_weather, swap, keys, ts), "audit-frame")
    observed = frame.join(forecast_frame.select(*keys, ts), [*keys, ts], "left_semi")
    trees = [WEATHER_TREES] if learner == "trees" else []
    flat = run_backtest(observed, horizon, trees=trees, tz=tz, keys=keys, ts=ts, **schedule)
    own = WEATHER_TREES if learner == "trees" else LINEAR

    def shaped(df: DataFrame, model: str, label: str) -> DataFrame:
        return df.filter(F.col("model").isin(model, NAIVE, REFERENCE)).select(
            *keys, ts, F.lit(label).alias("variant"),
            F.when(F.col("model") == model, "model").otherwise(F.col("model")).alias("model"),
            "y_true", "y_pred",
        )

    gate = {
        label: run_gate_closure_backtest(
            f, learner=learner, tz=tz, publication_hour=publication_hour, keys=keys, ts=ts, **schedule
        )
        for label, f in ((GATE_OBSERVED, observed), (GATE_FORECAST, forecast_frame))
    }
    parts = [shaped(flat, own, FLAT)] + [shaped(g, GATE_MODEL, label) for label, g in gate.items()]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return matched_rows(through_table(long, "audit"), "variant", 3, keys, ts)


def audit_table(matched: DataFrame) -> DataFrame:
    """Headline per variant and model: metrics and gap to the reference."""
    return overall(matched, by=["variant"])
