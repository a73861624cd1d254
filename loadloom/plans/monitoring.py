"""Drift checks over feature inputs, predictions and served error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import DEFAULT_TZ, KEYS, TS
from ..functions.names import monitored_columns
from ..operators.align import with_scalars
from ..operators.history import look_back_hours
from ..operators.reference_window import (
    CURRENT_DAYS,
    MIN_ROWS,
    PAD_DAYS,
    SEASONAL,
    YEARS_BACK,
    choose_reference,
    current_windows,
    days,
    tag_windows,
    within_reach,
)
from ..operators.twosample import DISTANCE, P_VALUE, drift_share, drift_verdict, two_sample
from ..session import through_table
from ..sources import tables
from .features import feature_names, make_features
from .predictions import MAPE_THRESHOLD, MIN_SCORED, performance

# Status texts, the least rows of a window and the share that means drift.
INSUFFICIENT, DRIFT, OK = "insufficient_data", "drift", "ok"
MIN_WINDOW_ROWS, SHARE_THRESHOLD = 24, 0.3


def input_drift(
    inputs: DataFrame, windows: DataFrame, columns: Sequence[str], strategy: str = SEASONAL,
    years: int = YEARS_BACK, pad_days: int = PAD_DAYS, min_rows: int = MIN_ROWS,
    fallback_to_trailing: bool = False, current_days: int = CURRENT_DAYS, method: str = DISTANCE, keys=KEYS, ts: str = TS,
) -> tuple[DataFrame, DataFrame]:
    """Reference choice per series, and both scores and verdicts per (series, feature).

    Every pair of windows is compared, however few rows it has; the rows are told beside
    it. The samples of a series are bounded by its windows (hours), so the ordered part runs
    per (series, feature) without buckets. Runs one job.
    """
    # The windows' rows, a small part of the history, feed several aggregations: written
    # once so that the feature build behind them runs once.
    tagged = through_table(
        tag_windows(inputs, windows, years, pad_days, current_days, keys, ts), "drift-windows"
    )
    chosen = choose_reference(
        tagged, strategy, years, pad_days, min_rows, fallback_to_trailing, current_days, keys, ts
    )
    usable = chosen.select(*keys, "reference_strategy")
    in_reference = F.when(F.col("reference_strategy") == SEASONAL, F.col("in_seasonal")).otherwise(
        F.col("in_trailing")
    )
    rows = tagged.join(usable, list(keys))
    # An hour may lie in both windows; it then counts in both samples.
    sides = F.explode(
        F.array_compact(
            F.array(F.when(F.col("in_current"), F.lit(True)), F.when(in_reference, F.lit(False)))
        )
    )
    samples = rows.withColumn("is_current", sides).unpivot(
        [*keys, "is_current"], list(columns), "feature", "value"
    )
    verdicts = drift_verdict(two_sample(samples, [*keys, "feature"], "value", buckets=None), method)
    return chosen, verdicts


def prediction_drift(
    log: DataFrame, windows: DataFrame, window_days: int = CURRENT_DAYS, method: str = DISTANCE, keys=KEYS
) -> DataFrame:
    """Did the served predictions move against the equal window before?

    Standing forecasts of both windows; the boundary hour belongs to both, as their ends
    are inclusive. False until both windows hold enough rows (``sufficient``). A window holds
    hours times horizons times versions, without a bound, so the ordered part is bucketed.
    """
    target = F.col("target_time")
    tagged = with_scalars(log, windows, keys).withColumns(
        {
            "_now": target.between(F.col("current_start"), F.col("current_end")),
            "_then": target.between(F.col("current_start") - days(window_days), F.col("current_start")),
        }
    )
    standing = tables.latest_per_target(tagged.filter("_now OR _then"))
    sides = F.explode(
        F.array_compact(F.array(F.when(F.col("_now"), F.lit(True)), F.when(F.col("_then"), F.lit(False))))
    )
    samples = standing.withColumn("is_current", sides).select(
        *keys, "is_current", F.lit("load_mw").alias("feature"), F.col("load_mw").alias("value")
    )
    verdicts = drift_verdict(two_sample(samples, [*keys, "feature"], "value"), method)
    enough = (F.col("n_current") >= MIN_WINDOW_ROWS) & (F.col("n_reference") >= MIN_WINDOW_ROWS)
    return verdicts.select(
        *keys, "n_current", "n_reference", enough.alias("sufficient"), P_VALUE, DISTANCE,
        (enough & F.coalesce(F.col("drifted"), F.lit(False))).alias("prediction_drift"),
    )


def check_drift(
    dataset: DataFrame, scored: DataFrame, log: DataFrame, horizon: int = 24, now=None,
    current_days: int = CURRENT_DAYS, strategy: str = SEASONAL, years: int = YEARS_BACK,
    pad_days: int = PAD_DAYS, min_rows: int = MIN_ROWS, fallback_to_trailing: bool = False,
    share_threshold: float = SHARE_THRESHOLD, min_scored: int = MIN_SCORED,
    mape_threshold: float = MAPE_THRESHOLD, method: str = DISTANCE, tz: str = DEFAULT_TZ, keys=KEYS, ts: str = TS,
) -> DataFrame:
    """One row per series: status, reason codes and texts, and the numbers behind them.

    ``now`` defaults to each series' newest stored hour. ``scored`` are standing scored
    predictions, ``log`` the prediction log. ``method`` names the drift score that decides.
    Numbers are always given; only the decisions ask whether enough rows stand behind them.

    Features are built for the windows only, from the hours that reach them. Runs jobs.
    """
    keys = list(keys)
    windows = through_table(current_windows(dataset, current_days, now, keys, ts), "check-windows")
    columns = monitored_columns(feature_names(horizon))
    reached = within_reach(
        dataset, windows, look_back_hours(horizon), strategy, years, pad_days, current_days, keys, ts
    )
    inputs = make_features(reached, horizon, tz=tz, keys=keys, ts=ts).select(*keys, ts, *columns)
    chosen, verdicts = input_drift(
        inputs, windows, columns, strategy, years, pad_days, min_rows, fallback_to_trailing, current_days, method, keys, ts
    )
    shares = drift_share(verdicts, keys).drop("monitored_features")
    served = with_scalars(scored, windows, keys).filter(
        F.col("target_time").between(F.col("current_start"), F.col("current_end"))
    )
    perf = performance(served, keys, min_scored, mape_threshold).select(
        *keys, F.col("scored").alias("scored_predictions"), "sufficient",
        F.col("model_mape").alias("rolling_mape"), "tso_mape", "breached",
    )
    moved = prediction_drift(log, windows, current_days, method, keys).select(*keys, "prediction_drift")
    everything = (
        windows.join(chosen.drop("current_start", "current_end"), keys, "left")
        .join(shares, keys, "left")
        .join(perf, keys, "left")
        .join(moved, keys, "left")
        .fillna({
            "current_rows": 0, "reference_rows": 0, "scored_predictions": 0, "drifted_features": 0,
            "sufficient": False, "breached": False, "prediction_drift": False,
        })
    )
    thin_current = F.col("current_rows") < MIN_WINDOW_ROWS
    thin_reference = F.col("reference_rows") < MIN_WINDOW_ROWS
    thin = thin_current | thin_reference
    data_drift = ~thin & F.coalesce(F.col("drift_share") >= share_threshold, F.lit(False))
    found = [
        (thin_current, "few_current", F.format_string(f"%d feature rows in the last {current_days} days", "current_rows")),
        (~thin_current & thin_reference, "few_reference", F.format_string("%d rows to compare with", "reference_rows")),
        (
            data_drift, "inputs",
            F.format_string(
                f"%d of {len(columns)} inputs moved (share %.2f, limit {share_threshold}), compared with the %s window",
                "drifted_features", "drift_share", "reference_strategy",
            ),
        ),
        (
            ~thin & F.col("breached"), "error",
            F.format_string(f"mean error %.3f%% (limit {mape_threshold}%%) in %d scored hours", "rolling_mape", "scored_predictions"),
        ),
        (~thin & ~F.col("sufficient"), "few_scored", F.format_string(f"%d scored hours, {min_scored} are needed", "scored_predictions")),
    ]
    codes = F.array_compact(F.array(*[F.when(c, n) for c, n, _ in found]))
    told = F.array_compact(F.array(*[F.when(c, t) for c, _, t in found]))
    status = F.when(thin, INSUFFICIENT).when(data_drift | F.col("breached"), DRIFT).otherwise(OK)
    return everything.select(
        *keys,
        F.col("current_end").alias("checked_at"),
        status.alias("status"),
        F.array_join(codes, " ").alias("reason_codes"),
        F.when(F.size(told) == 0, "within all limits").otherwise(F.array_join(told, "; ")).alias("reasons"),
        data_drift.alias("data_drift"),
        "drift_share", "drifted_features",
        F.lit(len(columns)).alias("monitored_features"),
        F.coalesce(F.array_join("drifted_names", " "), F.lit("")).alias("drifted_names"),
        (~thin & F.col("prediction_drift")).alias("prediction_drift"),
        "rolling_mape", "tso_mape", "scored_predictions",
        "reference_strategy", "reference_detail", "reference_rows", "current_rows",
    )


def record_check(checks: DataFrame, history_path: str, events_path: str | None = None, keys=KEYS) -> None:
    """Append the checks to the history, then raise a retrain flag per drifted series. Runs jobs.

    History first and always, so quiet checks are data points too. The checks are stored
    once, so that history and flags come from the same evaluation. Both keep the series.
    """
    checks = through_table(checks, "checks")
    tables.append_drift_history(checks, history_path)
    if events_path is not None:
        flags = checks.filter(F.col("status") == DRIFT).select(
            *keys, F.lit("retrain").alias("pipeline"), F.lit("raise").alias("event"),
            F.col("checked_at").alias("at"), F.col("reasons").alias("reason"),
        )
        done = checks.select(
            *keys, F.lit("check_drift").alias("pipeline"), F.lit("success").alias("event"),
            F.col("checked_at").alias("at"), F.lit(None).cast("string").alias("reason"),
        )
        tables.append(flags.unionByName(done), events_path, tables.EVENTS)
