"""Forecast-error expressions.

Metrics are kept as sums until the last step, so that any grouping (per model, per
segment, per hour of day) is one hash aggregation whose partial results can be merged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clock import col

METRICS = ("mape", "rmse_mw", "mae_mw", "bias_mw")
SUM_COLUMNS = ("n", "n_scored", "n_ape", "s_ape", "s_sq", "s_abs", "s_err")


def ape(y_true, y_pred) -> Column:
    """|(t - p) / t|, null where the actual is zero or either side is missing."""
    t, p = col(y_true), col(y_pred)
    return F.abs((t - p) / F.nullif(t, F.lit(0.0)))


def signed_ape(y_true, y_pred) -> Column:
    """|p - t| / t: the stored score keeps the sign of the actual in the denominator."""
    t, p = col(y_true), col(y_pred)
    return F.abs(p - t) / F.nullif(t, F.lit(0.0))


def pinball(y_true, y_pred, quantile) -> Column:
    if not isinstance(quantile, Column):
        if not 0 < quantile < 1:
            raise ValueError(f"no quantile: {quantile}")
        quantile = F.lit(float(quantile))
    error = col(y_true) - col(y_pred)
    return F.greatest(quantile * error, (quantile - 1) * error)


def error_sums(y_true="y_true", y_pred="y_pred") -> list[Column]:
    """The mergeable sums behind the four metrics. ``n`` counts rows before nulls drop."""
    t, p = col(y_true), col(y_pred)
    e = p - t
    a = ape(t, p)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(e).alias("n_scored"),
        F.count(a).alias("n_ape"),
        F.sum(a).alias("s_ape"),
        F.sum(e * e).alias("s_sq"),
        F.sum(F.abs(e)).alias("s_abs"),
        F.sum(e).alias("s_err"),
    ]


def merge_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in SUM_COLUMNS]


def metrics_from_sums() -> dict[str, Column]:
    n = F.nullif(F.col("n_scored"), F.lit(0))
    return {
        "mape": F.col("s_ape") / F.nullif(F.col("n_ape"), F.lit(0)) * 100,
        "rmse_mw": F.sqrt(F.col("s_sq") / n),
        "mae_mw": F.col("s_abs") / n,
        "bias_mw": F.col("s_err") / n,
    }
