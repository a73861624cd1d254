"""Station readings to one weighted value per series and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import KEYS, TS
from ..functions.scalars import clip
from .align import with_scalars


def normalise_weights(weights: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rescale weights to sum to one (per key); a total that is not positive is an error."""
    total = F.sum("weight").over(Window.partitionBy(*keys))
    checked = F.when(total > 0, F.col("weight") / total).otherwise(
        F.raise_error(F.lit("station weights must sum to a positive number")).cast("double")
    )
    return weights.withColumn("weight", checked)


def unknown_stations(readings: DataFrame, weights: DataFrame) -> DataFrame:
    """Stations without a configured weight; must be empty in strict mode."""
    return readings.select("station").distinct().join(weights, "station", "left_anti")


def weighted_mean(
    readings: DataFrame, weights: DataFrame, values: Sequence[str],
    keys: Sequence[str] = KEYS, ts: str = TS, strict: bool = False,
) -> DataFrame:
    """Weighted mean over the stations that reported, null where none did.

    Runs a job on the weights. Weights are renormalised per hour and column by dividing by the weight present; the
    result is clipped to the reported range to remove float residue. ``strict`` turns a
    station without weight into a runtime error, otherwise it takes no part.
    """
    # A handful of stations by configuration: broadcast after a count, so that the readings
    # are not shuffled on so few keys.
    joined = with_scalars(readings, weights.select("station", "weight"), ["station"], "left")
    if strict:
        joined = joined.withColumn(
            "weight",
            F.coalesce(
                "weight",
                F.raise_error(F.concat(F.lit("no weight for station "), "station")).cast("double"),
            ),
        )
    aggs = []
    for v in values:
        seen = F.when(F.col(v).isNotNull(), F.col("weight"))
        aggs += [
            F.sum(F.col(v) * F.col("weight")).alias(f"_s_{v}"),
            F.sum(seen).alias(f"_w_{v}"),
            F.min(F.when(F.col("weight").isNotNull(), F.col(v))).alias(f"_lo_{v}"),
            F.max(F.when(F.col("weight").isNotNull(), F.col(v))).alias(f"_hi_{v}"),
        ]
    grouped = joined.groupBy(*keys, ts).agg(*aggs)
    return grouped.select(
        *keys, ts,
        *[
            clip(
                F.when(F.col(f"_w_{v}") > 0, F.col(f"_s_{v}") / F.nullif(F.col(f"_w_{v}"), F.lit(0.0))),
                f"_lo_{v}",
                f"_hi_{v}",
            ).alias(v)
            for v in values
        ],
    )
