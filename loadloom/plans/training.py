"""The training job: variants and references on one split, a band, and one run row each."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import DEFAULT_TZ, KEYS, TS
from ..functions.errors import ape, pinball
from ..functions.names import TARGET, feature_columns
from ..operators.scores import CALENDAR_TREES, TUNED_TREES, WEATHER_TREES
from ..session import through_table
from . import models

METRICS = ("mape", "rmse_mw", "mae_mw", "bias_mw")


@dataclass(frozen=True)
class Training:
    """Fitted variants by name, their run rows, and one candidate row each for the gate."""

    champions: dict[str, models.Champion]
    runs: DataFrame
    candidates: DataFrame

    def by_version(self, version: str) -> models.Champion:
        return next(c for c in self.champions.values() if c.version == version)


def next_version(runs: DataFrame, model_name: str) -> int:
    """One more than the largest version number of the model; 1 without any. Runs a job."""
    number = F.expr("try_cast(version AS bigint)")
    return (runs.filter(F.col("model_name") == model_name).agg(F.max(number)).first()[0] or 0) + 1


def band_pinball(
    scored: DataFrame, quantiles: Sequence[float] = models.BAND, tz: str = DEFAULT_TZ, keys: Sequence[str] = KEYS, ts: str = TS
) -> dict[str, float]:
    """Pinball loss per quantile on the later half of a block, with offsets of its earlier half."""
    middle = scored.agg(((F.min(F.unix_seconds(ts)) + F.max(F.unix_seconds(ts))) / 2).cast("long")).first()[0]
    if middle is None:
        return {}
    middle = F.timestamp_seconds(F.lit(middle))
    offsets = models.conformal_offsets(scored.filter(F.col(ts) < middle), quantiles, keys, tz, ts)
    banded = models.with_band(scored.filter(F.col(ts) >= middle), offsets, quantiles, keys, tz, ts)
    names = {q: f"p{round(q * 100)}" for q in quantiles}
    row = banded.agg(*[F.avg(pinball(TARGET, n, q)).alias(f"pinball_{n}") for q, n in names.items()]).first()
    return {k: v for k, v in row.asDict().items() if v is not None}


def train(
    labelled: DataFrame, names: Sequence[str], references: DataFrame, runs: DataFrame, model_name: str, horizon: int = 24,
    params: dict | None = None, grid: dict[str, Sequence] | None = None, variants: Sequence[str] = (CALENDAR_TREES, WEATHER_TREES),
    dataset_version: str | None = None, data_source: str = "ingested", started_at=None, tz: str = DEFAULT_TZ,
    seed: int = models.SEED, keys: Sequence[str] = KEYS, ts: str = TS,
) -> Training:
    """Fit every variant, score it beside the references, give it a band, a run and a version. Runs jobs.

    ``labelled`` has a ``block`` column (train, embargo, validation) and is a stored table;
    ``references`` has ``naive_seasonal`` and ``day_ahead_reference`` per hour. With a
    ``grid`` the weather variant is also tuned. Versions go on from those in ``runs``.
    The offsets that a champion serves come from the whole validation block.
    """
    spark = labelled.sparkSession
    fit, later = labelled.filter("block = 'train'"), labelled.filter("block = 'validation'")
    compared = through_table(later.join(references, [*keys, ts], "left"), "validation")
    wanted: dict[str, tuple[list[str], dict | None]] = {}
    if CALENDAR_TREES in variants:
        wanted[CALENDAR_TREES] = (feature_columns(names, include_weather=False), params)
    if WEATHER_TREES in variants:
        wanted[WEATHER_TREES] = (list(names), params)
    if grid:
        wanted[TUNED_TREES] = (list(names), models.tune(fit, later, names, grid, seed=seed)[0])
    champions, records, candidates = {}, [], []
    version = next_version(runs, model_name)
    for number, (variant, (columns, chosen)) in enumerate(wanted.items(), version):
        run_id = uuid.uuid4().hex
        fitted = models.fit_trees(
            fit, later, columns, params=chosen, seed=seed, horizon=horizon, name=model_name, version=str(number),
            run_id=run_id, dataset_version=dataset_version,
        )
        scored = through_table(
            fitted.predict(compared).select(*keys, ts, TARGET, models.PREDICTION, "naive_seasonal", "day_ahead_reference"), "scored"
        )
        error = F.col(models.PREDICTION) - F.col(TARGET)
        row = scored.agg(
            (F.avg(ape(TARGET, models.PREDICTION)) * 100).alias("mape"), F.sqrt(F.avg(error * error)).alias("rmse_mw"),
            F.avg(F.abs(error)).alias("mae_mw"), F.avg(error).alias("bias_mw"),
            (F.avg(ape(TARGET, "naive_seasonal")) * 100).alias("naive_mape"),
            (F.avg(ape(TARGET, "day_ahead_reference")) * 100).alias("reference_mape"),
        ).first().asDict()
        metrics = {k: v for k, v in row.items() if v is not None} | band_pinball(scored, tz=tz, keys=keys, ts=ts)
        offsets = through_table(models.conformal_offsets(scored, by=keys, tz=tz, ts=ts), "offsets")
        champions[variant] = replace(fitted, offsets=offsets)
        records.append(
            models.run_record(
                spark, variant, horizon, dataset_version, columns, data_source, fitted.params, metrics, started_at, run_id,
                model_name=model_name, version=str(number),
            )
        )
        candidates.append((model_name, str(number), run_id, row["mape"], row["naive_mape"]))
    table = records[0]
    for record in records[1:]:
        table = table.unionByName(record)
    gate = spark.createDataFrame(candidates, "model_name string, version string, run_id string, candidate double, naive double")
    return Training(champions, table, gate)
