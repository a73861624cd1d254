"""Model jobs: linear reference, boosted trees, conformal band, search, run records."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import DEFAULT_TZ, KEYS, TS
from ..functions.clock import local_time
from ..functions.errors import ape
from ..functions.names import TARGET, feature_columns, feature_set_id
from ..session import require_columns

# Learner defaults and the quantile band.
TREE_DEFAULTS = {"maxIter": 60, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.9, "minInstancesPerNode": 5}
SEED = 42
BAND = (0.1, 0.5, 0.9)
PREDICTION = "prediction"


@dataclass(frozen=True)
class Champion:
    """A fitted model with the exact columns it expects, in order."""

    model: PipelineModel
    columns: list[str]
    horizon: int = 24
    name: str = "load_trees"
    version: str = "1"
    run_id: str | None = None
    dataset_version: str | None = None
    params: dict = field(default_factory=dict)
    #: Residual quantiles per series and local hour (``conformal_offsets``): the served band.
    offsets: DataFrame | None = None

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; a missing model column is an error, extra ones pass through."""
        require_columns(df, self.columns, "feature frame")
        return self.model.transform(df).drop("_features")


def _assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="_features")


def fit_linear(train: DataFrame, columns: Sequence[str], target: str = TARGET) -> Champion:
    """One least-squares model over all rows, solved from distributed normal equations."""
    used = feature_columns(columns, include_lags=False)
    learner = LinearRegression(featuresCol="_features", labelCol=target, predictionCol=PREDICTION, solver="normal")
    return Champion(Pipeline(stages=[_assembler(used), learner]).fit(train), used, name="linear_calendar_weather")


def fit_trees(
    train: DataFrame, validation: DataFrame, columns: Sequence[str], target: str = TARGET,
    params: dict | None = None, seed: int = SEED, **meta,
) -> Champion:
    """Boosted trees, stopped early on the *later* block, seeded.

    Both blocks travel as one frame with an indicator column; nothing is sampled.
    """
    columns = list(columns)
    chosen = {**TREE_DEFAULTS, **(params or {})}
    learner = GBTRegressor(
        featuresCol="_features", labelCol=target, predictionCol=PREDICTION,
        validationIndicatorCol="_later", seed=seed, **chosen,
    )
    wanted = [*columns, target]
    both = train.select(*wanted, F.lit(False).alias("_later")).unionByName(
        validation.select(*wanted, F.lit(True).alias("_later"))
    )
    fitted = Pipeline(stages=[_assembler(columns), learner]).fit(both)
    return Champion(fitted, columns, params=chosen, **meta)


def feature_importance(spark, champion: Champion) -> DataFrame:
    """Importance per model column; order by ``gain`` descending at the sink.

    The importance vector has one entry per feature, so it is a driver-side value.
    """
    gains = champion.model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(c, float(g)) for c, g in zip(champion.columns, gains)], "feature string, gain double"
    )


def tune(
    train: DataFrame, validation: DataFrame, columns: Sequence[str], grid: dict[str, Sequence],
    target: str = TARGET, seed: int = SEED,
) -> tuple[dict, list[tuple[dict, float]]]:
    """Try every grid point on the chronological block; best parameters and all scores.

    The loop is over parameter maps, each fit and each score a distributed job.
    """
    trials = []
    for values in product(*grid.values()):
        params = dict(zip(grid.keys(), values))
        model = fit_trees(train, validation, columns, target, params, seed)
        error = model.predict(validation).agg((F.avg(ape(target, PREDICTION)) * 100).alias("m")).first()["m"]
        trials.append((params, error))
    best = min(trials, key=lambda t: float("inf") if t[1] is None else t[1])
    return best[0], trials


def conformal_offsets(
    residuals: DataFrame, quantiles: Sequence[float] = BAND, by: Sequence[str] = KEYS,
    tz: str = DEFAULT_TZ, ts: str = TS, y_true: str = TARGET, y_pred: str = PREDICTION,
) -> DataFrame:
    """Residual quantiles of the validation block per key and local hour.

    The exact percentile keeps one count per distinct residual; a group holds one residual
    per validation day.
    """
    e = F.col(y_true) - F.col(y_pred)
    return (
        residuals.withColumn("local_hour", F.hour(local_time(ts, tz)))
        .groupBy(*by, "local_hour")
        .agg(F.percentile(e, F.array(*[F.lit(float(q)) for q in quantiles])).alias("_q"))
        .select(*by, "local_hour", *[F.col("_q")[i].alias(f"q{round(q * 100)}") for i, q in enumerate(quantiles)])
    )


def with_band(
    predicted: DataFrame, offsets: DataFrame, quantiles: Sequence[float] = BAND, by: Sequence[str] = KEYS,
    tz: str = DEFAULT_TZ, ts: str = TS, y_pred: str = PREDICTION,
) -> DataFrame:
    """Point forecast plus its hour's residual quantiles: an ordered band by construction."""
    joined = predicted.withColumn("local_hour", F.hour(local_time(ts, tz))).join(
        offsets, [*by, "local_hour"], "left"
    )
    names = [f"q{round(q * 100)}" for q in quantiles]
    return joined.withColumns(
        {f"p{n[1:]}": F.col(y_pred) + F.col(n) for n in names}
    ).drop("local_hour", *names)


# --- many independent least-squares fits in one job ------------------------------------


def grouped_gram(df: DataFrame, columns: Sequence[str], group: Sequence[str], target: str = TARGET) -> DataFrame:
    """Upper triangle of ``[1 X y]' [1 X y]`` per group, as one array ``gram``.

    Tasks turn each Arrow batch into small partial matrices and only those are shuffled and
    summed, so a group of any size never meets in one place.
    """
    group, columns = list(group), list(columns)
    wide = [*columns, target]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    upper = np.triu_indices(len(wide) + 1)

    def partial(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            keys, grams = [], []
            for key, rows in batch.groupby(group, sort=False, dropna=False):
                m = np.column_stack([np.ones(len(rows)), rows[wide].to_numpy(dtype=float)])
                keys.append(key)
                grams.append((m.T @ m)[upper])
            if keys:
                out = pd.DataFrame(keys, columns=group)
                out["gram"] = grams
                yield out

    schema = ", ".join([*[f"{g} {kinds[g]}" for g in group], "gram array<double>"])
    parts = df.select(*group, *[F.col(c).cast("double").alias(c) for c in wide]).mapInPandas(partial, schema)
    summed = Summarizer.sum(array_to_vector("gram"))
    return parts.groupBy(*group).agg(vector_to_array(summed).alias("gram"))


def _solve(flat: np.ndarray, p: int) -> np.ndarray:
    """Intercept and slopes of one packed matrix; columns without spread get no weight."""
    m = np.zeros((p + 2, p + 2))
    m[np.triu_indices(p + 2)] = flat
    m = m + np.triu(m, 1).T
    n, sums = m[0, 0], m[0, 1:]
    if n < 1:
        return np.full(p + 1, np.nan)
    centred = m[1:, 1:] - np.outer(sums, sums) / n
    spread = np.diag(centred)[:p]
    live = spread > 1e-9 * np.abs(np.diag(m)[1 : p + 1])
    scale = np.sqrt(np.where(live, spread, 1.0))
    a = centred[:p, :p] / np.outer(scale, scale) * np.outer(live, live)
    right = np.where(live, centred[:p, p] / scale, 0.0)
    beta = np.linalg.pinv(a, rcond=1e-10, hermitian=True) @ right / scale
    return np.concatenate([[(sums[p] - beta @ sums[:p]) / n], beta])


def solve_gram(gram: DataFrame, columns: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Coefficients per group: intercept first, then one per column, as an array.

    The matrix of a group has a fixed size of (columns + 2) squared, whatever its rows.
    """
    p = len(columns)

    @F.pandas_udf("array<double>")
    def solve(grams: pd.Series) -> pd.Series:
        return grams.map(lambda flat: _solve(np.asarray(flat), p))

    return gram.select(*group, solve("gram").alias("coefficients"))


def solve_expanding(gram: DataFrame, columns: Sequence[str], keys: Sequence[str], steps: DataFrame) -> DataFrame:
    """Coefficients per key and ``origin_no`` over all steps up to that origin.

    Each row of data entered one step only; the window of origin k is the sum of steps 1
    to k, so growing histories are not read again per origin. ``steps`` gives ``n_origins``
    per key (few), which bounds what is gathered per key: one matrix per origin.
    """
    p = len(columns)
    keys = list(keys)
    ordered = F.array_sort(F.collect_list(F.struct("origin_no", "gram")))
    packed = (
        gram.groupBy(*keys)
        .agg(ordered.alias("_s"))
        .join(steps, [c for c in steps.columns if c in keys])
        .select(
            *keys, "n_origins",
            F.transform("_s", lambda x: x["origin_no"]).alias("_k"),
            F.flatten(F.transform("_s", lambda x: x["gram"])).alias("_g"),
        )
    )

    @F.pandas_udf("array<double>")
    def solve(numbers: pd.Series, grams: pd.Series, counts: pd.Series) -> pd.Series:
        def one(at, flat, count):
            blocks = np.zeros((int(count), (p + 2) * (p + 3) // 2))
            blocks[np.asarray(at, dtype=int) - 1] = np.asarray(flat).reshape(len(at), -1)
            return np.concatenate([_solve(g, p) for g in blocks.cumsum(axis=0)])

        return pd.Series([one(*row) for row in zip(numbers, grams, counts)])

    solved = packed.select(*keys, "n_origins", solve("_k", "_g", "n_origins").alias("_c"))
    return (
        solved.select(*keys, "_c", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_origins"))).alias("origin_no"))
        .select(
            *keys, "origin_no",
            F.slice("_c", (F.col("origin_no") - 1).cast("int") * (p + 1) + 1, p + 1).alias("coefficients"),
        )
        .filter(~F.isnan(F.element_at("coefficients", 1)))
    )


def apply_linear(df: DataFrame, columns: Sequence[str], out: str = PREDICTION):
    """Prediction from a ``coefficients`` array already joined onto the rows."""
    y = F.element_at("coefficients", 1)
    for k, c in enumerate(columns, start=2):
        y = y + F.element_at("coefficients", k) * F.col(c)
    return df.withColumn(out, y).drop("coefficients")


def fit_linear_groups(df: DataFrame, columns: Sequence[str], group: Sequence[str] = KEYS, target: str = TARGET) -> DataFrame:
    """Independent least squares for every group (series, horizon, ...) in one job."""
    return solve_gram(grouped_gram(df, columns, group, target), columns, group)


# --- run records ----------------------------------------------------------------------


def run_record(
    spark, name: str, horizon: int, dataset_version: str, columns: Sequence[str], data_source: str,
    params: dict, metrics: dict[str, float], started_at=None, run_id: str | None = None,
    tags: dict[str, str] | None = None, model_name: str | None = None, version: str | None = None,
) -> DataFrame:
    """One row for the runs table: what was trained, on which data, with which columns."""
    text = {k: v if isinstance(v, str) else json.dumps(v) for k, v in params.items() if v is not None}
    row = spark.createDataFrame(
        [
            (
                run_id or uuid.uuid4().hex,
                f"{name}_synthetic" if data_source == "synthetic" else name,
                int(horizon), dataset_version, feature_set_id(columns), data_source, text,
                {k: float(v) for k, v in metrics.items()},
                {"horizon": str(horizon), "n_features": str(len(list(columns))), **(tags or {})}, model_name or name, version,
            )
        ],
        "run_id string, name string, horizon int, dataset_version string, feature_set string, "
        "data_source string, params map<string,string>, metrics map<string,double>, tags map<string,string>, "
        "model_name string, version string",
    )
    at = F.current_timestamp() if started_at is None else F.lit(started_at).cast("timestamp")
    return row.withColumn("started_at", at)
