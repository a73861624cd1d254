"""Quantile regression: every (series, origin, quantile) fit in a fixed number of joint passes.

The pinball loss is bounded from above by a weighted square that touches it at the current
residuals; minimising that bound is weighted least squares, and repeating it never raises the
loss. Rows are packed once into blocks of some weeks per series. A pass joins the blocks with
their series' coefficients, turns each block into one small matrix per fit, and sums those: a
series of any length never meets in one task, and only matrices are shuffled. At the end the
intercept of each fit becomes the exact order statistic of its residuals, so a model without
columns is the sample quantile itself.

Predictions are put in order across quantiles (rearranged), so bands never cross.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import KEYS, TS
from ..functions.names import TARGET
from ..operators.latest import last_block_wins
from ..operators.splits import test_rows
from ..session import require_columns, through_table

BAND = (0.1, 0.5, 0.9)
#: Passes, and how the smoothing of the loss shrinks from one to the next (in mean residuals).
PASSES, SMOOTH, SHRINK = 16, 0.3, 0.6
#: Length of a packed block, and the first search width for the order statistic, in mean residuals.
BLOCK_DAYS, WIDTH = 60, 0.1
#: Parts of a counted window, and most residuals of one fit that are read.
PARTS, MOST_READ = 64, 10_000
_ALWAYS = float("inf")


def require_quantiles(quantiles: Sequence[float]) -> list[float]:
    wrong = [q for q in quantiles if not 0 < q < 1]
    if wrong or not quantiles or len(set(quantiles)) < len(quantiles):
        raise ValueError(f"quantiles must be distinct numbers between 0 and 1, got {list(quantiles)}")
    return sorted(float(q) for q in quantiles)


def packed_blocks(df: DataFrame, columns: Sequence[str], keys: Sequence[str], ts: str, target: str) -> DataFrame:
    """(keys, block, data): rows ``[seconds, 1, columns, target]`` as bytes, in time order; rows with
    a null or no number in any of them are left out."""
    keys, wide = list(keys), [*columns, target]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    seconds = F.col(ts).cast("timestamp").cast("double")
    rows = df.select(*keys, seconds.alias("_t"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(wide)])
    names = [f"_x{i}" for i in range(len(wide))]
    for n in names:
        rows = rows.filter(F.col(n).isNotNull() & ~F.isnan(n))
    rows = rows.withColumn("_block", F.floor(F.col("_t") / (BLOCK_DAYS * 86_400)))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_t", *names], kind="stable")
        m = np.column_stack([group["_t"], np.ones(len(group)), group[names]]).astype(float)
        out = group[[*keys, "_block"]].head(1).copy()
        out["data"] = [m.tobytes()]
        return out

    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "_block long, data binary"])
    return rows.groupBy(*keys, "_block").applyInPandas(pack, schema)


def _sums(rows: pd.DataFrame, keys: list[str], p: int, quantiles: list[float], step, tail: int) -> pd.DataFrame:
    """``step(x, y, q, beta, state)`` of every fit of every block in ``rows``, as (keys, fit_no, sums);
    ``state`` are the ``tail`` numbers behind the coefficients."""
    out = []
    nq, upto = len(quantiles), p + 3
    for row in rows.itertuples(index=False):
        m = np.frombuffer(row.data).reshape(-1, upto)
        held = {}
        if len(row.numbers):
            held = dict(zip(row.numbers, np.asarray(row.betas).reshape(len(row.numbers), p + 1 + tail)))
        for k, end in enumerate(row.ends):
            n = int(np.searchsorted(m[:, 0], end, side="right"))
            for j in range(nq) if n else ():
                state = held.get(k * nq + j)
                if held and state is None:
                    continue
                beta, state = (None, None) if state is None else (state[: p + 1], state[p + 1 :])
                out.append((*[getattr(row, c) for c in keys], k * nq + j, step(m[:n, 1:-1], m[:n, -1], quantiles[j], beta, state)))
    return pd.DataFrame(out, columns=[*keys, "fit_no", "sums"])


def _mapped(blocks: DataFrame, state: DataFrame, keys: list[str], p: int, quantiles: list[float], step, tail: int = 1) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "fit_no int, sums array<double>"])

    def partial(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), 16):
                yield _sums(rows.iloc[at : at + 16], keys, p, quantiles, step, tail)

    return blocks.join(state, keys).select(*keys, "data", "ends", "numbers", "betas").mapInPandas(partial, schema)


def _weighted(p: int, shrink: float):
    """Upper triangle of X'WX, then X'Wy, the column sums, the sum of |r| (first: of y squared) and the rows."""
    upper = np.triu_indices(p + 1)

    def step(x, y, q, beta, state):
        if beta is None:
            return np.concatenate([(x.T @ x)[upper], x.T @ y, x.sum(0), [y @ y, len(y)]])
        r = np.abs(y - x @ beta)
        w = 1 / (max(state[0] * shrink, 1e-12) + r)
        return np.concatenate([((x * w[:, None]).T @ x)[upper], x.T @ (w * y), x.sum(0), [r.sum(), len(y)]])

    return step


def _solver(p: int, quantiles: list[float], first: bool):
    """Coefficients of one fit and, last, its mean residual."""
    n_upper = (p + 1) * (p + 2) // 2

    def one(fit_no: int, v: np.ndarray) -> np.ndarray:
        q = 0.5 if first else quantiles[fit_no % len(quantiles)]
        g = np.zeros((p + 1, p + 1))
        g[np.triu_indices(p + 1)] = v[:n_upper]
        g = g + np.triu(g, 1).T
        right = v[n_upper : n_upper + p + 1] + (2 * q - 1) * v[n_upper + p + 1 : n_upper + 2 * p + 2]
        d = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
        beta = np.linalg.pinv(g / np.outer(d, d), rcond=1e-11, hermitian=True) @ (right / d) / d
        scale = np.sqrt(max(v[-2] - beta @ right, 0.0) / v[-1]) if first else v[-2] / v[-1]
        return np.append(beta, scale)

    @F.pandas_udf("array<double>")
    def solve(numbers: pd.Series, sums: pd.Series) -> pd.Series:
        return pd.Series([one(int(k), np.asarray(v)) for k, v in zip(numbers, sums)])

    return solve


def _gathered(fits: DataFrame, ends: DataFrame, keys: list[str], beta: str) -> DataFrame:
    """One row per key with its fits' numbers and coefficients in order, beside its ends."""
    ordered = F.array_sort(F.collect_list(F.struct("fit_no", F.col(beta).alias("b"))))
    per = fits.groupBy(*keys).agg(ordered.alias("_f"))
    return ends.join(per, keys).select(
        *keys, "ends", F.transform("_f", lambda f: f["fit_no"]).alias("numbers"), F.flatten(F.transform("_f", lambda f: f["b"])).alias("betas")
    )


def _window_counts(x, y, q, beta, state):
    """Residuals below the window, all of them, and those in each of its equal parts."""
    r, (low, high) = y - x @ beta, state
    inside = r[(r >= low) & (r < high)]
    parts = np.minimum(((inside - low) * (PARTS / (high - low))).astype(int), PARTS - 1)
    return np.concatenate([[(r < low).sum(), len(r)], np.bincount(parts, minlength=PARTS)])


def _narrowed(count: np.ndarray, rank: float, low: float, high: float) -> tuple[float, float, bool]:
    """The next window around the residual of that rank, and whether it is small enough to be read."""
    below, inside, size = count[0], count[2:], high - low
    if rank <= below:
        return low - 4 * size, low, False
    if rank > below + inside.sum():
        return high, high + 4 * size, False
    if inside.sum() <= MOST_READ or size <= 1e-12 * max(abs(low), abs(high), 1.0):
        return low, high, True
    k = int(np.searchsorted(below + np.cumsum(inside), rank))
    # A little wider than the part, so that rounding at its edges loses nothing.
    edge = size / PARTS
    return max(low, low + (k - 0.01) * edge), min(high, low + (k + 1.01) * edge), False


def _exact_intercepts(blocks: DataFrame, ends: DataFrame, fits: DataFrame, keys: list[str], p: int, quantiles: list[float]) -> DataFrame:
    """``fits`` with each intercept moved to the residuals' order statistic number ceil(q n).

    A window around the current intercept is counted in parts and moved or narrowed until it
    holds the statistic and few residuals; only those are read, equal ones as one.
    """
    fit = [*keys, "fit_no"]
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    shapes = [f"{k} {kinds[k]}" for k in keys]
    q_of = F.element_at(F.array(*[F.lit(x) for x in quantiles]), F.col("fit_no") % len(quantiles) + 1)
    # A product like 0.1 x 30 may come out a hair above the whole number.
    rank = F.greatest(F.ceil(q_of * F.col("n") - 1e-9), F.lit(1)).cast("double")

    @F.pandas_udf("low double, high double, ready boolean")
    def narrow(counts: pd.Series, ranks: pd.Series, low: pd.Series, high: pd.Series) -> pd.DataFrame:
        found = [_narrowed(np.asarray(c), r, a, b) for c, r, a, b in zip(counts, ranks, low, high)]
        return pd.DataFrame(found, columns=["low", "high", "ready"])

    def window(df: DataFrame) -> DataFrame:
        """The state of a pass over fits whose last two numbers are a window."""
        packed = df.select(*fit, F.concat(F.slice("beta", 1, p + 1), F.array("low", "high")).alias("b"))
        return through_table(_gathered(packed, ends, keys, "b"), "quantile-windows")

    reach = F.greatest(F.col("beta")[p + 1] * WIDTH, F.lit(1e-12))
    todo, settled = fits.withColumn("low", -reach).withColumn("high", reach), None
    while True:
        parts = _mapped(blocks, window(todo), keys, p, quantiles, _window_counts, tail=2)
        summed = parts.groupBy(*fit).agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("c"))
        moved = todo.join(summed, fit).withColumn("n", F.col("c")[1]).withColumn("rank", rank)
        moved = moved.withColumn("w", narrow("c", "rank", "low", "high")).select(*fit, "beta", "rank", F.col("c")[0].alias("below"), "w.*")
        moved = through_table(moved, "quantile-narrowed")
        now = moved.filter("ready")
        settled = now if settled is None else settled.unionByName(now)
        todo = moved.filter("NOT ready").select(*fit, "beta", "low", "high")
        if todo.isEmpty():
            break

    def inside(x, y, q, beta, state):
        r = y - x @ beta
        return np.stack(np.unique(r[(r >= state[0]) & (r < state[1])], return_counts=True), axis=1).ravel()

    read = _mapped(blocks, window(settled), keys, p, quantiles, inside, tail=2)
    pairs = F.transform(F.sequence(F.lit(0), (F.size("sums") / 2).cast("int") - 1), lambda i: F.struct(F.get("sums", (2 * i).cast("int")).alias("r"), F.get("sums", (2 * i + 1).cast("int")).alias("k")))
    values = read.filter(F.size("sums") > 0).select(*fit, F.inline(pairs)).groupBy(*fit, "r").agg(F.sum("k").alias("k"))
    upto = F.sum("k").over(Window.partitionBy(*fit).orderBy("r"))
    ranked = values.join(settled.select(*fit, "rank", "below"), fit).withColumn("upto", F.col("below") + upto)
    shift = ranked.filter("upto >= rank").groupBy(*fit).agg(F.min("r").alias("shift"))
    moved = fits.join(shift, fit)
    return moved.select(*fit, F.concat(F.array(F.col("beta")[0] + F.col("shift")), F.slice("beta", 2, p + 1)).alias("beta"))


def _fit(blocks: DataFrame, ends: DataFrame, columns: Sequence[str], quantiles: list[float], keys: list[str], passes: int) -> DataFrame:
    """(keys, fit_no, beta): all fits; ``ends`` has one end of training per origin in ``ends``."""
    p = len(columns)
    empty = F.array().cast("array<int>").alias("numbers"), F.array().cast("array<double>").alias("betas")
    state, fits = ends.select(*keys, "ends", *empty), None
    # Without columns the intercept is all there is, and it is found exactly from anywhere.
    for k in range(passes + 1 if p else 1):
        step = _weighted(p, SMOOTH * SHRINK ** max(k - 1, 0))
        parts = _mapped(blocks, state, keys, p, quantiles, step)
        summed = parts.groupBy(*keys, "fit_no").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
        fits = through_table(summed.select(*keys, "fit_no", _solver(p, quantiles, k == 0)("fit_no", "sums").alias("beta")), "quantile-fits")
        state = through_table(_gathered(fits, ends, keys, "beta"), "quantile-state")
    return _exact_intercepts(blocks, ends, fits, keys, p, quantiles)


def fit_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = BAND, group: Sequence[str] = KEYS, target: str = TARGET,
    ts: str = TS, passes: int = PASSES,
) -> DataFrame:
    """(group, quantile, coefficients): linear quantile regression per group, intercept first. Runs jobs.

    Without columns the one coefficient is the sample quantile, the value number ceil(q n).
    """
    quantiles, keys = require_quantiles(quantiles), list(group)
    require_columns(df, [*keys, *columns, target, ts])
    blocks = through_table(packed_blocks(df, columns, keys, ts, target), "quantile-blocks")
    ends = blocks.select(*keys).distinct().withColumn("ends", F.array(F.lit(_ALWAYS)))
    fits = _fit(blocks, ends, columns, quantiles, keys, passes)
    return fits.select(*keys, _quantile(quantiles).alias("quantile"), F.slice("beta", 1, len(columns) + 1).alias("coefficients"))


def _quantile(quantiles: list[float]):
    return F.element_at(F.array(*[F.lit(q) for q in quantiles]), F.col("fit_no") % len(quantiles) + 1)


def band_of(rows: DataFrame, fits: DataFrame, columns: Sequence[str], on: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep, quantile, y_pred): ``fits`` applied to the rows, rearranged so that no band crosses."""
    on = list(on)
    gathered = F.array_sort(F.collect_list(F.struct("quantile", "coefficients")))
    wide = rows.join(fits.groupBy(*on).agg(gathered.alias("_fits")), on)
    x = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in columns])

    def value(fit):
        return F.aggregate(F.zip_with(fit["coefficients"], x, lambda b, v: b * v), F.lit(0.0), lambda a, b: a + b)

    values = wide.select(*keep, F.transform("_fits", lambda f: f["quantile"]).alias("_q"), F.array_sort(F.transform("_fits", value)).alias("_v"))
    return values.select(*keep, F.explode(F.arrays_zip("_q", "_v")).alias("_b")).select(
        *keep, F.col("_b._q").alias("quantile"), F.col("_b._v").alias("y_pred")
    )


def band_by_origin(
    features: DataFrame, splits: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = BAND, keys: Sequence[str] = KEYS,
    ts: str = TS, target: str = TARGET, passes: int = PASSES,
) -> DataFrame:
    """(keys, ts, quantile, y_true, y_pred): each origin's band on its test rows. Runs jobs.

    Every quantile of every origin of every series is fitted on that origin's training rows in
    joint passes. An hour that several origins test keeps the last one's band.
    """
    quantiles, keys = require_quantiles(quantiles), list(keys)
    blocks = through_table(packed_blocks(features, columns, keys, ts, target), "quantile-blocks")
    ordered = F.array_sort(F.collect_list(F.struct("origin_no", F.col("train_end").cast("timestamp").cast("double").alias("e"))))
    schedule = splits.groupBy(*keys).agg(ordered.alias("_o"))
    schedule = through_table(schedule.select(*keys, F.transform("_o", lambda o: o["e"]).alias("ends"), F.transform("_o", lambda o: o["origin_no"]).alias("origins")), "quantile-origins")
    fits = _fit(blocks, schedule.select(*keys, "ends"), columns, quantiles, keys, passes).join(schedule.select(*keys, "origins"), keys)
    number = F.get("origins", F.floor(F.col("fit_no") / len(quantiles)).cast("int"))
    fits = fits.select(*keys, number.alias("origin_no"), _quantile(quantiles).alias("quantile"), F.slice("beta", 1, len(columns) + 1).alias("coefficients"))
    tested = test_rows(features, splits.select(*keys, "origin_no", "test_start", "test_end"), keys, ts)
    tested = tested.select(*keys, ts, "origin_no", *columns, F.col(target).alias("y_true"))
    rows = band_of(tested, fits, columns, [*keys, "origin_no"], [*keys, ts, "origin_no", "y_true"])
    return last_block_wins(rows, "y_pred", "origin_no", [*keys, ts, "quantile", "y_true"]).select(*keys, ts, "quantile", "y_true", "y_pred")
