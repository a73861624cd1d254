"""Two-sample comparison of numeric features: is the current sample like the reference?"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import through_table

# A p-value below its threshold or a distance at or above its threshold
# means drift.
P_VALUE_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1
MINIMUM_SPREAD = 0.001
P_VALUE, DISTANCE = "ks_p_value", "wasserstein_normed"
#: The exact p-value, and the choice by size: it up to so many reference values, the distance beyond.
EXACT, BY_SIZE, SIZE_LIMIT = "ks_p_exact", "by_size", 1000
#: Largest sample, and most cells of its grid, for which the exact value is computed; beyond, the asymptotic one is exact enough.
EXACT_SAMPLE, EXACT_CELLS = 10_000, 4_000_000

SERIES_TERMS = 100


def kolmogorov_p(statistic: Column, n_current: Column, n_reference: Column) -> Column:
    """Asymptotic two-sided p-value; ``kolmogorov_p_exact`` has that of small samples."""
    size = n_current * n_reference / (n_current + n_reference)
    lam2 = statistic * statistic * size
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2 * k * k * lam2),
    )
    tail = 2 * F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    # Below 0.2 the tail is 1 to ten digits while the alternating series converges badly.
    return F.when(lam2 < 0.04, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))


def path_p_value(n: int, m: int, gap: int) -> float:
    """P(D >= gap / (n m)) for two samples of n and m values in random order, without ties.

    An order of the values is a lattice path from (0, 0) to (n, m); it stays below the
    statistic if no point (i, j) on it has ``|i m - j n| >= gap``. Cell (i, j) holds the share of
    inner paths among all that lead there, scaled by ``i / (i + m)`` per row so that the last
    cell is a probability. The inner cells of a row are one stretch, and a running sum fills it.
    """
    if gap <= 0:
        return 1.0
    j = np.arange(m + 1)
    row = (j * n < gap).astype(float)  # i = 0: a straight edge until it leaves the band
    for i in range(1, n + 1):
        inner = np.abs(i * m - j * n) < gap
        row = np.where(inner, np.cumsum(np.where(inner, row * (i / (i + m)), 0.0)), 0.0)
    return float(min(1.0, max(0.0, 1.0 - row[m])))


def kolmogorov_p_exact(statistic: Column, n_current: Column, n_reference: Column) -> Column:
    """The exact two-sided p-value of small samples; null for large ones and for empty ones.

    With ties it is an upper bound, as the statistic then looks at fewer points.
    """

    @F.pandas_udf("double")
    def exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([path_p_value(int(b), int(a), round(x * a * b)) for x, a, b in zip(d, n, m)], dtype="float64")

    small = (n_current > 0) & (n_reference > 0) & (F.greatest(n_current, n_reference) <= EXACT_SAMPLE) & (n_current * n_reference <= EXACT_CELLS)
    # Groups that are too large get a grid of one cell, whose value is not used.
    size = lambda n: F.when(small, n).otherwise(1).cast("long")
    return F.when(small, exact(F.when(small, statistic).otherwise(0.0), size(n_current), size(n_reference)))


def _distinct_values(samples: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Counts per distinct value: duplicates merge on the map side, however many."""
    current = F.col("is_current").cast("int")
    return (
        samples.filter(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).alias("v"))
        .agg(F.sum(current).alias("c"), F.sum(1 - current).alias("r"))
    )


def _running_bounded(values: DataFrame, group: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*group).orderBy("v")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group)
    return values.select(
        *group, "v", F.lead("v").over(w).alias("v_next"),
        F.sum("c").over(upto).alias("cc"), F.sum("r").over(upto).alias("rr"),
        F.sum("c").over(whole).alias("n_c"), F.sum("r").over(whole).alias("n_r"),
    )


def _with_bucket(df: DataFrame, v: str, edges: str, buckets: int) -> DataFrame:
    """Add ``_b``, how many sorted edges lie below ``v``: a binary search, one step per
    projection so that the steps stay compiled instead of nesting into each other."""
    df, step = df.withColumn("_b", F.lit(0)), buckets // 2
    while step:
        hit = F.col(v) > F.get(edges, F.col("_b") + (step - 1))
        df = df.withColumn("_b", F.col("_b") + step * hit.cast("int"))
        step //= 2
    return df.drop(edges)


def _running_bucketed(values: DataFrame, group: Sequence[str], buckets: int) -> DataFrame:
    """The same running counts for samples of any size.

    Values are spread over quantile buckets (the sketch decides balance only, not the
    result); each bucket is ordered on its own and offset by the totals before it.
    """
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    probs = [i / buckets for i in range(1, buckets)]
    edges = values.groupBy(*group).agg(
        F.percentile_approx("v", probs, 1000).alias("_edges")
    )
    placed = _with_bucket(values.join(edges, list(group)), "v", "_edges", buckets)
    before = Window.partitionBy(*group).orderBy("_b")
    past = before.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    totals = (
        placed.groupBy(*group, "_b")
        .agg(F.sum("c").alias("_c"), F.sum("r").alias("_r"), F.min("v").alias("_lo"))
        .select(
            *group, "_b",
            F.coalesce(F.sum("_c").over(past), F.lit(0)).alias("_c0"),
            F.coalesce(F.sum("_r").over(past), F.lit(0)).alias("_r0"),
            F.sum("_c").over(whole).alias("n_c"),
            F.sum("_r").over(whole).alias("n_r"),
            F.lead("_lo").over(before).alias("_next_lo"),
        )
    )
    inside = Window.partitionBy(*group, "_b").orderBy("v")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_cc", F.sum("c").over(upto))
        .withColumn("_rr", F.sum("r").over(upto))
        .withColumn("_lead", F.lead("v").over(inside))
        .join(totals, [*group, "_b"], "left")  # totals has every bucket; it is the small side
        .select(
            *group, "v", F.coalesce("_lead", "_next_lo").alias("v_next"),
            (F.col("_c0") + F.col("_cc")).alias("cc"),
            (F.col("_r0") + F.col("_rr")).alias("rr"), "n_c", "n_r",
        )
    )


def two_sample(
    samples: DataFrame, group: Sequence[str] = ("feature",), value: str = "value",
    buckets: int | None = 64,
) -> DataFrame:
    """Kolmogorov-Smirnov and Wasserstein distance per group.

    ``samples`` is long: group columns, ``value`` and boolean ``is_current``. Both
    statistics are exact. ``buckets=None`` is for samples whose size is bounded by their
    windows (hours of one series); otherwise no task sees a whole group, and one job
    stores the distinct values.
    """
    values = _distinct_values(samples, group, value)
    if buckets is None:
        running = _running_bounded(values, group)
    else:
        # Read five times below: written once instead of recomputing the samples.
        values = through_table(values, "two-sample")
        running = _running_bucketed(values, group, buckets)
    gap = F.abs(F.try_divide("cc", "n_c") - F.try_divide("rr", "n_r"))
    step = F.coalesce(F.col("v_next") - F.col("v"), F.lit(0.0))
    v = F.col("v")
    weight = F.col("r")
    spread = values.groupBy(*group).agg(
        F.sum(weight).alias("_n"),
        F.sum(weight * v).alias("_s1"),
    )
    distance = running.groupBy(*group).agg(
        F.max("n_c").alias("n_current"),
        F.max("n_r").alias("n_reference"),
        F.max(gap).alias("ks"),
        F.sum(gap * step).alias("wasserstein"),
    )
    # Two-pass variance of the reference sample: numerically safe on large offsets.
    mean = spread.select(*group, (F.col("_s1") / F.nullif(F.col("_n"), F.lit(0))).alias("_mean"))
    deviation = (
        values.join(mean, list(group))
        .groupBy(*group)
        .agg((F.sum(weight * F.pow(v - F.col("_mean"), 2)) / F.nullif(F.sum(weight), F.lit(0))).alias("_var"))
    )
    return distance.join(deviation, list(group)).select(
        *group, "n_current", "n_reference", "ks", "wasserstein",
        F.sqrt("_var").alias("reference_std"),
    )


def drift_verdict(
    stats: DataFrame, method: str = DISTANCE,
    p_threshold: float = P_VALUE_THRESHOLD, distance_threshold: float = DISTANCE_THRESHOLD, size_limit: int = SIZE_LIMIT,
) -> DataFrame:
    """Both scores and both verdicts of every row; ``method`` says which one is ``drifted``.

    The method is the caller's. ``EXACT`` adds the column of the exact p-value, which then makes
    the p-value's verdict where there is one. ``BY_SIZE`` does so too and decides per group: by
    the p-value up to ``size_limit`` reference values, by the distance beyond; column ``method``
    says which. A p-value drifts low, a distance drifts high.
    """
    if method not in (P_VALUE, DISTANCE, EXACT, BY_SIZE):
        raise ValueError(f"method is one of {P_VALUE}, {DISTANCE}, {EXACT} and {BY_SIZE}, not {method!r}")
    ks, n, m = F.col("ks"), F.col("n_current"), F.col("n_reference")
    judged = stats.withColumns(
        {
            P_VALUE: kolmogorov_p(ks, n, m),
            DISTANCE: F.col("wasserstein") / F.greatest(F.col("reference_std"), F.lit(MINIMUM_SPREAD)),
        }
    )
    p = F.col(P_VALUE)
    if method in (EXACT, BY_SIZE):
        judged, p = judged.withColumn(EXACT, kolmogorov_p_exact(ks, n, m)), F.coalesce(EXACT, P_VALUE)
    by_p, by_distance = p < p_threshold, F.col(DISTANCE) >= distance_threshold
    own = F.lit(method)
    if method == BY_SIZE:
        own = F.when(m > size_limit, DISTANCE).otherwise(F.when(F.col(EXACT).isNull(), P_VALUE).otherwise(EXACT))
    return judged.withColumns(
        {
            "drifted_by_p_value": by_p, "drifted_by_distance": by_distance,
            "method": own, "drifted": F.when(own == DISTANCE, by_distance).otherwise(by_p),
        }
    )


def drift_share(verdicts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Drifted features, their count and share. Names are bounded by the feature count."""
    return verdicts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("monitored_features"),
        F.count_if("drifted").alias("drifted_features"),
        F.avg(F.col("drifted").cast("int")).alias("drift_share"),
        F.array_sort(
            F.collect_list(F.when(F.col("drifted"), F.col("feature")))
        ).alias("drifted_names"),
    )
