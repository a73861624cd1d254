"""The exact two-sample p-value: all orders, the asymptotic value, ties, sizes and the method that decides."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from loadloom.operators import twosample
from loadloom.operators.twosample import BY_SIZE, DISTANCE, EXACT, P_VALUE, path_p_value


def gap_of(chosen, n, m):
    i = j = worst = 0
    for k in range(n + m):
        i, j = (i + 1, j) if k in chosen else (i, j + 1)
        worst = max(worst, abs(i * m - j * n))
    return worst


@pytest.mark.parametrize("n", range(1, 7))
@pytest.mark.parametrize("m", [1, 2, 3, 5, 8])
def test_equals_the_count_of_all_orders(n, m):
    gaps = [gap_of(set(c), n, m) for c in combinations(range(n + m), n)]
    for gap in {0, 1, *gaps, n * m}:
        assert path_p_value(n, m, gap) == pytest.approx(sum(g >= gap for g in gaps) / len(gaps), abs=1e-12)


def test_exact_and_asymptotic_values_meet_in_large_samples(spark):
    rows = [(1500, 2000, 0.03), (1900, 1900, 0.05), (60, 60, 0.25), (12_000, 10, 0.5), (0, 5, None), (8, 8, 0.0)]
    df = spark.createDataFrame(rows, "n long, m long, d double")
    got = df.select("n", twosample.kolmogorov_p_exact(F.col("d"), F.col("n"), F.col("m")).alias("e"), twosample.kolmogorov_p(F.col("d"), F.col("n"), F.col("m")).alias("a")).collect()
    by = {r.n: (r.e, r.a) for r in got}
    assert abs(by[1500][0] - by[1500][1]) < 0.02 and abs(by[1900][0] - by[1900][1]) < 0.01
    assert by[60][0] == pytest.approx(path_p_value(60, 60, 900)) and abs(by[60][0] - by[60][1]) < 0.02
    assert by[12_000][0] is None and by[0][0] is None and by[8][0] == 1.0


def test_the_argument_says_which_decides(spark):
    # A gap of 0.6 in tiny samples: the exact value is above the threshold, and so is the distance.
    rows = [("few", 5, 5, 0.6, 1.0, 1.0), ("many", 50, 1500, 0.05, 1.0, 1.0), ("clear", 40, 40, 0.9, 0.01, 1.0)]
    stats = spark.createDataFrame(rows, "feature string, n_current long, n_reference long, ks double, wasserstein double, reference_std double")

    def verdicts(method):
        return {r.feature: (r.method, r.drifted) for r in twosample.drift_verdict(stats, method).collect()}

    assert verdicts(DISTANCE) == {"few": (DISTANCE, True), "many": (DISTANCE, True), "clear": (DISTANCE, False)}
    assert verdicts(EXACT) == {"few": (EXACT, False), "many": (EXACT, False), "clear": (EXACT, True)}
    assert verdicts(BY_SIZE) == {"few": (EXACT, False), "many": (DISTANCE, True), "clear": (EXACT, True)}
    assert EXACT not in twosample.drift_verdict(stats, P_VALUE).columns
    with pytest.raises(ValueError):
        twosample.drift_verdict(stats, "other")
