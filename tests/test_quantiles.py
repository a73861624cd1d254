"""Quantile regression: exact sample quantiles, optimality, order, spread, origins."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from loadloom.plans import models, quantiles

HOUR = datetime(2024, 1, 1)


def loss(y, p, q):
    return float(np.maximum(q * (y - p), (q - 1) * (y - p)).mean())


@pytest.fixture(scope="module")
def uneven(spark):
    """Two series whose spread grows with x, one of them with few rows."""
    rng, parts = np.random.default_rng(1), []
    for name, n in (("a", 3000), ("b", 150)):
        x = rng.uniform(0, 1, n)
        parts.append(pd.DataFrame({
            "series_id": name, "ts": HOUR + pd.to_timedelta(np.arange(n), "h"), "x": x, "z": rng.normal(size=n),
            "target": 100 + 50 * x + (0.5 + 9 * x) * rng.normal(size=n),
        }))
    return pd.concat(parts)


def test_model_without_columns_is_the_exact_quantile(spark):
    rng = np.random.default_rng(2)
    rows = [(s, HOUR + timedelta(hours=i), float(v)) for s, n in (("a", 1000), ("b", 7), ("c", 1), ("d", 40)) for i, v in
            enumerate(np.round(rng.normal(size=n), 1) if s == "d" else rng.normal(size=n) * 1000)]
    rows += [("a", HOUR, None), ("b", HOUR, float("nan"))]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp, target double")
    qs = (0.05, 0.1, 0.5, 0.9)
    found = {(r.series_id, r.quantile): r.coefficients for r in quantiles.fit_quantiles(df, [], qs).collect()}
    for s in "abcd":
        v = sorted(x for t, _, x in rows if t == s and x is not None and x == x)
        for q in qs:
            assert found[s, q] == [pytest.approx(v[max(int(np.ceil(q * len(v) - 1e-9)), 1) - 1], abs=1e-8)]


def test_windows_are_moved_and_narrowed_to_the_exact_value(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MOST_READ", 5)
    monkeypatch.setattr(quantiles, "WIDTH", 1e-4)
    values = np.concatenate([np.zeros(300), np.random.default_rng(3).lognormal(0, 3, 700)])
    df = spark.createDataFrame([("a", HOUR + timedelta(hours=i), float(v)) for i, v in enumerate(values)], "series_id string, ts timestamp, target double")
    found = {r.quantile: r.coefficients[0] for r in quantiles.fit_quantiles(df, [], (0.2, 0.35, 0.97), passes=1).collect()}
    want = np.sort(values)
    for q in (0.2, 0.35, 0.97):
        assert found[q] == pytest.approx(want[int(np.ceil(q * 1000 - 1e-9)) - 1], abs=1e-7)


def test_each_quantile_is_best_at_its_own_loss_and_near_the_optimum(spark, uneven):
    fits = quantiles.fit_quantiles(spark.createDataFrame(uneven), ["x", "z"]).collect()
    by = {(r.series_id, r.quantile): np.array(r.coefficients) for r in fits}
    assert len(by) == 6
    for name, part in uneven.groupby("series_id"):
        x, y = np.column_stack([np.ones(len(part)), part.x, part.z]), part.target.to_numpy()
        for q in quantiles.BAND:
            losses = {p: loss(y, x @ by[name, p], q) for p in quantiles.BAND}
            assert min(losses, key=losses.get) == q
            assert abs((y <= x @ by[name, q] + 1e-9).mean() - q) < 1 / len(y) + 1e-9
            # No small move of any coefficient lowers the loss by more than a thousandth.
            for k in range(3):
                for step in (-0.5, -0.1, 0.1, 0.5):
                    moved = by[name, q] + step * (np.arange(3) == k)
                    assert loss(y, x @ moved, q) > losses[q] * 0.999


def test_uneven_spread_beats_the_residual_band(spark, uneven):
    df = spark.createDataFrame(uneven.assign(side=np.arange(len(uneven)) % 2)).filter("series_id = 'a'")
    train, later = df.filter("side = 0"), df.filter("side = 1")
    fits = quantiles.fit_quantiles(train, ["x"])
    keep = ["series_id", "ts", "target"]
    own = quantiles.band_of(later, fits, ["x"], ["series_id"], keep).toPandas()
    point = models.fit_linear_groups(train, ["x"])
    offsets = models.conformal_offsets(models.apply_linear(train.join(point, "series_id"), ["x"]), by=["series_id"])
    flat = models.with_band(models.apply_linear(later.join(point, "series_id"), ["x"]), offsets, by=["series_id"]).toPandas()
    for q in (0.1, 0.9):
        mine = own[own["quantile"] == q]
        assert loss(mine.target.to_numpy(), mine.y_pred.to_numpy(), q) < 0.9 * loss(flat.target.to_numpy(), flat[f"p{round(q * 100)}"].to_numpy(), q)
    wide = own.pivot(index="ts", columns="quantile", values="y_pred")
    assert (wide[0.1] <= wide[0.5]).all() and (wide[0.5] <= wide[0.9]).all()


def test_crossing_fits_are_rearranged(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", -1.0)], "series_id string, x double")
    fits = spark.createDataFrame([("a", 0.1, [0.0, 5.0]), ("a", 0.9, [0.0, 1.0])], "series_id string, quantile double, coefficients array<double>")
    found = sorted((r.x, r.quantile, r.y_pred) for r in quantiles.band_of(rows, fits, ["x"], ["series_id"], ["x"]).collect())
    assert found == [(-1.0, 0.1, -5.0), (-1.0, 0.9, -1.0), (1.0, 0.1, 1.0), (1.0, 0.9, 5.0)]


def test_each_origin_sees_its_training_rows_only(spark):
    values = np.arange(40.0)
    df = spark.createDataFrame([("a", HOUR + timedelta(hours=i), float(v)) for i, v in enumerate(values)], "series_id string, ts timestamp, target double")
    at = lambda h: HOUR + timedelta(hours=h)
    rows = [("a", 1, at(0), at(9), at(12), at(19)), ("a", 2, at(0), at(19), at(16), at(29)), ("z", 1, at(0), at(9), at(12), at(19))]
    splits = spark.createDataFrame(rows, "series_id string, origin_no long, train_start timestamp, train_end timestamp, test_start timestamp, test_end timestamp")
    found = {(r.ts, r.quantile): r.y_pred for r in quantiles.band_by_origin(df, splits, [], (0.1, 0.5)).collect()}
    assert {k[0] for k in found} == {at(h) for h in range(12, 30)}
    # Hours 12 to 15 from the first origin's ten rows, all others from the second one's twenty.
    assert found[at(12), 0.1] == pytest.approx(0.0) and found[at(12), 0.5] == pytest.approx(4.0)
    assert found[at(16), 0.1] == pytest.approx(1.0) and found[at(29), 0.5] == pytest.approx(9.0)


@pytest.mark.parametrize("wrong", [(), (0.0,), (0.5, 1.0), (0.5, 0.5)])
def test_wrong_quantiles_are_refused(wrong):
    with pytest.raises(ValueError):
        quantiles.require_quantiles(wrong)
