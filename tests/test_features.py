"""Leakage, poisoning, serving."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadloom.functions import names
from loadloom.plans import features

T0 = datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def dataset(spark):
    n = 24 * 40
    ts = [T0 + timedelta(hours=i) for i in range(n)]
    pdf = pd.DataFrame(
        {
            "series_id": "a", "ts": pd.to_datetime(ts),
            "load_mw": [18000 + 2000 * math.sin(i / 24 * 2 * math.pi) + (i * 7919 % 101) for i in range(n)],
            "temp_c": [float(i % 30) for i in range(n)], "wind_ms": 3.0, "cloud_cover": 50.0, "humidity_pct": 60.0,
            "tso_forecast_mw": 18000.0,
        }
    )
    path = f"{spark.conf.get('spark.checkpoint.dir')}/feature-input"
    spark.createDataFrame(pdf).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_columns_are_pinned(dataset):
    f = features.make_features(dataset, 24)
    assert f.columns[2:] == [*features.feature_names(24), "target"]
    assert len(features.feature_names(24)) == 20
    assert all(t == "double" for c, t in f.dtypes[2:])


@pytest.mark.parametrize("horizon", [1, 24, 48])
def test_features_match_pandas(dataset, horizon):
    got = features.make_features(dataset, horizon).orderBy("ts").toPandas().set_index("ts")
    load = dataset.orderBy("ts").toPandas().set_index("ts")["load_mw"]
    for lag in (horizon, horizon + 1, horizon + 24, 168, 168 + horizon):
        np.testing.assert_allclose(got[f"load_lag_{lag}"], load.shift(lag).loc[got.index])
    base = load.shift(horizon).rolling(24)
    np.testing.assert_allclose(got["load_roll_mean_24"], base.mean().loc[got.index])
    np.testing.assert_allclose(got["load_roll_std_24"], base.std().loc[got.index])
    assert len(got) == len(load) - 168 - horizon


@pytest.mark.parametrize("horizon", [6, 24])
def test_poisoned_future_leaves_the_past_alone(dataset, horizon):
    cut = T0 + timedelta(days=20)
    poisoned = dataset.withColumn("load_mw", F.when(F.col("ts") > cut, 9.9e8).otherwise(F.col("load_mw")))
    safe = F.col("ts") <= cut + timedelta(hours=horizon)
    inputs = features.feature_names(horizon)
    a = features.make_features(dataset, horizon).filter(safe).orderBy("ts").select(inputs).toPandas()
    b = features.make_features(poisoned, horizon).filter(safe).orderBy("ts").select(inputs).toPandas()
    pd.testing.assert_frame_equal(a, b)
    later = features.make_features(poisoned, horizon).filter(~safe).agg(F.max("load_roll_mean_24")).first()[0]
    assert later > 1e7  # the poison is visible where it may be


def test_gap_does_not_shorten_a_lag(dataset):
    holes = dataset.filter("dayofmonth(ts) <> 9 or hour(ts) not between 3 and 8")
    a = features.make_features(dataset, 24).select("ts", *[F.col(f"load_lag_{n}") for n in (24, 25, 48, 168, 192)])
    b = features.make_features(holes, 24).select("ts", *[F.col(f"load_lag_{n}") for n in (24, 25, 48, 168, 192)])
    assert 0 < b.count() < a.count()
    assert b.exceptAll(a).count() == 0


def test_all_leads_equal_one_build_per_horizon(dataset):
    long = features.make_features_by_lead(dataset, horizons=[14, 24])
    for h in (14, 24):
        one = features.make_features(dataset, h).select(
            "ts", F.col(f"load_lag_{h}").alias("lag_h"), F.col(f"load_lag_{168 + h}").alias("lag_week_h"),
            F.col("load_roll_std_24").alias("roll_std"),
        )
        all_at_once = long.filter(F.col("horizon") == h).select("ts", "lag_h", "lag_week_h", "roll_std")
        assert one.count() == all_at_once.count()
        joined = one.join(all_at_once.withColumnRenamed("lag_h", "l2").withColumnRenamed("roll_std", "s2"), "ts")
        assert joined.filter("abs(lag_h - l2) > 1e-9 or abs(roll_std - s2) > 1e-6").count() == 0
    assert long.filter("is_own_lead and lead_h <> horizon").count() == 0


def test_serving_reaches_last_actual_plus_horizon(dataset):
    cut = T0 + timedelta(days=30)
    history = dataset.filter(F.col("ts") <= cut)
    weather = dataset.filter(F.col("ts") > cut).select("series_id", "ts", "temp_c", "wind_ms", "cloud_cover", "humidity_pct")
    targets = features.target_hours(history, 24)
    served = features.features_for_targets(history, weather, 24, targets)
    assert served.count() == targets.count() == 24
    assert "target" not in served.columns
    row = served.agg(F.min("ts"), F.max("ts")).first()
    assert (row[0], row[1]) == (cut + timedelta(hours=1), cut + timedelta(hours=24))
    trained = features.make_features(dataset, 24).select(served.columns)
    assert served.exceptAll(trained).count() == 0  # serving and training build the same rows


def test_consecutive_runs_tile(dataset):
    first = dataset.filter(F.col("ts") <= T0 + timedelta(days=10))
    second = dataset.filter(F.col("ts") <= T0 + timedelta(days=11))
    a = {r["ts"] for r in features.target_hours(first, 24).collect()}
    b = {r["ts"] for r in features.target_hours(second, 24).collect()}
    assert not a & b and min(b) - max(a) == timedelta(hours=1)


def test_families_and_id():
    every = [*features.feature_names(24), "target"]
    assert "target" not in names.feature_columns(every)
    assert names.feature_columns(every, include_lags=False, include_weather=False) == list(features.CALENDAR)
    assert names.monitored_columns(every) == names.feature_columns(every)[9:]
    assert names.feature_set_id(every) == names.feature_set_id(reversed(every))
    assert len(names.feature_set_id(every)) == 10


def test_missing_input_column_is_an_error(dataset):
    with pytest.raises(ValueError, match="cloud_cover"):
        features.make_features(dataset.drop("cloud_cover"), 24)


def test_swap_needs_the_column_on_both_sides(dataset):
    with pytest.raises(ValueError):
        features.swap_weather(dataset, dataset.select("series_id", "ts"), ["temp_c"])
