"""Resampling, overlays, lags, rolling frames, runs, positions."""

import math
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadloom.functions import clock, scalars
from loadloom.functions.holidays import holiday_dimension, with_holiday_flag
from loadloom.functions.segments import with_segments
from loadloom.operators import align, blocks, history, islands, latest, spine, stations
from loadloom.operators.resample import to_hourly
from loadloom.plans.dataset import build_dataset, merge_datasets

READINGS = "series_id string, ts timestamp, value double, ingest_seq long"
T0 = datetime(2024, 1, 1)


def hours(n, start=T0):
    return [str(start + timedelta(hours=i)) for i in range(n)]


def load_frame(frame, values, start=T0, sid="a"):
    rows = [(sid, t, v) for t, v in zip(hours(len(values), start), values)]
    return frame(rows, "series_id string, ts timestamp, load_mw double")


def values(df, column, order="ts"):
    return [r[column] for r in df.orderBy(order).collect()]


def test_hourly_mean(frame):
    v = [100, 200, 300, 400, 10, 20, 30, 40]
    rows = [("a", str(T0 + timedelta(minutes=15 * i)), float(x), i) for i, x in enumerate(v)]
    assert values(to_hourly(frame(rows, READINGS)), "load_mw") == [250.0, 25.0]


def test_revision_wins_and_gap_is_null(frame):
    rows = [("a", str(T0 + timedelta(minutes=15 * i)), 100.0, i) for i in range(4)]
    rows += [("a", str(T0 + timedelta(minutes=15 * i)), 200.0, 10 + i) for i in range(4)]
    rows += [("a", str(T0 + timedelta(hours=2)), 7.0, 99)]
    assert values(to_hourly(frame(rows, READINGS)), "load_mw") == [200.0, None, 7.0]


def test_unknown_aggregate_is_an_error(frame):
    with pytest.raises(ValueError):
        to_hourly(frame([], READINGS), aggregate="median")


def test_zoneless_time_needs_a_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-07-01 12:00:00' AS ts")
    with pytest.raises(ValueError):
        clock.as_instant(df, "ts")
    assert clock.as_instant(df, "ts", "Europe/Warsaw").first()["ts"] == datetime(2024, 7, 1, 10)


STATION = "series_id string, ts timestamp, station string, temp_c double, wind_ms double"


@pytest.mark.parametrize("pair,expected", [((10.0, 0.0), 6.0), ((10.0, None), 10.0), ((100.0, 100.0), 100.0), ((None, None), None)])
def test_weighted_mean(spark, frame, pair, expected):
    rows = [("a", str(T0), s, v, 1.0) for s, v in zip("xy", pair)]
    weights = stations.normalise_weights(spark.createDataFrame([("x", 3.0), ("y", 2.0)], "station string, weight double"))
    out = stations.weighted_mean(frame(rows, STATION), weights, ["temp_c", "wind_ms"]).first()
    assert out["temp_c"] == (pytest.approx(expected) if expected is not None else None)
    assert out["wind_ms"] == 1.0


def test_unknown_station_is_an_error_in_strict_mode(spark, frame):
    rows = [("a", str(T0), "z", 1.0, 1.0)]
    weights = spark.createDataFrame([("x", 1.0)], "station string, weight double")
    with pytest.raises(Exception, match="no weight for station"):
        stations.weighted_mean(frame(rows, STATION), weights, ["temp_c"], strict=True).collect()
    assert [r["station"] for r in stations.unknown_stations(frame(rows, STATION), weights).collect()] == ["z"]


def test_overlays_differ_on_nulls(frame):
    old = load_frame(frame, [1.0, 2.0, 3.0])
    new = load_frame(frame, [None, 9.0], T0 + timedelta(hours=1))
    assert values(align.replace_rows(old, new), "load_mw") == [1.0, None, 9.0]
    assert values(align.overlay_cells(new, old), "load_mw") == [1.0, 2.0, 9.0]


def test_lag_is_time_accurate_over_a_gap(frame):
    df = load_frame(frame, [float(i) for i in range(60)]).filter("hour(ts) <> 5")
    lagged = history.with_history(df, [24], [(24, 3)])
    by_ts = {r["ts"]: r for r in lagged.collect()}
    assert by_ts[T0 + timedelta(hours=30)]["load_lag_24"] == 6.0
    assert T0 + timedelta(hours=29) not in by_ts
    assert by_ts[T0 + timedelta(hours=30)]["load_roll_mean_3"] is None  # hour 5 is missing
    assert by_ts[T0 + timedelta(hours=36)]["load_roll_mean_3"] == 11.0


@pytest.mark.parametrize("horizon,expected", [(1, [1, 2, 25, 168, 169]), (24, [24, 25, 48, 168, 192]), (200, [200, 201, 224, 368])])
def test_lag_sets(horizon, expected):
    assert history.lag_hours(horizon) == expected


def test_duplicate_hours_are_refused(frame):
    df = load_frame(frame, [1.0, 2.0]).unionByName(load_frame(frame, [3.0]))
    with pytest.raises(Exception, match="duplicate hour"):
        history.with_history(df, [24]).collect()


def test_blocks_do_not_change_lags_or_rolling(frame):
    """Tiny blocks, before and after the epoch, against pandas on the complete axis."""
    start = datetime(1969, 12, 30)
    vals = [math.sin(i) * 10 for i in range(120)]
    df = load_frame(frame, vals, start)
    small = blocks.with_halo(df.withColumn("_h", clock.hour_number("ts")), "_h", 30, size=7)
    w = blocks.halo_window("_h")
    got = blocks.drop_halo(
        small.withColumn("lag", F.max("load_mw").over(w.rangeBetween(-30, -30)))
        .withColumn("mean", F.avg("load_mw").over(w.rangeBetween(-30, 0)))
    ).orderBy("ts").toPandas()
    series = pd.Series(vals)
    assert len(got) == 120
    pd.testing.assert_series_equal(got["lag"], series.shift(30), check_names=False)
    pd.testing.assert_series_equal(got["mean"], series.rolling(31, min_periods=1).mean(), check_names=False)


def test_positions_and_row_frames_match_pandas(frame):
    vals = [float((i * 37) % 101) if i % 9 else None for i in range(300)]
    df = load_frame(frame, vals).filter("hour(ts) not in (3, 4)")
    placed = blocks.with_position(df.withColumn("_h", clock.hour_number("ts")), "_h", size=10)
    assert values(placed, "position") == list(range(df.count()))
    got = values(history.rolling_rows_mean(df, "load_mw", "m", rows=24), "m")
    series = pd.Series(values(df, "load_mw"), dtype=float)
    want = series.rolling(24, min_periods=12).mean()
    for g, w in zip(got, want):
        assert (g is None and math.isnan(w)) or g == pytest.approx(w)


@pytest.mark.parametrize("size", [1, 3, 7, 4096])
def test_runs(frame, size):
    keep = [0, 1, 2, 5, 6, 9, 20, 21, 22, 23, 24, 25, 26, 27, 30]
    df = frame([("a", hours(31)[i]) for i in keep], "series_id string, ts timestamp")
    got = [(r["first_ts"].hour + 24 * (r["first_ts"].day - 1), r["hours"]) for r in islands.hour_runs(df, size=size).orderBy("first_ts").collect()]
    assert got == [(0, 3), (5, 2), (9, 1), (20, 8), (30, 1)]


def test_spine_and_missing_hours(frame):
    df = load_frame(frame, [1.0, 2.0, 3.0, 4.0]).filter("hour(ts) <> 2")
    assert spine.hourly_spine(df).count() == 4
    assert [r["ts"].hour for r in spine.missing_hours(df).collect()] == [2]


def test_latest_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("k", 1, 1, "x"), ("k", 1, 2, "y"), ("k", 0, 9, "z")], "k string, at int, id int, v string")
    assert latest.latest_per_key(df, ["k"], ["at", "id"]).first()["v"] == "y"


def test_interval_join_with_overlaps(frame):
    df = load_frame(frame, [float(i) for i in range(48)])
    spans = frame(
        [("a", 1, hours(1)[0], str(T0 + timedelta(hours=30))), ("a", 2, str(T0 + timedelta(hours=20)), str(T0 + timedelta(hours=40)))],
        "series_id string, n int, lo timestamp, hi timestamp",
    )
    got = align.interval_join(df, spans, "lo", "hi", block_hours=5)
    assert {r["n"]: r["c"] for r in got.groupBy("n").agg(F.count("*").alias("c")).collect()} == {1: 31, 2: 21}


def test_lead_times_on_clock_changes(spark):
    def leads(day, n):
        df = spark.sql(f"SELECT explode(sequence(timestamp'{day}' - interval 2 hours, timestamp'{day}' + interval 24 hours, interval 1 hour)) ts")
        local = df.filter(F.to_date(clock.local_time("ts")) == F.to_date(F.lit(day)))
        got = sorted(r[0] for r in local.select(clock.lead_hours("ts")).collect())
        assert (got[0], got[-1], len(got)) == (14, 13 + n, n)
    leads("2026-03-29", 23)
    leads("2026-10-25", 25)
    leads("2024-01-15", 24)


def test_publication_hour_shifts_lead(spark):
    row = spark.sql("SELECT timestamp'2024-01-15 12:00:00' ts").select(
        clock.lead_hours("ts").alias("a"), clock.lead_hours("ts", publication_hour=8).alias("b")
    ).first()
    assert row["b"] == row["a"] + 2


def test_holidays_follow_the_local_date(spark):
    df = spark.sql("SELECT explode(sequence(timestamp'2024-12-24 21:00:00', timestamp'2024-12-25 00:00:00', interval 1 hour)) ts")
    assert values(with_holiday_flag(df), "is_holiday") == [False, False, True, True]


def test_holiday_calendar_counts(spark):
    dim = holiday_dimension(spark, 1980, 2030)
    between = lambda a, b: dim.filter(F.col("holiday_date").between(a, b)).count()
    assert between("2025-08-21", "2026-08-19") == 14
    assert between("2021-01-01", "2021-12-31") == 13
    assert dim.filter("holiday_date = date'2000-04-23'").count() == 1  # Easter Sunday
    assert dim.filter("holiday_date in (date'2010-01-06', date'2024-12-24')").count() == 0
    assert dim.filter("holiday_date in (date'1985-12-25', date'1985-04-07', date'1985-01-01')").count() == 3


@pytest.mark.parametrize("day,holiday", [("1985-12-25", True), ("1899-12-26", True), ("2222-03-31", True), ("1985-05-03", False), ("2150-11-11", True)])
def test_holidays_of_any_year(spark, day, holiday):
    df = spark.sql(f"SELECT timestamp'{day} 12:00:00' ts")
    assert values(with_holiday_flag(df), "is_holiday") == [holiday]


def test_segment_labels(frame):
    rows = [("2024-01-15 05:00:00",), ("2024-01-15 06:00:00",), ("2024-12-31 12:00:00",), ("2024-07-06 12:00:00",)]
    out = with_segments(frame(rows, "ts timestamp")).orderBy("ts").collect()
    assert [r["period"] for r in out] == ["off-peak", "peak", "peak", "peak"]
    assert [r["season"] for r in out] == ["winter", "winter", "summer", "winter"]
    assert [r["daytype"] for r in out] == ["weekday", "weekday", "weekend", "weekday"]
    assert out[-1]["special"] == "christmas–new year"


def test_clip_and_finite(spark):
    df = spark.sql("SELECT explode(array(double('NaN'), double('Infinity'), double('-Infinity'), 1.0D, null)) x")
    assert [r[0] for r in df.select(scalars.finite("x")).collect()] == [False, False, False, True, False]


def test_merge_is_idempotent_and_fills_holes(spark, frame):
    weather = frame([("a", t, 1.0) for t in hours(4)], "series_id string, ts timestamp, temp_c double")
    old = build_dataset(load_frame(frame, [1.0, 2.0, 3.0, 4.0]), weather, "r1")
    late = build_dataset(load_frame(frame, [9.0], T0 + timedelta(hours=6)), weather.filter("false"), "r2")
    once = merge_datasets(old, late)
    twice = merge_datasets(once, late)
    assert once.orderBy("ts").collect() == twice.orderBy("ts").collect()
    assert values(once, "data_source_version") == ["r1"] * 4 + [None, None, "r2"]
    assert values(once, "is_holiday") == [True] * 7  # 1 January, holes included
    assert values(once, "load_mw") == [1.0, 2.0, 3.0, 4.0, None, None, 9.0]


def test_years_back_clamps_leap_day(spark):
    row = spark.sql("SELECT timestamp'2024-02-29 05:00:00' ts").select(clock.years_back("ts", 1)).first()
    assert row[0] == datetime(2023, 2, 28, 5)
