"""Metrics, segments, splits, quality."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadloom.functions import errors
from loadloom.operators import quality, scores, splits
from loadloom.operators.fingerprint import fingerprint
from loadloom.session import require_rows

T0 = datetime(2024, 1, 1)
LONG = "series_id string, ts timestamp, model string, y_true double, y_pred double"


def long(frame, pairs, model="m", start=T0):
    return frame([("a", str(start + timedelta(hours=i)), model, t, p) for i, (t, p) in enumerate(pairs)], LONG)


PAIRS = [(20000.0, 20100.0), (20000.0, 19800.0), (10000.0, 10300.0), (10000.0, 9600.0)]


def test_point_metrics(frame):
    r = scores.point_metrics(long(frame, PAIRS)).first()
    assert r["mape"] == pytest.approx(2.125)
    assert r["mae_mw"] == pytest.approx(250)
    assert r["rmse_mw"] == pytest.approx(math.sqrt(75000))
    assert r["bias_mw"] == pytest.approx(-50)


def test_missing_prediction_is_not_scored_but_counted(frame):
    r = scores.point_metrics(long(frame, [(20000.0, None), *PAIRS[1:]])).first()
    assert (r["n"], r["n_scored"]) == (4, 3)
    assert r["mae_mw"] == pytest.approx(300)


def test_zero_actual_has_no_percentage_error(frame):
    r = scores.point_metrics(long(frame, [(0.0, 5.0), (100.0, 90.0)])).first()
    assert r["mape"] == pytest.approx(10)
    assert r["mae_mw"] == pytest.approx(7.5)


def test_nothing_to_score(frame):
    r = scores.point_metrics(long(frame, [(1.0, None), (None, 2.0)])).first()
    assert r["mape"] is None and r["rmse_mw"] is None
    with pytest.raises(ValueError):
        require_rows(long(frame, [(1.0, None)]).dropna(), "no overlapping values")


def test_negative_actual_differs_between_the_two_percentages(spark):
    row = spark.sql("SELECT -10.0D t, -5.0D p").select(errors.ape("t", "p").alias("a"), errors.signed_ape("t", "p").alias("b")).first()
    assert (row["a"], row["b"]) == (0.5, -0.5)


@pytest.mark.parametrize("t,p,q,expected", [(100.0, 90.0, 0.9, 9.0), (100.0, 110.0, 0.9, 1.0)])
def test_pinball(spark, t, p, q, expected):
    assert spark.range(1).select(errors.pinball(F.lit(t), F.lit(p), q)).first()[0] == pytest.approx(expected)


@pytest.mark.parametrize("q", [0, 1, 1.5, -0.1])
def test_pinball_needs_a_quantile(q):
    with pytest.raises(ValueError):
        errors.pinball("t", "p", q)


def test_segments_partition_the_rows(frame):
    pairs = [(100.0 + i % 7, 100.0) for i in range(24 * 30)]
    table = scores.by_segment(long(frame, pairs, start=datetime(2023, 12, 15)))
    counts = {r["segment_kind"]: r["n"] for r in table.groupBy("segment_kind").agg(F.sum("n").alias("n")).collect()}
    assert counts == dict.fromkeys(("period", "daytype", "holiday", "season", "special"), 24 * 30)


def test_gap_sign_decides_the_verdict(frame):
    df = long(frame, [(100.0, 99.0)] * 24, "model_a").unionByName(long(frame, [(100.0, 98.0)] * 24, scores.REFERENCE))
    table = scores.versus_reference(scores.by_segment(df), "model_a")
    assert {r["verdict"] for r in table.collect()} == {scores.WINS}
    overall = {r["model"]: r["mape_vs_reference"] for r in scores.overall(df).collect()}
    assert overall == {"model_a": pytest.approx(-1), scores.REFERENCE: pytest.approx(0)}


def test_table_order_and_primary_model(frame):
    df = long(frame, PAIRS, "zz").unionByName(long(frame, PAIRS, scores.REFERENCE)).unionByName(long(frame, PAIRS, scores.NAIVE))
    order = [r["model"] for r in scores.present_in_order(scores.point_metrics(df)).collect()]
    assert order == [scores.NAIVE, scores.REFERENCE, "zz"]
    both = long(frame, PAIRS, scores.CALENDAR_TREES).unionByName(long(frame, PAIRS, scores.WEATHER_TREES))
    assert scores.primary_model(both).first()["model"] == scores.WEATHER_TREES


def year(frame, days=200, sid="a"):
    return frame([(sid, str(T0 + timedelta(hours=i))) for i in range(24 * days)], "series_id string, ts timestamp")


@pytest.mark.parametrize("horizon", [1, 24, 48])
def test_chronological_split_keeps_the_embargo(frame, horizon):
    out = splits.chronological_split(year(frame, 60), 20, horizon)
    ends = {r["block"]: (r["a"], r["b"], r["n"]) for r in out.groupBy("block").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n")).collect()}
    assert ends["validation"][0] - ends["train"][1] == timedelta(hours=horizon)
    assert ends["validation"][2] == 20 * 24
    assert splits.split_shortfalls(out).isEmpty()


def test_too_little_history_is_a_shortfall(frame):
    assert splits.split_shortfalls(splits.chronological_split(year(frame, 10), 20, 24)).count() == 1


@pytest.mark.parametrize("horizon", [1, 24])
def test_rolling_origins(frame, horizon):
    table = splits.rolling_origins(year(frame), horizon, 100, 14, 14).orderBy("origin_no").collect()
    assert all(r["test_start"] - r["train_end"] == timedelta(hours=horizon) for r in table)
    assert {r["train_start"] for r in table} == {T0}
    assert all(b["test_start"] > a["test_end"] for a, b in zip(table, table[1:]))
    assert table[-1]["test_end"] == T0 + timedelta(hours=24 * 200 - 1)
    assert splits.rolling_origins(year(frame), horizon, 100, 14, 14, max_splits=3).count() == 3


def test_anchored_origins(frame):
    start = T0 + timedelta(days=150)
    table = splits.rolling_origins(year(frame), 24, 100, 14, 14, first_test_start=start).orderBy("origin_no").collect()
    assert table[0]["test_start"] == start and table[0]["train_start"] == T0
    with pytest.raises(Exception, match="too few training days"):
        splits.rolling_origins(year(frame), 24, 180, 14, 14, first_test_start=start).collect()


def test_origins_stop_at_an_empty_block(frame):
    holes = year(frame).filter(~F.col("ts").between(T0 + timedelta(days=127), T0 + timedelta(days=150)))
    assert splits.rolling_origins(holes, 24, 100, 14, 14).count() == 2


def test_no_split_fits(frame):
    assert splits.rolling_origins(year(frame, 20), 24, 100, 14, 14).isEmpty()
    with pytest.raises(ValueError):
        splits.rolling_origins(year(frame, 20), 24, 0, 14, 14)


def test_minimum_hours():
    assert splits.minimum_training_hours(60, 24, 168) == 168 + 24 + 60 * 24 + 24


CANON = "series_id string, ts timestamp, load_mw double, tso_forecast_mw double, temp_c double, wind_ms double, cloud_cover double, humidity_pct double, is_holiday boolean"


@pytest.fixture
def clean(frame):
    rows = [("a", str(T0 + timedelta(hours=i)), 20000.0, 19900.0, 5.0, 3.0, 50.0, 60.0, False) for i in range(100)]
    return frame(rows, CANON)


def hour(n):
    return F.col("ts") == T0 + timedelta(hours=n)


def issues(df):
    return {r["name"]: r for r in quality.validate(df).collect()}


def test_clean_table_is_valid(clean):
    assert issues(clean) == {} and quality.is_valid(quality.validate(clean))


def test_faults_are_named(clean):
    dropped = issues(clean.filter(~F.col("ts").between(T0 + timedelta(hours=10), T0 + timedelta(hours=12))))
    assert dropped[quality.MISSING]["n"] == 3
    assert dropped[quality.MISSING]["examples"] == ["2024-01-01 10:00 -> 2024-01-01 12:00  (3 h)"]
    wild = issues(clean.withColumn("load_mw", F.when(hour(5), 91000.0).otherwise(F.col("load_mw"))))
    assert wild["schema: load_mw failed in_range(10000, 30000)"]["n"] == 1
    hot = issues(clean.withColumn("temp_c", F.lit(300.0)))
    found = hot["schema: temp_c failed in_range(-35, 45)"]
    assert found["n"] == 100 and len(found["examples"]) == quality.MAX_EXAMPLES
    twice = clean.unionByName(clean.filter(F.col("ts") < T0 + timedelta(hours=3)))
    assert issues(twice)[quality.DUPLICATES]["n"] == 3


def test_missing_load_is_only_a_warning(clean):
    late = clean.withColumn("load_mw", F.when(F.col("ts") >= T0 + timedelta(hours=95), None).otherwise(F.col("load_mw")))
    found = quality.validate(late)
    assert [(r["name"], r["n"], r["severity"]) for r in found.collect()] == [(quality.NO_LOAD, 5, "warning")]
    quality.raise_for_status(found)
    blind = clean.withColumn("tso_forecast_mw", F.when(F.col("ts") < T0 + timedelta(hours=6), None).otherwise(F.col("tso_forecast_mw")))
    assert issues(blind)[quality.NO_REFERENCE]["n"] == 6
    with pytest.raises(quality.ValidationError):
        quality.raise_for_status(quality.validate(blind))


def test_fingerprint_follows_content(clean):
    one = fingerprint(clean).first()["fingerprint"]
    assert len(one) == 12
    assert fingerprint(clean.orderBy(F.desc("ts")).repartition(3)).first()["fingerprint"] == one
    changed = clean.withColumn("load_mw", F.when(hour(7), 20000.5).otherwise(F.col("load_mw")))
    nulled = clean.withColumn("load_mw", F.when(hour(7), None).otherwise(F.col("load_mw")))
    extra = clean.unionByName(clean.limit(1)).unionByName(clean.limit(1))
    assert len({one, *[fingerprint(d).first()["fingerprint"] for d in (changed, nulled, extra)]}) == 4
