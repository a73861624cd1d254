"""As-of joins: boundaries, ties, late vintages, blocks, and the audit's forecast variant."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadloom.operators import asof
from loadloom.plans import evaluation, features

T0 = datetime(2024, 3, 1)


def hours(*n):
    return [T0 + timedelta(hours=h) for h in n]


def test_publication_time_is_where_lead_hours_count_from(frame):
    from loadloom.functions.clock import lead_hours

    days = frame([("2024-03-31 00:30:00",), ("2024-03-31 22:00:00",), ("2024-10-27 10:00:00",), ("2024-07-01 23:00:00",)], "ts timestamp")
    got = days.select(((F.unix_seconds("ts") - F.unix_seconds(asof.publication_time("ts"))) / 3600).alias("h"), lead_hours("ts").alias("lead")).collect()
    assert [int(r.h) for r in got] == [r.lead for r in got]


def test_newest_vintage_known_at_publication(frame):
    # Hour 12:00 UTC of 2 March, local day of Paris or Berlin: published on 1 March, 10:00 local, 09:00 UTC.
    rows = [
        ("a", "2024-03-02 12:00:00", "2024-03-01 09:00:00", 1, 10.0), ("a", "2024-03-02 12:00:00", "2024-03-01 09:00:00", 2, 5.0),
        ("a", "2024-03-02 12:00:00", "2024-03-01 09:00:01", 3, 99.0), ("a", "2024-03-02 12:00:00", "2024-02-28 00:00:00", 4, 1.0),
        ("a", "2024-03-02 13:00:00", "2024-03-02 08:00:00", 5, 7.0), ("b", "2024-03-02 12:00:00", None, 6, 8.0),
        ("b", "2024-03-02 12:00:00", "2024-03-01 00:00:00", 7, None),
    ]
    vintages = frame(rows, "series_id string, ts timestamp, issued_at timestamp, seq int, temp_c double")
    got = {r.series_id: r for r in asof.as_known_at(vintages, ["temp_c"], asof.publication_time("ts", "Europe/Paris"), seq="seq").collect()}
    assert got.keys() == {"a", "b"}  # the hour with a late vintage only has no row
    assert got["a"].temp_c == 5.0 and got["b"].temp_c is None  # the later arrival of one issue time; a null value is a value
    plain = asof.as_known_at(vintages, ["temp_c"], asof.publication_time("ts", "Europe/Paris")).collect()
    assert {r.series_id: r.temp_c for r in plain}["a"] == 10.0
    assert asof.as_known_at(vintages.limit(0), ["temp_c"]).count() == 0


def test_vintages_by_lead_have_their_issue_time(frame):
    df = frame([("2024-03-05 06:00:00", 2)], "ts timestamp, lead_days int")
    assert df.select((F.unix_seconds("ts") - F.unix_seconds(asof.issued_before("ts", "lead_days"))).alias("s")).first().s == 2 * 86_400


@pytest.mark.parametrize("size", [1, 5, 4096])
def test_asof_join_equals_a_plain_search(spark, size):
    rng = np.random.default_rng(4)
    right = [(s, T0 + timedelta(minutes=int(m)), int(i), float(i)) for i, (s, m) in enumerate(zip(rng.choice(list("abc"), 120), rng.integers(0, 6000, 120)))]
    right += [("a", None, 900, 1.0), ("c", hours(3)[0], 901, None), ("c", hours(3)[0], 800, 4.0)]
    left = [(i, str(s), T0 + timedelta(minutes=int(m))) for i, (s, m) in enumerate(zip(rng.choice(list("abcz"), 200), rng.integers(-300, 9000, 200)))]
    left += [(500, "a", None), (501, "c", hours(3)[0]), (502, "c", hours(3)[0])]
    l = spark.createDataFrame(left, "i int, series_id string, at timestamp")
    r = spark.createDataFrame(right, "series_id string, ts timestamp, seq int, v double")
    got = {x.i: (x.matched_at, x.v) for x in asof.asof_join(l, r, ["v"], "at", seq="seq", size=size).collect()}
    for i, s, t in left:
        before = [(u, q, v) for k, u, q, v in right if k == s and u is not None and t is not None and u <= t]
        want = max(before, key=lambda x: x[:2]) if before else (None, None, None)
        assert got[i] == (want[0], want[2]), i
    assert len(got) == len(left)


def test_asof_join_of_empty_sides_and_clashing_names(spark):
    l = spark.createDataFrame([("a", T0)], "series_id string, at timestamp")
    r = spark.createDataFrame([("a", T0, 1.0)], "series_id string, ts timestamp, v double")
    assert [tuple(x) for x in asof.asof_join(l, r.limit(0), ["v"], "at").collect()] == [("a", T0, None, None)]
    assert asof.asof_join(l.limit(0), r, ["v"], "at").count() == 0
    with pytest.raises(ValueError):
        asof.asof_join(l.withColumn("v", F.lit(1)), r, ["v"], "at")


def test_variant_c_serves_the_forecast_that_was_out(spark):
    """Late vintages are poison: the audit must not read them."""
    n = 24 * 40
    base = spark.range(n).select(
        F.lit("s").alias("series_id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600).alias("ts"),
        (1000 + 100 * F.sin(F.col("id") / 4) + (F.col("id") * 37 % 101)).alias("load_mw"), F.lit(1000.0).alias("tso_forecast_mw"),
        (10 + 5 * F.cos(F.col("id") / 12)).alias("temp_c"), F.lit(3.0).alias("wind_ms"), F.lit(50.0).alias("cloud_cover"), F.lit(60.0).alias("humidity_pct"),
        F.lit(False).alias("is_holiday"), F.lit("v").alias("data_source_version"),
    )
    early = base.select("series_id", "ts", (F.col("temp_c") + 1).alias("temp_c"), asof.publication_time("ts").alias("issued_at"))
    late = base.select("series_id", "ts", F.lit(1e6).alias("temp_c"), (asof.publication_time("ts") + F.expr("INTERVAL 1 SECOND")).alias("issued_at"))
    how = dict(initial_train_days=14, test_days=5, step_days=5, max_splits=1)
    plain = evaluation.audit(base, early.drop("issued_at"), horizon=24, **how)
    asked = evaluation.audit(base, early.unionByName(late), horizon=24, issued="issued_at", **how)
    rows = lambda df: sorted((r.ts, r.variant, r.model, round(r.y_pred, 6)) for r in df.collect())
    assert rows(asked) == rows(plain) and {r[1] for r in rows(asked)} == {"A", "B", "C"}
    assert features.swap_weather(base, asof.as_known_at(early.unionByName(late), ["temp_c"])).agg(F.max("temp_c")).first()[0] < 100
