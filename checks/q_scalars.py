"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadloom.functions import clock, names, scalars
from loadloom.functions.errors import signed_ape
from loadloom.functions.segments import with_segments

from . import frames as fr
from .base_sql import calendar, lead, local, midnight, segments
from .registry import query


@query("f1_local_clock", f"SELECT series_id, ts, {local('ts')} AS local_ts FROM hist")
def _(spark, sf):
    return fr.history(spark, sf).select("series_id", "ts", clock.local_time("ts").alias("local_ts"))


@query("f2_zoneless_input", f"SELECT event_id, ts, (ts AT TIME ZONE 'Europe/Warsaw') AT TIME ZONE 'UTC' AS utc_ts FROM events")
def _(spark, sf):
    """Zoneless times are accepted only with a named zone."""
    raw = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", F.col("ts").alias("utc_ts"))
    return clock.as_instant(raw, "utc_ts", "Europe/Warsaw")


@query("f3_f4_calendar_columns", f"SELECT series_id, ts, {calendar()} FROM hist", "hour dow month is_weekend hour_sin hour_cos dow_sin dow_cos")
def _(spark, sf):
    cols = clock.calendar_columns("ts")
    return fr.history(spark, sf).select("series_id", "ts", *[c.cast("double").alias(k) for k, c in cols.items()])


@query("f5_squared_temperature", "SELECT series_id, ts, temp_c * temp_c AS temp_sq FROM hist", "temp_sq")
def _(spark, sf):
    return fr.history(spark, sf).select("series_id", "ts", F.pow("temp_c", 2).alias("temp_sq"))


@query("f6_f7_segment_labels", f"SELECT b.series_id, b.ts, {segments('b.ts', 'h.d IS NOT NULL')} FROM hist b LEFT JOIN hol h ON h.d = CAST({local('b.ts')} AS DATE)")
def _(spark, sf):
    return with_segments(fr.history(spark, sf).select("series_id", "ts"))


@query("f8_lead_time", f"SELECT series_id, ts, {lead('ts')} AS lead_h, {lead('ts', 8)} AS lead_8, {midnight('ts')} AS midnight_utc FROM hist")
def _(spark, sf):
    return fr.history(spark, sf).select(
        "series_id", "ts", clock.lead_hours("ts").alias("lead_h"),
        clock.lead_hours("ts", publication_hour=8).alias("lead_8"), clock.local_midnight("ts").alias("midnight_utc"),
    )


@query("f9_signed_ape", "SELECT series_id, ts, abs(tso_forecast_mw - load_mw) / nullif(load_mw, 0) AS ape FROM hist WHERE load_mw <> 0 AND tso_forecast_mw IS NOT NULL", "ape")
def _(spark, sf):
    return fr.history(spark, sf).select("series_id", "ts", signed_ape("load_mw", "tso_forecast_mw").alias("ape")).dropna()


@query("f10_features_json", """SELECT event_id, '{"k":' || (json_extract(props, '$.k')::INT) || '.0,"u":' || (user_id % 9) || '.0}' AS features FROM events""")
def _(spark, sf):
    k = F.get_json_object("props", "$.k").cast("double")
    m = F.create_map(F.lit("u"), (F.col("user_id") % 9).cast("double"), F.lit("k"), k)
    return fr.events(spark, sf).select("event_id", scalars.features_json(m).alias("features"))


@query("f11_features_from_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, CAST(NULL AS DOUBLE) AS absent FROM events", "k absent")
def _(spark, sf):
    cols = scalars.features_from_json("props", ["k", "absent"])
    return fr.events(spark, sf).select("event_id", *[c.alias(n) for n, c in cols.items()])


@query("f12_iso_text", "SELECT id, strftime(target_time, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS target_text FROM preds")
def _(spark, sf):
    return fr.predictions(spark, sf).select("id", clock.iso_text("target_time").alias("target_text"))


@query("f13_calendar_year_shift", "SELECT series_id, ts, ts - INTERVAL 1 YEAR AS one, ts - INTERVAL 3 YEAR AS three FROM hist")
def _(spark, sf):
    return fr.history(spark, sf).select(
        "series_id", "ts", clock.years_back("ts", 1).alias("one"), clock.years_back("ts", 3).alias("three")
    )


@query("f14_floor_and_ceil", """SELECT event_id, date_trunc('day', ts) AS day_floor, date_trunc('hour', ts) AS hour_floor,
  CASE WHEN date_trunc('day', ts) = ts THEN ts ELSE date_trunc('day', ts) + INTERVAL 1 DAY END AS day_ceil,
  CASE WHEN date_trunc('hour', ts) = ts THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END AS hour_ceil FROM events""")
def _(spark, sf):
    return fr.events(spark, sf).select(
        "event_id", clock.floor_to("day", "ts").alias("day_floor"), clock.floor_to("hour", "ts").alias("hour_floor"),
        clock.ceil_to("day", "ts").alias("day_ceil"), clock.ceil_to("hour", "ts").alias("hour_ceil"),
    )


@query("f15_clip", "SELECT series_id, ts, greatest(least(load_mw, 30000), 10000) AS clipped FROM hist WHERE load_mw IS NOT NULL UNION ALL SELECT series_id, ts, NULL FROM hist WHERE load_mw IS NULL", "clipped")
def _(spark, sf):
    return fr.history(spark, sf).select("series_id", "ts", scalars.clip("load_mw", F.lit(10000.0), F.lit(30000.0)).alias("clipped"))


@query("f16_lag_number_from_name", """, n AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'load_lag_' || (user_id % 400) WHEN 1 THEN 'load_roll_mean_' || (user_id % 400) WHEN 2 THEN 'temp_c' ELSE 'hour' END AS name FROM events)
SELECT event_id, name, CAST(nullif(regexp_extract(name, '^load_lag_(\\d+)$', 1), '') AS DOUBLE) AS lag_h, CASE event_id % 4 WHEN 0 THEN 'lag' WHEN 1 THEN 'rolling' WHEN 2 THEN 'weather' ELSE 'calendar' END AS family FROM n""")
def _(spark, sf):
    tail = F.col("user_id") % 400
    kind = F.col("event_id") % 4
    name = (
        F.when(kind == 0, F.concat(F.lit("load_lag_"), tail)).when(kind == 1, F.concat(F.lit("load_roll_mean_"), tail))
        .when(kind == 2, F.lit("temp_c")).otherwise(F.lit("hour"))
    )
    return fr.events(spark, sf).select("event_id", name.alias("name")).select(
        "event_id", "name", names.lag_of("name").cast("double").alias("lag_h"), names.family("name").alias("family")
    )


@query("f17_finite_check", "SELECT id, CASE WHEN id % 5 = 0 THEN false WHEN id % 7 = 0 THEN false WHEN id % 11 = 0 THEN false ELSE true END AS finite FROM preds")
def _(spark, sf):
    bad = (
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).when(F.col("id") % 7 == 0, F.lit(float("-inf")))
        .when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("load_mw"))
    )
    return fr.predictions(spark, sf).select("id", scalars.finite(bad).alias("finite"))


@query("f18_join_and_split_names", "SELECT series_id, string_agg(DISTINCT station, ' ' ORDER BY station) AS joined, count(DISTINCT station) AS n FROM stations GROUP BY 1")
def _(spark, sf):
    joined = fr.stations(spark, sf).groupBy("series_id").agg(
        scalars.joined_names(F.array_sort(F.collect_set("station"))).alias("joined")
    )
    return joined.withColumn("n", F.size(scalars.split_names("joined")))
