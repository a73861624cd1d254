"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadloom.functions.holidays import holiday_dimension, with_holiday_flag
from loadloom.operators import align, spine, splits
from loadloom.operators.stations import unknown_stations, weighted_mean
from loadloom.plans import evaluation, features, predictions as pred

from . import frames as fr
from .base_sql import lag, local
from .registry import query


@query("j1_outer_align", "SELECT series_id, ts, load_mw, tso_forecast_mw FROM load_frame", "load_mw tso_forecast_mw")
def _(spark, sf):
    return fr.load_frame(spark, sf)


@query("j2_gap_fill", "SELECT series_id, ts, load_mw FROM hourly_full", "load_mw")
def _(spark, sf):
    return spine.fill_gaps(fr.hourly(spark, sf))


J3 = """, a AS (SELECT series_id, ts, CASE WHEN hour(ts) % 2 = 0 THEN load_mw END AS v, load_mw AS only_a FROM hourly WHERE day(ts) < 20),
b AS (SELECT series_id, ts, tso_forecast_mw AS v FROM reference WHERE day(ts) > 10)
SELECT coalesce(a.series_id, b.series_id) AS series_id, coalesce(a.ts, b.ts) AS ts, coalesce(a.v, b.v) AS v, only_a
FROM a FULL JOIN b ON a.series_id = b.series_id AND a.ts = b.ts"""


@query("j3_overlay_cells", J3, "v only_a")
def _(spark, sf):
    a = fr.hourly(spark, sf).filter(F.dayofmonth("ts") < 20).select(
        "series_id", "ts", F.when(F.hour("ts") % 2 == 0, F.col("load_mw")).alias("v"), F.col("load_mw").alias("only_a")
    )
    b = fr.reference(spark, sf).filter(F.dayofmonth("ts") > 10).select("series_id", "ts", F.col("tso_forecast_mw").alias("v"))
    return align.overlay_cells(a, b)


J4 = """, old AS (SELECT series_id, ts, load_mw, temp_c FROM canon WHERE day(ts) < 20),
new AS (SELECT series_id, ts, CASE WHEN hour(ts) <> 3 THEN load_mw + 1 END AS load_mw, CAST(NULL AS DOUBLE) AS temp_c FROM canon WHERE day(ts) > 15)
SELECT * FROM new UNION ALL SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.series_id = o.series_id AND n.ts = o.ts)"""


@query("j4_replace_rows", J4, "load_mw temp_c")
def _(spark, sf):
    c = fr.stored(spark, sf)
    old = c.filter(F.dayofmonth("ts") < 20).select("series_id", "ts", "load_mw", "temp_c")
    new = c.filter(F.dayofmonth("ts") > 15).select(
        "series_id", "ts", F.when(F.hour("ts") != 3, F.col("load_mw") + 1).alias("load_mw"),
        F.lit(None).cast("double").alias("temp_c"),
    )
    return align.replace_rows(old, new)


SCORES = "actual_mw abs_error_mw ape tso_forecast_mw tso_abs_error_mw"


@query("j5_j6_score_join", f"SELECT prediction_id, {', '.join(SCORES.split())} FROM scores", SCORES)
def _(spark, sf):
    return pred.score(fr.predictions(spark, sf), fr.history(spark, sf)).drop("scored_at")


@query("j7_scored_predictions", "SELECT id, series_id, target_time, load_mw, actual_mw, ape, tso_mw FROM scored", "load_mw actual_mw ape tso_mw")
def _(spark, sf):
    p = fr.predictions(spark, sf)
    s = pred.score(p, fr.history(spark, sf))
    return pred.scored_predictions(p, s, latest_only=False).select(
        "id", "series_id", "target_time", "load_mw", "actual_mw", "ape", "tso_mw"
    )


J8 = f""", n AS (SELECT series_id, ts, tso_forecast_mw, {lag(168)} AS naive_seasonal FROM canon)
SELECT f.series_id, f.ts, f.target AS actual, n.naive_seasonal, n.tso_forecast_mw AS day_ahead_reference
FROM feats f JOIN n ON n.series_id = f.series_id AND n.ts = f.ts
WHERE n.naive_seasonal IS NOT NULL AND n.tso_forecast_mw IS NOT NULL"""


@query("j8_references_on_scored_rows", J8, "actual naive_seasonal day_ahead_reference")
def _(spark, sf):
    c = fr.stored(spark, sf)
    base = features.make_features(c, 24).select("series_id", "ts", F.col("target").alias("actual"))
    return align.on_common_rows(base, [evaluation.references(c)])


@query("j9_pair_complete", "SELECT l.series_id, l.ts, l.load_mw AS y_true, r.tso_forecast_mw AS y_pred FROM hist l JOIN hist r ON l.series_id = r.series_id AND l.ts = r.ts WHERE l.load_mw IS NOT NULL AND r.tso_forecast_mw IS NOT NULL", "y_true y_pred")
def _(spark, sf):
    h = fr.history(spark, sf)
    return align.pair_complete(
        h.select("series_id", "ts", F.col("load_mw").alias("y_true")),
        h.select("series_id", "ts", F.col("tso_forecast_mw").alias("y_pred")),
    )


@query("j10_semi_join", "SELECT series_id, ts, target FROM feats WHERE (series_id, ts) IN (SELECT series_id, ts FROM reference)", "target")
def _(spark, sf):
    f = features.make_features(fr.canonical(spark, sf), 24).select("series_id", "ts", "target")
    return f.join(fr.reference(spark, sf).select("series_id", "ts"), ["series_id", "ts"], "left_semi")


@query("j11_anti_join", "SELECT series_id, ts FROM hourly h WHERE NOT EXISTS (SELECT 1 FROM feats f WHERE f.series_id = h.series_id AND f.ts = h.ts)")
def _(spark, sf):
    served = features.make_features(fr.canonical(spark, sf), 24)
    return features.lost_targets(fr.hourly(spark, sf), served)


SPLITS = """, span AS (SELECT series_id, CAST(floor(epoch(min(ts)) / 3600) AS BIGINT) AS h0, CAST(floor(epoch(max(ts)) / 3600) AS BIGINT) AS h1 FROM hist GROUP BY 1),
origins AS (SELECT series_id, k + 1 AS origin_no, h0, h0 + 730 * 24 - 1 + k * 28 * 24 AS te, h1 FROM span, range(0, 400) t(k) WHERE h0 + 730 * 24 - 1 + k * 28 * 24 + 24 <= h1),
splits AS (SELECT series_id, origin_no, make_timestamp(h0 * 3600000000) AS train_start, make_timestamp(te * 3600000000) AS train_end,
  make_timestamp((te + 24) * 3600000000) AS test_start, make_timestamp(least(te + 24 + 42 * 24 - 1, h1) * 3600000000) AS test_end FROM origins)
"""


def _splits(df):
    return splits.rolling_origins(df, 24, 730, 42, 28)


@query("j12_row_to_origin", SPLITS + "SELECT h.series_id, h.ts, s.origin_no, h.load_mw FROM hist h JOIN splits s ON s.series_id = h.series_id AND h.ts BETWEEN s.test_start AND s.test_end", "load_mw")
def _(spark, sf):
    h = fr.history(spark, sf)
    return splits.test_rows(h, _splits(h)).select("series_id", "ts", "origin_no", "load_mw")


@query("j13_holiday_flag", f"SELECT b.series_id, b.ts, h.d IS NOT NULL AS is_holiday FROM hist b LEFT JOIN hol h ON h.d = CAST({local('b.ts')} AS DATE)")
def _(spark, sf):
    return with_holiday_flag(fr.history(spark, sf).select("series_id", "ts"))


@query("j13_order_holidays", "SELECT CAST(d AS TIMESTAMP) AS holiday_date, count(*) AS n FROM orders JOIN hol ON d = CAST(o_orderdate AS DATE) GROUP BY 1")
def _(spark, sf):
    o = fr.table(spark, sf, "orders")
    span = o.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    dim = F.broadcast(holiday_dimension(spark, *span))  # at most 14 rows a year
    return o.join(dim, F.to_date("o_orderdate") == F.col("holiday_date")).groupBy("holiday_date").agg(
        F.count(F.lit(1)).alias("n")
    )


W = "temp_c wind_ms cloud_cover humidity_pct"


@query("j14_a2_station_weighted_mean", f"SELECT series_id, ts, {', '.join(W.split())} FROM weather", W)
def _(spark, sf):
    return weighted_mean(fr.stations(spark, sf), fr.weights(spark, sf), W.split(), strict=True)


@query("j14_unknown_stations", "SELECT DISTINCT station FROM stations WHERE station NOT IN (SELECT station FROM weights WHERE station <> 'st3')")
def _(spark, sf):
    return unknown_stations(fr.stations(spark, sf), fr.weights(spark, sf).filter("station <> 'st3'"))


# --- set operations -----------------------------------------------------------------------


@query("u1_union_kept_incoming", "SELECT series_id, ts, load_mw FROM hourly UNION ALL SELECT series_id, ts, tso_forecast_mw FROM reference", "load_mw")
def _(spark, sf):
    return fr.hourly(spark, sf).unionByName(
        fr.reference(spark, sf).withColumnRenamed("tso_forecast_mw", "load_mw")
    )


@query("u2_union_of_blocks", SPLITS + "SELECT series_id, ts, count(*) AS blocks, max(origin_no) AS origin_no FROM (SELECT h.series_id, h.ts, s.origin_no FROM hist h JOIN splits s ON s.series_id = h.series_id AND h.ts BETWEEN s.test_start AND s.test_end) GROUP BY ALL")
def _(spark, sf):
    h = fr.history(spark, sf)
    return splits.test_rows(h, _splits(h)).groupBy("series_id", "ts").agg(
        F.count(F.lit(1)).alias("blocks"), F.max("origin_no").alias("origin_no")
    )


@query("u4_matched_hours", "SELECT * FROM btl WHERE y_pred IS NOT NULL AND (series_id, ts) IN (SELECT series_id, ts FROM btl WHERE y_pred IS NOT NULL GROUP BY ALL HAVING count(DISTINCT model) = 3)", "y_true y_pred")
def _(spark, sf):
    long = fr.backtest_long(spark, sf).filter("y_pred IS NOT NULL")
    return align.matched_rows(long, "model", 3).select("series_id", "ts", "y_true", "model", "y_pred")


@query("u5_intersect_hours", "SELECT series_id, ts FROM hourly INTERSECT SELECT series_id, ts FROM reference")
def _(spark, sf):
    return fr.hourly(spark, sf).select("series_id", "ts").intersect(fr.reference(spark, sf).select("series_id", "ts"))


@query("u6_missing_hours", "SELECT series_id, ts FROM spine EXCEPT SELECT series_id, ts FROM hourly")
def _(spark, sf):
    return spine.missing_hours(fr.hourly(spark, sf))


@query("u7_missing_names", "SELECT series_id, string_agg(station, ',' ORDER BY station) AS missing FROM (SELECT DISTINCT series_id, station FROM stations EXCEPT SELECT series_id, station FROM stations WHERE ts < TIMESTAMP '2024-01-01 02:00:00') GROUP BY 1")
def _(spark, sf):
    """Stations of a series without a reading in its first two hours, by array difference."""
    early = F.when(F.col("ts") < "2024-01-01 02:00:00", F.col("station"))
    sets = fr.stations(spark, sf).groupBy("series_id").agg(
        F.collect_set(early).alias("have"), F.collect_set("station").alias("own")
    )
    missing = F.array_join(F.array_sort(F.array_except("own", "have")), ",")
    return sets.select("series_id", missing.alias("missing")).filter("missing <> ''")
