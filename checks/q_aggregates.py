"""Aggregations, windows, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loadloom.functions import names
from loadloom.operators import history, islands, latest, quality, scores, spine
from loadloom.operators.fingerprint import fingerprint
from loadloom.operators.resample import latest_revision, to_hourly
from loadloom.operators.twosample import drift_share
from loadloom.plans import features, predictions as pred
from loadloom.sources import tables

from . import frames as fr
from .base_sql import lag, lead, local, metrics, rolling
from .registry import query

M = "mape rmse_mw mae_mw bias_mw"


@query("a1_hourly_mean", "SELECT series_id, ts, load_mw FROM hourly_full", "load_mw")
def _(spark, sf):
    return fr.hourly(spark, sf, complete=True)


@query("a1_hourly_max", "SELECT s.series_id, s.ts, h.load_mw FROM spine s LEFT JOIN (SELECT series_id, date_trunc('hour', ts) AS ts, max(value) AS load_mw FROM slots GROUP BY ALL) h ON h.series_id = s.series_id AND h.ts = s.ts", "load_mw")
def _(spark, sf):
    return to_hourly(fr.readings(spark, sf), aggregate="max")


@query("a3_weight_normalisation", "SELECT station, weight FROM weights", "weight")
def _(spark, sf):
    return fr.weights(spark, sf)


@query("a4_point_metrics", f"SELECT series_id, model, count(*) AS n, count(y_true - y_pred) AS n_scored, {metrics()} FROM btl GROUP BY ALL", M)
def _(spark, sf):
    return scores.point_metrics(fr.backtest_long(spark, sf), ["series_id", "model"])


QUANTILES = """, q AS (SELECT series_id, ts, y_true, y_pred * (0.5 + quantile) AS y_pred, quantile FROM btl, (VALUES (0.1::DOUBLE), (0.5), (0.9)) v(quantile) WHERE model = 'day_ahead_reference')
SELECT series_id, quantile, avg(greatest(quantile * (y_true - y_pred), (quantile - 1) * (y_true - y_pred))) AS pinball FROM q WHERE y_pred IS NOT NULL GROUP BY ALL"""


@query("a5_c37_pinball", QUANTILES, "pinball")
def _(spark, sf):
    q = fr.backtest_long(spark, sf).filter("model = 'day_ahead_reference'").withColumn(
        "quantile", F.explode(F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    )
    return scores.pinball_table(q.withColumn("y_pred", F.col("y_pred") * (0.5 + F.col("quantile"))), ["series_id"])


OVERALL = f", m AS (SELECT series_id, model, count(*) AS n, count(y_true - y_pred) AS n_scored, {metrics()} FROM btl GROUP BY ALL) "


@query("a6_overall_vs_reference", OVERALL + "SELECT m.*, m.mape - r.mape AS mape_vs_reference FROM m JOIN m r ON r.series_id = m.series_id AND r.model = 'day_ahead_reference'", M + " mape_vs_reference")
def _(spark, sf):
    return scores.overall(fr.backtest_long(spark, sf), by=["series_id"])


@query("a7_metrics_by_segment", "SELECT * FROM segs", M)
def _(spark, sf):
    return scores.by_segment(fr.backtest_long(spark, sf))


A8 = """SELECT m.segment_kind, m.segment, m.n, m.mape AS model_mape, r.mape AS reference_mape, m.mape - r.mape AS gap,
  CASE WHEN m.mape - r.mape < 0 THEN 'model wins' ELSE 'reference wins' END AS verdict
FROM segs m JOIN segs r ON r.segment_kind = m.segment_kind AND r.segment = m.segment AND r.model = 'day_ahead_reference'
WHERE m.model = 'trees_weather'"""


@query("a8_t4_versus_reference", A8, "model_mape reference_mape gap")
def _(spark, sf):
    table = scores.versus_reference(scores.by_segment(fr.backtest_long(spark, sf)), "trees_weather")
    return table.orderBy(F.desc("gap"))


@query("a9_error_by_local_hour", f"SELECT hour({local('ts')}) AS local_hour, model, avg({lead('ts')}) AS lead_h, avg(abs((y_true - y_pred) / nullif(y_true, 0))) * 100 AS mape FROM btl GROUP BY ALL", "lead_h mape")
def _(spark, sf):
    return scores.by_local_hour(fr.backtest_long(spark, sf))


@query("a10_rows_per_year", "SELECT series_id, year(ts) AS year, count(*) AS n FROM hist GROUP BY ALL")
def _(spark, sf):
    return quality.rows_per_year(fr.history(spark, sf))


COVER = " UNION ALL ".join(
    f"SELECT series_id, '{c}' AS \"column\", count({c}) AS n_present FROM hist GROUP BY 1"
    for c in ("load_mw", "tso_forecast_mw", "temp_c", "wind_ms", "cloud_cover", "humidity_pct")
)


@query("a10_column_coverage", COVER)
def _(spark, sf):
    return quality.column_coverage(
        fr.history(spark, sf), ["load_mw", "tso_forecast_mw", "temp_c", "wind_ms", "cloud_cover", "humidity_pct"]
    )


RULES = [
    ("load_mw", "in_range(10000, 30000)", "NOT load_mw BETWEEN 10000 AND 30000"),
    ("tso_forecast_mw", "in_range(10000, 30000)", "NOT tso_forecast_mw BETWEEN 10000 AND 30000"),
    ("temp_c", "in_range(-35, 45)", "NOT temp_c BETWEEN -35 AND 45"),
    ("wind_ms", "greater_than_or_equal_to(0)", "wind_ms < 0"),
    ("cloud_cover", "in_range(0, 100)", "NOT cloud_cover BETWEEN 0 AND 100"),
    ("humidity_pct", "in_range(0, 100)", "NOT humidity_pct BETWEEN 0 AND 100"),
]
BROKEN = " UNION ALL ".join(
    f"SELECT series_id, ts, '{c}' AS \"column\", '{k}' AS check_name FROM hist WHERE {w}" for c, k, w in RULES
)


@query(
    "a11_t3_range_violations",
    f""", broken AS ({BROKEN}), top AS (SELECT *, row_number() OVER (PARTITION BY series_id, "column", check_name ORDER BY ts) AS p FROM broken)
    SELECT series_id, "column", check_name, count(*) AS n, string_agg(strftime(ts, '%Y-%m-%d %H:%M'), '; ' ORDER BY ts) FILTER (WHERE p <= 8) AS examples FROM top GROUP BY ALL""",
)
def _(spark, sf):
    found = quality.violation_counts(fr.history(spark, sf))
    stamps = F.transform("examples", lambda e: F.substring(e, 1, 16))
    return found.withColumn("examples", F.array_join(stamps, "; "))


A12 = """, hits AS (SELECT series_id, ts, 'load present but TSO forecast missing' AS name, 'error' AS severity FROM hist WHERE load_mw IS NOT NULL AND tso_forecast_mw IS NULL
  UNION ALL SELECT series_id, ts, 'load missing', 'warning' FROM hist WHERE load_mw IS NULL),
marked AS (SELECT *, CAST(epoch(ts) / 3600 AS BIGINT) - row_number() OVER (PARTITION BY series_id, name ORDER BY ts) AS g FROM hits),
isl AS (SELECT series_id, name, severity, g, min(ts) AS a, max(ts) AS b, count(*) AS h FROM marked GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY series_id, name ORDER BY a) AS p FROM isl)
SELECT series_id, name, severity, CAST(sum(h) AS BIGINT) AS n, count(*) AS groups,
  string_agg(strftime(a, '%Y-%m-%d %H:%M') || ' -> ' || strftime(b, '%Y-%m-%d %H:%M') || '  (' || h || ' h)', '; ' ORDER BY a) FILTER (WHERE p <= 8) AS examples
FROM top GROUP BY ALL"""


@query("a12_cross_column_issues", A12)
def _(spark, sf):
    return quality.cross_column_issues(fr.history(spark, sf)).withColumn("examples", F.array_join("examples", "; "))


@query("a13_duplicate_timestamps", "SELECT series_id, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT series_id, ts, count(*) AS n FROM readings GROUP BY ALL) GROUP BY 1")
def _(spark, sf):
    return spine.duplicate_counts(fr.readings(spark, sf))


@query("a14_coverage_days", "SELECT series_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, CAST(floor((epoch(max(ts)) - epoch(min(ts))) / 86400) + 1 AS BIGINT) AS coverage_days FROM hist GROUP BY 1")
def _(spark, sf):
    return scores.coverage_days(fr.history(spark, sf))


@query("a15_high_water_mark", "SELECT series_id, max(ts) FILTER (WHERE load_mw IS NOT NULL) AS last_actual, max(ts) FILTER (WHERE load_mw IS NOT NULL) + INTERVAL 24 HOUR AS servable_until FROM hist GROUP BY 1")
def _(spark, sf):
    return features.servable_until(fr.history(spark, sf), 24)


PERF = """SELECT series_id, model_version, count(*) AS scored, CASE WHEN count(*) >= 168 THEN 'measuring' ELSE 'accumulating' END AS status, count(*) >= 168 AS sufficient,
  avg(ape) * 100 AS model_mape,
  avg(abs((actual_mw - tso_mw) / nullif(actual_mw, 0))) * 100 AS tso_mape,
  sqrt(avg((actual_mw - load_mw) ** 2)) AS rmse_mw,
  avg(abs(actual_mw - load_mw)) AS mae_mw,
  avg(load_mw - actual_mw) AS bias_mw,
  count(*) >= 168 AND avg(ape) * 100 > 4.0 AS breached FROM standing GROUP BY ALL"""


@query("a16_served_performance", PERF, "model_mape tso_mape rmse_mw mae_mw bias_mw")
def _(spark, sf):
    p = fr.predictions(spark, sf)
    standing = pred.scored_predictions(p, pred.score(p, fr.history(spark, sf)))
    return pred.performance(standing, ["series_id", "model_version"])


@query("a17_horizons_in_play", f"SELECT DISTINCT {lead('ts')} AS horizon FROM hist WHERE {lead('ts')} >= 1")
def _(spark, sf):
    from loadloom.functions.clock import lead_hours

    return fr.history(spark, sf).select(lead_hours("ts").alias("horizon")).distinct().filter("horizon >= 1")


@query("a18_fingerprint", "SELECT DISTINCT series_id, true AS same_when_reordered, true AS other_when_changed, true AS other_when_repeated, true AS other_when_nulled FROM canon")
def _(spark, sf):
    """What the hash promises per series: order does not matter, any change does."""
    c = fr.stored(spark, sf)
    first = F.col("ts") == F.min("ts").over(Window.partitionBy("series_id"))
    marked = c.withColumn("_first", first)
    plain = fingerprint(c, ["series_id"]).select("series_id", F.col("fingerprint").alias("f"))
    variants = {
        "same_when_reordered": c.repartition(7, "ts").sortWithinPartitions(F.desc("ts")),
        "other_when_changed": marked.withColumn("temp_c", F.when(F.col("_first"), F.lit(-77.0)).otherwise(F.col("temp_c"))).drop("_first"),
        "other_when_repeated": c.unionByName(marked.filter("_first").drop("_first")),
        "other_when_nulled": marked.withColumn("is_holiday", F.when(~F.col("_first"), F.col("is_holiday"))).drop("_first"),
    }
    out = plain
    for name, frame in variants.items():
        other = fingerprint(frame, ["series_id"]).select("series_id", F.col("fingerprint").alias("g"))
        same = F.col("f") == F.col("g")
        out = out.join(other, "series_id").withColumn(name, same if name.startswith("same") else ~same).drop("g")
    return out.drop("f")


@query("a19_feature_set_id", "SELECT series_id, substr(sha256(string_agg(DISTINCT station, '|' ORDER BY station)), 1, 10) AS feature_set FROM stations GROUP BY 1")
def _(spark, sf):
    sets = fr.stations(spark, sf).groupBy("series_id").agg(F.collect_set("station").alias("names"))
    return sets.select("series_id", names.feature_set_id_of("names").alias("feature_set"))


@query("a21_log_size", "SELECT count(*) AS n FROM preds")
def _(spark, sf):
    return fr.predictions(spark, sf).agg(F.count(F.lit(1)).alias("n"))


A22 = """, v AS (SELECT series_id, station AS feature, avg(cloud_cover) > 50.5 AS drifted FROM stations GROUP BY ALL)
SELECT series_id, count(*) AS monitored_features, count(*) FILTER (WHERE drifted) AS drifted_features, avg(drifted::INT) AS drift_share,
  coalesce(string_agg(feature, ' ' ORDER BY feature) FILTER (WHERE drifted), '') AS drifted_names FROM v GROUP BY 1"""


@query("a22_drift_share", A22, "drift_share")
def _(spark, sf):
    v = fr.stations(spark, sf).groupBy("series_id", F.col("station").alias("feature")).agg(
        (F.avg("cloud_cover") > 50.5).alias("drifted")
    )
    return drift_share(v, ["series_id"]).withColumn("drifted_names", F.array_join("drifted_names", " "))


CORR = " UNION ALL ".join(
    f"SELECT series_id, '{f}' AS feature, corr({f}, load_mw) AS correlation FROM hist GROUP BY 1"
    for f in ("temp_c", "wind_ms", "cloud_cover", "tso_forecast_mw")
)


@query("a23_feature_correlation", CORR, "correlation")
def _(spark, sf):
    return scores.correlations(
        fr.history(spark, sf), ["temp_c", "wind_ms", "cloud_cover", "tso_forecast_mw"], "load_mw"
    )


# --- window functions --------------------------------------------------------------------


LAGS = (24, 25, 48, 168, 192)


@query("w1_lag_set", f"SELECT series_id, ts, {', '.join(f'{lag(n)} AS load_lag_{n}' for n in LAGS)} FROM hist", " ".join(f"load_lag_{n}" for n in LAGS))
def _(spark, sf):
    h = history.with_history(fr.history(spark, sf), history.lag_hours(24))
    return h.select("series_id", "ts", *[f"load_lag_{n}" for n in LAGS])


@query("w1_lag_by_join", f"SELECT series_id, ts, {lag(24)} AS load_lag_24 FROM hist", "load_lag_24")
def _(spark, sf):
    return history.lag_by_join(fr.history(spark, sf).select("series_id", "ts", "load_mw"), 24).drop("load_mw")


@query("w2_rolling_mean_std", f"SELECT series_id, ts, {rolling('avg')} AS load_roll_mean_24, {rolling('stddev_samp')} AS load_roll_std_24 FROM hourly", "load_roll_mean_24 load_roll_std_24")
def _(spark, sf):
    return history.with_history(fr.hourly(spark, sf), rolling=[(24, 24)]).drop("load_mw")


@query("w3_seasonal_naive", f"SELECT series_id, ts, load_mw, {lag(168)} AS naive_seasonal FROM hourly_full", "load_mw naive_seasonal")
def _(spark, sf):
    return history.seasonal_naive(fr.hourly(spark, sf, complete=True))


W4 = """, e AS (SELECT series_id, ts, abs((actual - day_ahead_reference) / nullif(actual, 0)) * 100 AS ape FROM bt)
SELECT * FROM (SELECT series_id, ts, CASE WHEN count(ape) OVER w >= 360 THEN avg(ape) OVER w END AS rolling_mape FROM e
WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 719 PRECEDING AND CURRENT ROW)) WHERE rolling_mape IS NOT NULL"""


@query("w4_rolling_row_mape", W4, "rolling_mape")
def _(spark, sf):
    from loadloom.functions.errors import ape

    e = fr.backtest_wide(spark, sf).select("series_id", "ts", (ape("actual", "day_ahead_reference") * 100).alias("ape"))
    return history.rolling_rows_mean(e, "ape", "rolling_mape").select("series_id", "ts", "rolling_mape").dropna()


W4T = """, e AS (SELECT series_id, ts, abs((actual - day_ahead_reference) / nullif(actual, 0)) * 100 AS ape FROM bt)
SELECT series_id, ts, CASE WHEN count(ape) OVER w >= 100 THEN avg(ape) OVER w END AS rolling_mape FROM e
WINDOW w AS (PARTITION BY series_id ORDER BY ts RANGE BETWEEN INTERVAL 719 HOUR PRECEDING AND CURRENT ROW)"""


@query("w4_rolling_time_mape", W4T, "rolling_mape")
def _(spark, sf):
    from loadloom.functions.errors import ape

    e = fr.backtest_wide(spark, sf).select("series_id", "ts", (ape("actual", "day_ahead_reference") * 100).alias("ape"))
    return history.rolling_time_mean(e, "ape", "rolling_mape", 720, 100).select("series_id", "ts", "rolling_mape")


@query("w5_latest_per_target", "SELECT id, series_id, target_time, predicted_at, model_version, load_mw FROM preds QUALIFY row_number() OVER (PARTITION BY series_id, target_time, horizon_hours, model_version ORDER BY predicted_at DESC, id DESC) = 1", "load_mw")
def _(spark, sf):
    return tables.latest_per_target(fr.predictions(spark, sf)).drop("horizon_hours")


@query("w6_runs_of_missing_hours", ", m AS (SELECT series_id, ts FROM spine EXCEPT SELECT series_id, ts FROM hourly), g AS (SELECT *, CAST(epoch(ts) / 3600 AS BIGINT) - row_number() OVER (PARTITION BY series_id ORDER BY ts) AS k FROM m) SELECT series_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS hours FROM g GROUP BY series_id, k")
def _(spark, sf):
    return islands.hour_runs(spine.missing_hours(fr.hourly(spark, sf)))


@query("w6_runs_across_blocks", ", g AS (SELECT series_id, ts, CAST(epoch(ts) / 3600 AS BIGINT) - row_number() OVER (PARTITION BY series_id ORDER BY ts) AS k FROM hourly) SELECT series_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS hours FROM g GROUP BY series_id, k")
def _(spark, sf):
    return islands.hour_runs(fr.hourly(spark, sf), size=7)


@query("w6_axis_breaks", """, d AS (SELECT series_id, date_trunc('hour', ts) AS ts FROM slots),
o AS (SELECT series_id, ts, lag(ts) OVER (PARTITION BY series_id ORDER BY ts) AS p FROM d)
SELECT series_id, CASE WHEN p = ts THEN 'duplicate' ELSE 'gap' END AS kind, CASE WHEN p = ts THEN ts ELSE p + INTERVAL 1 HOUR END AS first_ts,
  CASE WHEN p = ts THEN ts ELSE ts - INTERVAL 1 HOUR END AS last_ts, CASE WHEN p = ts THEN 1 ELSE CAST((epoch(ts) - epoch(p)) / 3600 AS BIGINT) - 1 END AS hours
FROM o WHERE p = ts OR epoch(ts) - epoch(p) > 3600""")
def _(spark, sf):
    """Gaps and surplus rows of an axis in one pass, with blocks far smaller than a series."""
    rows = latest_revision(fr.readings(spark, sf)).select("series_id", F.date_trunc("hour", "ts").alias("ts"))
    return spine.continuity(rows, size=11)


@query("w7_last_revision", "SELECT series_id, ts, value FROM slots", "value")
def _(spark, sf):
    return latest_revision(fr.readings(spark, sf))


@query("w8_last_block_wins", "SELECT series_id, target_time, arg_max(load_mw, id) AS y_pred, max(id) AS origin_no FROM preds GROUP BY ALL", "y_pred")
def _(spark, sf):
    blocks = fr.predictions(spark, sf).select("series_id", "target_time", F.col("load_mw").alias("y_pred"), F.col("id").alias("origin_no"))
    return latest.last_block_wins(blocks, "y_pred", "origin_no", ["series_id", "target_time"])


@query("w9_ranked_models", OVERALL + "SELECT series_id, model, mape, rank() OVER (PARTITION BY series_id ORDER BY mape) AS rank FROM m", "mape")
def _(spark, sf):
    table = scores.point_metrics(fr.backtest_long(spark, sf), ["series_id", "model"])
    return scores.ranked(table, ["series_id"]).select("series_id", "model", "mape", "rank")


# --- sorts, limits, top-k ------------------------------------------------------------------


@query("t1_time_order", "SELECT series_id, ts, load_mw FROM hourly ORDER BY series_id, ts", "load_mw")
def _(spark, sf):
    return fr.hourly(spark, sf).orderBy("series_id", "ts")


@query("t2_top_by_gain", "SELECT l_partkey AS feature, sum(l_extendedprice) AS gain FROM lineitem GROUP BY 1 ORDER BY gain DESC, feature LIMIT 20", "gain")
def _(spark, sf):
    gains = fr.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("feature")).agg(
        F.sum("l_extendedprice").alias("gain")
    )
    return gains.orderBy(F.desc("gain"), "feature").limit(20)


@query("t5_preferred_order", OVERALL + "SELECT series_id, model, mape, row_number() OVER (PARTITION BY series_id ORDER BY CASE model WHEN 'naive_seasonal' THEN 1 WHEN 'day_ahead_reference' THEN 3 ELSE 5 END, model) AS place FROM m", "mape")
def _(spark, sf):
    from pyspark.sql import Window

    table = scores.point_metrics(fr.backtest_long(spark, sf), ["series_id", "model"])
    order = F.array_position(F.array(*[F.lit(m) for m in scores.TABLE_ORDER]), F.col("model"))
    place = F.row_number().over(Window.partitionBy("series_id").orderBy(F.when(order == 0, 99).otherwise(order), "model"))
    return scores.present_in_order(table.select("series_id", "model", "mape", place.alias("place")))


@query("t6_first_available", "SELECT series_id, 'trees_weather' AS model FROM btl WHERE model = 'trees_weather' GROUP BY 1")
def _(spark, sf):
    return scores.primary_model(fr.backtest_long(spark, sf), ["series_id"])


@query("t7_latest_check", "SELECT arg_max(event_id, ts) AS event_id, user_id, max(ts) AS at FROM events GROUP BY user_id")
def _(spark, sf):
    newest = pred.newest(fr.events(spark, sf).select("event_id", "user_id", F.col("ts").alias("at")), ["user_id"], "at")
    return newest

