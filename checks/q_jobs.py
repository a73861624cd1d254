"""Composite data jobs: dataset, features, splits, log, monitoring, decisions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loadloom.operators import quality, reference_window as ref, scores, spine, splits, twosample
from loadloom.plans import dataset, features, folders, lifecycle, monitoring, predictions as pred, revisions
from loadloom.session import shared_dir, through_table
from loadloom.sources import canonical, tables

from . import frames as fr
from .base_sql import CANON, FEATURES, feature_cte, metrics, to_utc
from .q_joins import SPLITS
from .registry import query

CANON_COLS = ", ".join(CANON.split())


@query("c1_hourly_spine", "SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM hist GROUP BY series_id")
def _(spark, sf):
    return spine.hourly_spine(fr.history(spark, sf))


@query("c2_build_dataset", "SELECT * FROM canon", CANON)
def _(spark, sf):
    return fr.canonical(spark, sf)


C3 = f""", old AS (SELECT * REPLACE ('run-old' AS data_source_version) FROM canon WHERE day(ts) < 12),
new AS (SELECT * REPLACE (CASE WHEN hour(ts) <> 3 THEN load_mw + 1 END AS load_mw, 'run-new' AS data_source_version) FROM canon WHERE day(ts) BETWEEN 10 AND 11 OR day(ts) > 15),
merged AS (SELECT * FROM new UNION ALL SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.series_id = o.series_id AND n.ts = o.ts))
SELECT a.series_id, a.ts, {CANON_COLS}, c.is_holiday, m.data_source_version FROM axis a JOIN (SELECT series_id, ts, is_holiday FROM canon) c ON c.series_id = a.series_id AND c.ts = a.ts
LEFT JOIN (SELECT * EXCLUDE (is_holiday) FROM merged) m ON m.series_id = a.series_id AND m.ts = a.ts"""


@query("c3_merge_trailing_pull", C3, CANON)
def _(spark, sf):
    """The hours of days 12 to 15 are in neither side and come back as null rows."""
    c = fr.stored(spark, sf)
    d = F.dayofmonth("ts")
    old = c.filter(d < 12).withColumn("data_source_version", F.lit("run-old"))
    new = c.filter(d.between(10, 11) | (d > 15)).withColumns(
        {"load_mw": F.when(F.hour("ts") != 3, F.col("load_mw") + 1), "data_source_version": F.lit("run-new")}
    )
    return dataset.merge_datasets(old, new)


NOW = "2024-01-31 09:30:00"


@query("c4_repull_window", f""", s AS (SELECT h.series_id, l.last_success, h.last_actual FROM (SELECT 'u' || (user_id % 40) AS series_id, max(ts) AS last_actual FROM events GROUP BY 1) h
  LEFT JOIN (SELECT series_id, max("at") AS last_success FROM pevents WHERE pipeline = 'ingest' AND series_id <> 'u3' AND "at" < TIMESTAMP '2024-01-15' GROUP BY 1) l USING (series_id))
SELECT series_id, coalesce(last_success, last_actual) AS resume_from,
  CASE WHEN coalesce(last_success, last_actual) < TIMESTAMP '2024-01-17' THEN date_trunc('day', coalesce(last_success, last_actual)) ELSE TIMESTAMP '2024-01-17' END AS window_start,
  TIMESTAMP '2024-02-02' AS window_end FROM s""")
def _(spark, sf):
    e = fr.events(spark, sf).select(F.concat(F.lit("u"), F.col("user_id") % 40).alias("series_id"), "ts", F.col("value").alias("load_mw"))
    past = fr.pipeline_events(spark, sf).filter("pipeline = 'ingest' AND series_id <> 'u3' AND at < '2024-01-15'")
    done = lifecycle.last_success(past, NOW, ["series_id"]).select("series_id", "last_success")
    state = dataset.resume_points(e, done).select("series_id", "resume_from")
    return dataset.trailing_window(state, NOW, 14)


@query("c5_rebuild_decision", """, k AS (SELECT DISTINCT 's' || (o_custkey % 9) AS series_id FROM orders),
e AS (SELECT series_id, count(*) AS hours, min(ts) AS first_ts FROM hist WHERE series_id <> 's1' OR ts > TIMESTAMP '2001-10-01' GROUP BY 1)
SELECT k.series_id, coalesce(hours, 0) AS hours, 1656::BIGINT AS needed,
  CASE WHEN hours IS NULL THEN 'no dataset' WHEN hours < 1656 AND first_ts > TIMESTAMP '1995-01-01' + INTERVAL 1 DAY THEN 'too short and starts late' ELSE 'none' END AS rebuild_reason
FROM k LEFT JOIN e USING (series_id)""")
def _(spark, sf):
    known = fr.table(spark, sf, "orders").select(F.concat(F.lit("s"), F.col("o_custkey") % 9).alias("series_id")).distinct()
    stored = fr.history(spark, sf).filter("series_id <> 's1' OR ts > '2001-10-01'")
    return dataset.rebuild_decision(known, stored, "1995-01-01", 60, 24, 168)


@query("c6_archive_then_forecast", ", a AS (SELECT series_id, ts, temp_c, wind_ms FROM weather WHERE ts <= TIMESTAMP '2024-01-20'), f AS (SELECT series_id, ts, temp_c + 1 AS temp_c, wind_ms + 1 AS wind_ms FROM weather) SELECT coalesce(a.series_id, f.series_id) AS series_id, coalesce(a.ts, f.ts) AS ts, coalesce(a.temp_c, f.temp_c) AS temp_c, coalesce(a.wind_ms, f.wind_ms) AS wind_ms FROM a FULL JOIN f ON a.series_id = f.series_id AND a.ts = f.ts", "temp_c wind_ms")
def _(spark, sf):
    w = fr.weather(spark, sf).select("series_id", "ts", "temp_c", "wind_ms")
    forecast = w.withColumns({"temp_c": F.col("temp_c") + 1, "wind_ms": F.col("wind_ms") + 1})
    return dataset.archive_then_forecast(w, forecast, "2024-01-20")


C7 = """, faulty AS (SELECT * REPLACE (CASE WHEN hour(ts) = 4 THEN NULL ELSE load_mw * 250 END AS load_mw, tso_forecast_mw * 250 AS tso_forecast_mw) FROM canon WHERE NOT (day(ts) = 9 AND hour(ts) BETWEEN 3 AND 7)),
issues AS (
  SELECT series_id, 'missing hours' AS name, 'error' AS severity, count(*) AS n FROM (SELECT series_id, ts FROM axis EXCEPT SELECT series_id, ts FROM faulty) GROUP BY 1
  UNION ALL SELECT series_id, 'schema: load_mw failed in_range(10000, 30000)', 'error', count(*) FROM faulty WHERE NOT load_mw BETWEEN 10000 AND 30000 GROUP BY 1
  UNION ALL SELECT series_id, 'schema: tso_forecast_mw failed in_range(10000, 30000)', 'error', count(*) FROM faulty WHERE NOT tso_forecast_mw BETWEEN 10000 AND 30000 GROUP BY 1
  UNION ALL SELECT series_id, 'load present but TSO forecast missing', 'error', count(*) FROM faulty WHERE load_mw IS NOT NULL AND tso_forecast_mw IS NULL GROUP BY 1
  UNION ALL SELECT series_id, 'load missing', 'warning', count(*) FROM faulty WHERE load_mw IS NULL GROUP BY 1)
SELECT * FROM issues"""


@query("c7_validation_report", C7)
def _(spark, sf):
    faulty = fr.stored(spark, sf).filter(~((F.dayofmonth("ts") == 9) & F.hour("ts").between(3, 7))).withColumns(
        {"load_mw": F.when(F.hour("ts") != 4, F.col("load_mw") * 250), "tso_forecast_mw": F.col("tso_forecast_mw") * 250}
    )
    return quality.validate(faulty).select("series_id", "name", "severity", "n")


@query("c8_make_features", "SELECT * FROM feats", FEATURES + " target")
def _(spark, sf):
    return features.make_features(fr.canonical(spark, sf), 24)


PAST = "TIMESTAMP '2024-01-25 12:00:00'"
INF = f""", past AS (SELECT * FROM canon WHERE ts <= {PAST}),
fc AS (SELECT series_id, ts, temp_c + 1 AS temp_c, wind_ms, cloud_cover, humidity_pct FROM weather WHERE ts > {PAST} - INTERVAL 2 DAY),
inf AS (SELECT coalesce(p.series_id, f.series_id) AS series_id, coalesce(p.ts, f.ts) AS ts, p.load_mw, p.tso_forecast_mw,
  coalesce(p.temp_c, f.temp_c) AS temp_c, coalesce(p.wind_ms, f.wind_ms) AS wind_ms, coalesce(p.cloud_cover, f.cloud_cover) AS cloud_cover,
  coalesce(p.humidity_pct, f.humidity_pct) AS humidity_pct FROM past p FULL JOIN fc f ON p.series_id = f.series_id AND p.ts = f.ts),
inf_axis AS (SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM inf GROUP BY 1),
inf_full AS (SELECT a.series_id, a.ts, {CANON_COLS} FROM inf_axis a LEFT JOIN inf i ON i.series_id = a.series_id AND i.ts = a.ts)
"""


def _serving(spark, sf):
    cut = F.lit("2024-01-25 12:00:00").cast("timestamp")
    history = fr.stored(spark, sf).filter(F.col("ts") <= cut)
    w = fr.weather(spark, sf).filter(F.col("ts") > cut - F.make_dt_interval(days=F.lit(2)))
    return history, w.withColumn("temp_c", F.col("temp_c") + 1)


@query("c9_inference_frame", INF + f"SELECT i.series_id, i.ts, {CANON_COLS}, 'serving' AS data_source_version FROM inf_full i", CANON)
def _(spark, sf):
    return features.inference_frame(*_serving(spark, sf)).drop("is_holiday")


TARGETS = """, last_load AS (SELECT series_id, max(ts) AS m FROM past WHERE load_mw IS NOT NULL GROUP BY 1),
targets AS (SELECT series_id, unnest(generate_series(m + INTERVAL 1 HOUR, m + INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS ts FROM last_load)
"""
SERVED = INF + TARGETS + f", serving AS ({feature_cte('inf_full', False)}) "


@query("c10_features_for_targets", SERVED + f"SELECT series_id, ts, {', '.join(FEATURES.split())} FROM serving WHERE (series_id, ts) IN (SELECT series_id, ts FROM targets)", FEATURES)
def _(spark, sf):
    history, w = _serving(spark, sf)
    return features.features_for_targets(history, w, 24, features.target_hours(history, 24))


@query("c10_lost_targets", SERVED + "SELECT series_id, ts FROM targets EXCEPT SELECT series_id, ts FROM serving")
def _(spark, sf):
    history, w = _serving(spark, sf)
    targets = features.target_hours(history, 24)
    return features.lost_targets(targets, features.features_for_targets(history, w, 24, targets))


@query("c11_target_hours", ", last_load AS (SELECT series_id, max(ts) AS m FROM hist WHERE load_mw IS NOT NULL GROUP BY 1) SELECT series_id, unnest(generate_series(m + INTERVAL 1 HOUR, m + INTERVAL 36 HOUR, INTERVAL 1 HOUR)) AS ts FROM last_load")
def _(spark, sf):
    return features.target_hours(fr.history(spark, sf), 36)


@query("c12_local_day_hours", f"SELECT day, {to_utc('day')} + to_hours(k) AS ts FROM (SELECT DISTINCT o_orderdate AS day FROM orders), range(0, 24) t(k)")
def _(spark, sf):
    days = fr.table(spark, sf, "orders").select(F.col("o_orderdate").alias("day")).distinct()
    return features.local_day_hours(days)


C14 = """, e AS (SELECT series_id, max(ts) - INTERVAL 60 DAY + INTERVAL 1 HOUR AS v0 FROM hist GROUP BY 1)
SELECT h.series_id, h.ts, CASE WHEN h.ts <= v0 - INTERVAL 24 HOUR THEN 'train' WHEN h.ts >= v0 THEN 'validation' ELSE 'embargo' END AS block FROM hist h JOIN e USING (series_id)"""


@query("c14_chronological_split", C14)
def _(spark, sf):
    return splits.chronological_split(fr.history(spark, sf).select("series_id", "ts"), 60, 24)


@query("c15_rolling_origins", SPLITS + "SELECT *, 24::BIGINT AS horizon FROM splits")
def _(spark, sf):
    return splits.rolling_origins(fr.history(spark, sf), 24, 730, 42, 28)


@query("c16_end_anchored_start", "SELECT series_id, date_trunc('day', max(ts) FILTER (WHERE load_mw IS NOT NULL) - INTERVAL 364 DAY) AS first_test_start FROM hist GROUP BY 1")
def _(spark, sf):
    return splits.end_anchored_start(fr.history(spark, sf), 28, 13)


@query("c20_score_log_upsert", "SELECT prediction_id, actual_mw + CASE WHEN year(p.target_time) >= 1998 THEN 1 ELSE 0 END AS actual_mw FROM scores s JOIN preds p ON p.id = s.prediction_id", "actual_mw")
def _(spark, sf):
    """First pass scores everything; revised actuals of later years replace those scores."""
    p, actuals = fr.predictions(spark, sf), fr.history(spark, sf)
    old = pred.score(p, actuals)
    revised = actuals.filter(F.year("ts") >= 1998).withColumn("load_mw", F.col("load_mw") + 1)
    return pred.upsert_scores(old, pred.score(p, revised)).select("prediction_id", "actual_mw")


@query("c20_rescore_table", "SELECT prediction_id, actual_mw, ape FROM scores", "actual_mw ape")
def _(spark, sf):
    """The stored score table, scored twice; the second run changes nothing."""
    out = shared_dir(spark, "scores")
    p, actuals = fr.predictions(spark, sf), fr.history(spark, sf)
    for _ in range(2):
        pred.rescore(spark, p, out, actuals, grain="month")
    return tables.read_scores(spark, out).select("prediction_id", "actual_mw", "ape")


FIRST_PULL, SECOND_PULL = "2000-01-01 00:00:00", "2000-02-01 00:00:00"


def _revised_history(spark, sf):
    """Two pulls, the second of them with other values from 1998 on; its changed hours."""
    path, actuals = shared_dir(spark, "revisions"), fr.history(spark, sf)
    revisions.apply_revisions(spark, path, actuals, FIRST_PULL)
    later = actuals.filter(F.year("ts") >= 1997).withColumn("load_mw", F.col("load_mw") + F.when(F.year("ts") >= 1998, 1).otherwise(0))
    changed = revisions.apply_revisions(spark, path, later, SECOND_PULL)
    return revisions.read_history(spark, path, revisions.history_schema(actuals)), changed


W7 = f""", later AS (SELECT * FROM hist WHERE ts >= TIMESTAMP '1998-01-01' AND load_mw IS NOT NULL)
SELECT h.series_id, h.ts, h.load_mw, TIMESTAMP '{FIRST_PULL}' AS valid_from, CASE WHEN l.ts IS NOT NULL THEN TIMESTAMP '{SECOND_PULL}' END AS valid_to
FROM hist h LEFT JOIN later l ON l.series_id = h.series_id AND l.ts = h.ts
UNION ALL SELECT series_id, ts, load_mw + 1, TIMESTAMP '{SECOND_PULL}', NULL FROM later"""


@query("w7_revision_intervals", W7, "load_mw")
def _(spark, sf):
    """Every value with the interval in which it was the known one."""
    history, _ = _revised_history(spark, sf)
    return history.select("series_id", "ts", "load_mw", "valid_from", "valid_to")


@query("c20_score_as_known_at", "SELECT prediction_id, actual_mw, ape FROM scores", "actual_mw ape")
def _(spark, sf):
    """Scores as they were between the two pulls, from the history that has both."""
    history, _ = _revised_history(spark, sf)
    return revisions.score_as_known(fr.predictions(spark, sf), history, "2000-01-15 00:00:00").select("prediction_id", "actual_mw", "ape")


@query("c20_rescore_changed", "SELECT prediction_id, actual_mw + CASE WHEN year(p.target_time) >= 1998 THEN 1 ELSE 0 END AS actual_mw FROM scores s JOIN preds p ON p.id = s.prediction_id", "actual_mw")
def _(spark, sf):
    """Stored scores, redone for the changed hours only."""
    out, p = shared_dir(spark, "changed-scores"), fr.predictions(spark, sf)
    history, changed = _revised_history(spark, sf)
    pred.rescore(spark, p, out, revisions.as_of(history, "2000-01-15 00:00:00"), grain="month")
    revisions.rescore_changed(spark, p, out, history, changed, grain="month")
    return tables.read_scores(spark, out).select("prediction_id", "actual_mw")


@query("c21_standing_scored", "SELECT id, series_id, target_time, load_mw, actual_mw, ape FROM standing WHERE target_time >= TIMESTAMP '1997-01-01'", "load_mw actual_mw ape")
def _(spark, sf):
    p = fr.predictions(spark, sf)
    s = pred.scored_predictions(p, pred.score(p, fr.history(spark, sf)), since="1997-01-01")
    return s.select("id", "series_id", "target_time", "load_mw", "actual_mw", "ape")


@query("c22_served_forecast", "SELECT id, series_id, target_time, load_mw FROM preds p JOIN (SELECT series_id AS s, max(target_time) AS m FROM preds GROUP BY 1) x ON x.s = p.series_id AND p.target_time >= m - INTERVAL 30 DAY QUALIFY row_number() OVER (PARTITION BY series_id, target_time, horizon_hours, model_version ORDER BY predicted_at DESC, id DESC) = 1", "load_mw")
def _(spark, sf):
    return pred.served_forecast(fr.predictions(spark, sf), 30).select("id", "series_id", "target_time", "load_mw")


WINDOWS = ", win AS (SELECT series_id, max(ts) - INTERVAL 14 DAY AS cs, max(ts) AS ce FROM hist GROUP BY 1) "
SEASONAL = " OR ".join(
    f"(h.ts BETWEEN cs - INTERVAL {y} YEAR - INTERVAL 7 DAY AND ce - INTERVAL {y} YEAR + INTERVAL 7 DAY)" for y in (1, 2, 3)
)
TRAILING = "(h.ts >= cs - INTERVAL 14 DAY AND h.ts < cs)"


@query("c23_trailing_reference", WINDOWS + f"SELECT h.series_id, h.ts, h.load_mw FROM hist h JOIN win USING (series_id) WHERE {TRAILING}", "load_mw")
def _(spark, sf):
    h = fr.history(spark, sf).select("series_id", "ts", "load_mw")
    return ref.trailing_reference(h, ref.current_windows(h))


@query("c24_u3_seasonal_reference", WINDOWS + f"SELECT h.series_id, h.ts, h.load_mw FROM hist h JOIN win USING (series_id) WHERE {SEASONAL}", "load_mw")
def _(spark, sf):
    h = fr.history(spark, sf).select("series_id", "ts", "load_mw")
    return ref.seasonal_reference(h, ref.current_windows(h))


C25 = WINDOWS + f""", c AS (SELECT h.series_id, any_value(cs) AS cs, any_value(ce) AS ce, count(*) FILTER (WHERE h.ts BETWEEN cs AND ce) AS current_rows,
  count(*) FILTER (WHERE {SEASONAL}) AS s, count(*) FILTER (WHERE {TRAILING}) AS t FROM hist h JOIN win USING (series_id) GROUP BY 1)
SELECT series_id, cs AS current_start, ce AS current_end, current_rows, CASE WHEN s >= 300 THEN 'seasonal' ELSE 'trailing' END AS reference_strategy,
  CASE WHEN s >= 300 THEN s ELSE t END AS reference_rows, s AS seasonal_rows, t AS trailing_rows,
  CASE WHEN s >= 300 THEN 'same weeks in 3 previous year(s): ' || strftime(cs - INTERVAL 1 YEAR - INTERVAL 7 DAY, '%Y-%m-%d') || '..' || strftime(ce - INTERVAL 1 YEAR + INTERVAL 7 DAY, '%Y-%m-%d') || ', '
    || strftime(cs - INTERVAL 2 YEAR - INTERVAL 7 DAY, '%Y-%m-%d') || '..' || strftime(ce - INTERVAL 2 YEAR + INTERVAL 7 DAY, '%Y-%m-%d') || ', '
    || strftime(cs - INTERVAL 3 YEAR - INTERVAL 7 DAY, '%Y-%m-%d') || '..' || strftime(ce - INTERVAL 3 YEAR + INTERVAL 7 DAY, '%Y-%m-%d')
  ELSE '14 days immediately before ' || strftime(cs, '%Y-%m-%d') END AS reference_detail FROM c"""


@query("c25_choose_reference", C25)
def _(spark, sf):
    h = fr.history(spark, sf).select("series_id", "ts", "load_mw")
    return ref.choose_reference(ref.tag_windows(h, ref.current_windows(h)), min_rows=300, fallback_to_trailing=True)


def two_sample_sql(samples: str, extra: str = "feature") -> str:
    """KS and Wasserstein per group over a relation ``(group, value, is_current)``."""
    g = extra
    return f""", smp AS ({samples}),
vals AS (SELECT {g}, value AS v, count(*) FILTER (WHERE is_current) AS c, count(*) FILTER (WHERE NOT is_current) AS r FROM smp WHERE value IS NOT NULL GROUP BY ALL),
cum AS (SELECT *, lead(v) OVER w AS nv, sum(c) OVER (PARTITION BY {g} ORDER BY v) AS cc, sum(r) OVER (PARTITION BY {g} ORDER BY v) AS rr,
  sum(c) OVER (PARTITION BY {g}) AS n_c, sum(r) OVER (PARTITION BY {g}) AS n_r FROM vals WINDOW w AS (PARTITION BY {g} ORDER BY v)),
dist AS (SELECT {g}, CAST(max(n_c) AS BIGINT) AS n_current, CAST(max(n_r) AS BIGINT) AS n_reference, max(abs(cc / n_c - rr / n_r)) AS ks,
  sum(abs(cc / n_c - rr / n_r) * coalesce(nv - v, 0)) AS wasserstein FROM cum GROUP BY {g}),
dev AS (SELECT {g}, stddev_pop(value) FILTER (WHERE NOT is_current) AS reference_std FROM smp GROUP BY {g}),
stats AS (SELECT dist.*, reference_std FROM dist JOIN dev USING ({g}))
"""


LONG = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {f} AS value, ts >= TIMESTAMP '2000-01-01' AS is_current FROM hist"
    for f in ("load_mw", "tso_forecast_mw", "temp_c", "wind_ms", "cloud_cover")
)


def _samples(spark, sf):
    cols = ["load_mw", "tso_forecast_mw", "temp_c", "wind_ms", "cloud_cover"]
    return fr.history(spark, sf).withColumn("is_current", F.col("ts") >= "2000-01-01").unpivot(
        ["is_current"], cols, "feature", "value"
    )


@query("c26_two_sample_whole_table", two_sample_sql(LONG) + "SELECT * FROM stats", "ks wasserstein reference_std")
def _(spark, sf):
    """Any sample size: quantile buckets spread the ordered part of each feature."""
    return twosample.two_sample(_samples(spark, sf), ["feature"], buckets=64)


P_VALUE = """CASE WHEN lam < 0.04 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101),
  lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2 * k * k * lam))))) END"""
VERDICT = f""", judged AS (SELECT *, ks * ks * (n_current * n_reference / (n_current + n_reference)) AS lam FROM stats),
scored2 AS (SELECT * EXCLUDE (lam), {P_VALUE} AS ks_p_value, wasserstein / greatest(reference_std, 0.001) AS wasserstein_normed FROM judged),
verdicts AS (SELECT *, ks_p_value < 0.05 AS drifted_by_p_value, wasserstein_normed >= 0.1 AS drifted_by_distance FROM scored2)
"""
SMALL = """SELECT series_id || ':' || station AS feature, temp_c AS value, day(ts) > 20 AS is_current FROM stations
  UNION ALL SELECT series_id || ':cloud', cloud_cover, day(ts) > 20 FROM stations"""


@query("c26_drift_verdicts", two_sample_sql(SMALL) + VERDICT + "SELECT *, 'ks_p_value' AS method, drifted_by_p_value AS drifted FROM verdicts", "ks wasserstein reference_std ks_p_value wasserstein_normed")
def _(spark, sf):
    """Both scores and verdicts of every group, small and large; here the p-value decides."""
    s = fr.stations(spark, sf).withColumn("is_current", F.dayofmonth("ts") > 20)
    per_station = s.select(F.concat_ws(":", "series_id", "station").alias("feature"), F.col("temp_c").alias("value"), "is_current")
    per_series = s.select(F.concat(F.col("series_id"), F.lit(":cloud")).alias("feature"), F.col("cloud_cover").alias("value"), "is_current")
    return twosample.drift_verdict(twosample.two_sample(per_station.unionByName(per_series), ["feature"]), twosample.P_VALUE)


# Equal samples of k values: the reflected paths have a closed form.
FORTY = """SELECT feature, value, is_current FROM (SELECT series_id || ':' || station AS feature, temp_c + 0.001 * hour(ts) + 0.00001 * day(ts) + 0.0000001 * row_number() OVER (PARTITION BY series_id, station ORDER BY ts) AS value, day(ts) > 20 AS is_current,
  row_number() OVER (PARTITION BY series_id, station, day(ts) > 20 ORDER BY ts) AS k FROM stations WHERE temp_c IS NOT NULL) WHERE k <= 40"""
EXACT_P = two_sample_sql(FORTY) + """, equal_sized AS (SELECT feature, n_current AS n, CAST(round(ks * n_current) AS BIGINT) AS k FROM stats WHERE n_current = 40 AND n_reference = 40)
SELECT feature, n, least(1.0, 2 * list_sum(list_transform(range(1, n // k + 1), lambda i: CASE WHEN i % 2 = 1 THEN 1.0 ELSE -1.0 END
  * exp(2 * lgamma(n + 1) - lgamma(n - i * k + 1) - lgamma(n + i * k + 1))))) AS ks_p_exact, 'ks_p_exact' AS method FROM equal_sized"""


@query("c26_exact_p_value", EXACT_P, "ks_p_exact")
def _(spark, sf):
    """Small samples of equal size: the lattice-path p-value against its closed form."""
    s = fr.stations(spark, sf).filter("temp_c IS NOT NULL").withColumn("is_current", F.dayofmonth("ts") > 20)
    name = F.concat_ws(":", "series_id", "station")
    of_station, of_side = Window.partitionBy("series_id", "station").orderBy("ts"), Window.partitionBy("series_id", "station", "is_current").orderBy("ts")
    # No ties: every value gets a trace of its place.
    value = F.col("temp_c") + 0.001 * F.hour("ts") + 0.00001 * F.dayofmonth("ts") + 0.0000001 * F.row_number().over(of_station)
    some = s.select(name.alias("feature"), value.alias("value"), "is_current", F.row_number().over(of_side).alias("k")).filter("k <= 40")
    found = twosample.drift_verdict(twosample.two_sample(some, ["feature"]), twosample.BY_SIZE)
    return found.filter("n_current = 40 AND n_reference = 40").select("feature", F.col("n_current").alias("n"), "ks_p_exact", "method")


MON = "load_lag_24 load_lag_25 load_lag_48 load_lag_168 load_lag_192 load_roll_mean_24 load_roll_std_24 temp_c temp_sq wind_ms cloud_cover".split()
MONLONG = " UNION ALL ".join(
    f"SELECT series_id || '|' || '{f}' AS feature, {f} AS value, is_current FROM tagged" for f in MON
)
C27 = f""", win AS (SELECT series_id, max(ts) - INTERVAL 10 DAY AS cs, max(ts) AS ce FROM canon GROUP BY 1),
tagged AS (SELECT f.*, true AS is_current FROM feats f JOIN win USING (series_id) WHERE ts BETWEEN cs AND ce
  UNION ALL SELECT f.*, false FROM feats f JOIN win USING (series_id) WHERE ts >= cs - INTERVAL 10 DAY AND ts < cs),
sizes AS (SELECT win.series_id, ce, count(*) FILTER (WHERE is_current) AS current_rows, count(*) FILTER (WHERE NOT is_current) AS reference_rows FROM win LEFT JOIN tagged USING (series_id) GROUP BY ALL)
{two_sample_sql(MONLONG)}{VERDICT}, per AS (SELECT split_part(feature, '|', 1) AS series_id, split_part(feature, '|', 2) AS feature, drifted_by_distance AS drifted FROM verdicts),
share AS (SELECT series_id, avg(drifted::INT) AS drift_share, count(*) FILTER (WHERE drifted) AS drifted_features, coalesce(string_agg(feature, ' ' ORDER BY feature) FILTER (WHERE drifted), '') AS drifted_names FROM per GROUP BY 1),
sp AS (SELECT s.series_id, count(*) AS scored_predictions, avg(abs(c.tso_forecast_mw * 3 - c.load_mw) / c.load_mw) * 100 AS m
  FROM win s JOIN canon c ON c.series_id = s.series_id AND c.ts BETWEEN cs AND ce WHERE c.load_mw IS NOT NULL AND c.load_mw <> 0 AND c.tso_forecast_mw IS NOT NULL GROUP BY 1),
j AS (SELECT z.*, sh.*, coalesce(sp.scored_predictions, 0) AS sc, sp.m, z.current_rows < 24 OR z.reference_rows < 24 AS thin FROM sizes z LEFT JOIN (SELECT series_id AS sid, * EXCLUDE (series_id) FROM share) sh ON sh.sid = z.series_id LEFT JOIN sp USING (series_id))
SELECT series_id, ce AS checked_at,
  CASE WHEN thin THEN 'insufficient_data' WHEN drift_share >= 0.3 OR (sc >= 100 AND m > 4.0) THEN 'drift' ELSE 'ok' END AS status,
  drift_share, coalesce(drifted_features, 0) AS drifted_features, 11::BIGINT AS monitored_features, coalesce(drifted_names, '') AS drifted_names,
  m AS rolling_mape, sc AS scored_predictions, reference_rows, current_rows,
  array_to_string(list_filter([CASE WHEN current_rows < 24 THEN 'few_current' END, CASE WHEN current_rows >= 24 AND reference_rows < 24 THEN 'few_reference' END,
    CASE WHEN NOT thin AND drift_share >= 0.3 THEN 'inputs' END, CASE WHEN NOT thin AND sc >= 100 AND m > 4.0 THEN 'error' END, CASE WHEN NOT thin AND sc < 100 THEN 'few_scored' END],
    lambda x: x IS NOT NULL), ' ') AS reason_codes FROM j"""


def _drift_checks(spark, sf):
    c = fr.stored(spark, sf)
    log = c.filter("load_mw IS NOT NULL AND load_mw <> 0 AND tso_forecast_mw IS NOT NULL").select(
        F.xxhash64("series_id", "ts").alias("id"), "series_id", F.col("ts").alias("target_time"),
        F.col("ts").alias("predicted_at"), F.lit(24).alias("horizon_hours"), F.lit("1").alias("model_version"),
        (F.col("tso_forecast_mw") * 3).alias("load_mw"), F.col("load_mw").alias("actual_mw"),
    )
    scored = log.withColumns(
        {"ape": F.abs(F.col("load_mw") - F.col("actual_mw")) / F.col("actual_mw"), "tso_mw": F.col("actual_mw")}
    )
    return monitoring.check_drift(c, scored, log, current_days=10, strategy=ref.TRAILING, min_scored=100)


@query("c27_check_drift", C27, "drift_share rolling_mape")
def _(spark, sf):
    return _drift_checks(spark, sf).select(
        "series_id", "checked_at", "status", "drift_share", "drifted_features", "monitored_features", "drifted_names",
        "rolling_mape", "scored_predictions", "reference_rows", "current_rows", "reason_codes",
    )


C28 = ", win AS (SELECT series_id, max(target_time) - INTERVAL 60 DAY AS cs, max(target_time) AS ce FROM preds GROUP BY 1), std AS (SELECT * FROM preds QUALIFY row_number() OVER (PARTITION BY series_id, target_time, horizon_hours, model_version ORDER BY predicted_at DESC, id DESC) = 1)" + two_sample_sql(
    "SELECT p.series_id AS feature, load_mw AS value, true AS is_current FROM std p JOIN win USING (series_id) WHERE target_time BETWEEN cs AND ce UNION ALL SELECT p.series_id, load_mw, false FROM std p JOIN win USING (series_id) WHERE target_time BETWEEN cs - INTERVAL 60 DAY AND cs"
) + VERDICT + "SELECT feature AS series_id, n_current, n_reference, n_current >= 24 AND n_reference >= 24 AS sufficient, ks_p_value, wasserstein_normed, n_current >= 24 AND n_reference >= 24 AND drifted_by_distance AS prediction_drift FROM verdicts"


@query("c28_prediction_drift", C28, "ks_p_value wasserstein_normed")
def _(spark, sf):
    p = fr.predictions(spark, sf)
    windows = ref.current_windows(p, 60, ts="target_time")
    return monitoring.prediction_drift(p, windows, 60)


# --- decisions ------------------------------------------------------------------------------

FLAGS = """, cl AS (SELECT series_id, max("at") FILTER (WHERE event = 'clear') AS c FROM pevents WHERE event IN ('raise', 'clear') GROUP BY 1),
fl AS (SELECT p.series_id, min("at") AS raised_at, arg_min(reason, "at") AS reason FROM pevents p JOIN cl USING (series_id) WHERE event = 'raise' AND (c IS NULL OR "at" > c) GROUP BY 1)
"""
DUE_NOW = "2024-01-31 12:00:00"


@query("c29_retrain_due", FLAGS + f""", known AS (SELECT DISTINCT 'u' || (user_id % 45) AS series_id FROM events),
ls AS (SELECT series_id, max("at") AS s FROM pevents WHERE pipeline = 'retrain_if_needed' AND event = 'success' AND "at" < TIMESTAMP '2024-01-25' GROUP BY 1),
d AS (SELECT k.series_id, raised_at, reason, (epoch_us(TIMESTAMP '{DUE_NOW}') - epoch_us(s)) / 86400000000 AS days FROM known k LEFT JOIN fl USING (series_id) LEFT JOIN ls USING (series_id))
SELECT series_id, raised_at IS NOT NULL OR days IS NULL OR days >= 8 AS due,
  CASE WHEN raised_at IS NOT NULL THEN 'flag' WHEN days IS NULL THEN 'never' WHEN days >= 8 THEN 'cadence' ELSE 'fresh' END AS due_code,
  CASE WHEN raised_at IS NOT NULL THEN 'open drift flag of ' || strftime(raised_at, '%Y-%m-%d %H:%M') || ': ' || reason WHEN days IS NULL THEN 'no successful retrain on record'
    WHEN days >= 8 THEN printf('%.1f', days) || ' days since the last success; the cadence is 8' ELSE printf('%.1f', days) || ' of 8 days since the last success' END AS due_reason FROM d""")
def _(spark, sf):
    e = fr.pipeline_events(spark, sf)
    known = fr.events(spark, sf).select(F.concat(F.lit("u"), F.col("user_id") % 45).alias("series_id")).distinct()
    done = lifecycle.last_success(e.filter("pipeline = 'retrain_if_needed' AND at < '2024-01-25'"), DUE_NOW, ["series_id"])
    return lifecycle.retrain_due(known, lifecycle.retrain_flag(e), done, DUE_NOW, 8)


@query("c30_retrain_flag", FLAGS + "SELECT * FROM fl")
def _(spark, sf):
    return lifecycle.retrain_flag(fr.pipeline_events(spark, sf))


@query("c31_last_success", f"SELECT series_id, pipeline, max(\"at\") AS last_success, (epoch_us(TIMESTAMP '{DUE_NOW}') - epoch_us(max(\"at\"))) / 86400000000 AS days_since FROM pevents WHERE event = 'success' GROUP BY ALL", "days_since")
def _(spark, sf):
    return lifecycle.last_success(fr.pipeline_events(spark, sf), DUE_NOW, ["series_id"])


GATE = """, cand AS (SELECT r.run_id, r.model_name, r.version, CASE WHEN o.o_orderkey % 13 = 0 THEN 'nan'::DOUBLE ELSE r.mape END AS candidate, r.naive, k.mape AS champion
  FROM runs r JOIN orders o ON 'r' || o.o_orderkey = r.run_id LEFT JOIN (SELECT c.model_name, x.mape FROM champions c JOIN runs x ON x.run_id = c.run_id) k ON k.model_name = r.model_name),
gate AS (SELECT *, CASE WHEN isnan(candidate) THEN false WHEN candidate >= naive THEN false WHEN champion IS NULL THEN true WHEN candidate > champion * 1.02 THEN false ELSE true END AS promote,
  CASE WHEN isnan(candidate) THEN 'candidate_invalid' WHEN candidate >= naive THEN 'worse_than_naive' WHEN champion IS NULL THEN 'first'
    WHEN candidate > champion * 1.02 THEN 'regression' ELSE 'accepted' END AS gate_code FROM cand)
"""


def _gate(spark, sf):
    runs = fr.runs(spark, sf)
    champion = lifecycle.champion_metric(fr.aliases(spark, sf), runs, "mape").select("model_name", "champion")
    nan = F.when(F.col("version").cast("long") % 13 == 0, F.lit(float("nan"))).otherwise(F.element_at("metrics", "mape"))
    cand = runs.select("run_id", "model_name", "version", nan.alias("candidate"), "naive").join(champion, "model_name", "left")
    return lifecycle.promotion_decision(cand)


@query("c32_promotion_decision", GATE + "SELECT run_id, candidate, naive, champion, promote, gate_code FROM gate", "candidate naive champion")
def _(spark, sf):
    return _gate(spark, sf).select("run_id", "candidate", "naive", "champion", "promote", "gate_code")


@query("c33_champion_metric", "SELECT c.model_name, c.alias, c.version, c.run_id, CASE WHEN r.data_source = 'ingested' THEN r.mape END AS champion FROM champions c LEFT JOIN runs r ON r.run_id = c.run_id", "champion")
def _(spark, sf):
    return lifecycle.champion_metric(fr.aliases(spark, sf), fr.runs(spark, sf), "mape", "ingested")


@query("c34_apply_gate", GATE + ", moves AS (SELECT model_name, arg_min(version, candidate) AS version FROM gate WHERE promote GROUP BY 1) SELECT c.model_name, coalesce(m.version, c.version) AS version, (SELECT count(*) FROM gate g WHERE g.model_name = c.model_name) AS decisions FROM (SELECT DISTINCT model_name FROM gate) d LEFT JOIN champions x USING (model_name) LEFT JOIN moves m USING (model_name) JOIN LATERAL (SELECT d.model_name AS model_name, x.version AS version) c ON true WHERE coalesce(m.version, c.version) IS NOT NULL")
def _(spark, sf):
    """Every decision is recorded; of a model's promoted candidates the best gets the alias."""
    log, moves = lifecycle.apply_gate(_gate(spark, sf), "2010-01-01")
    now = lifecycle.current_alias(fr.aliases(spark, sf).unionByName(moves))
    counts = log.groupBy("model_name").agg(F.count(F.lit(1)).alias("decisions"))
    return now.join(counts, "model_name").select("model_name", "version", "decisions")


@query("c35_prunable_runs", "SELECT run_id FROM runs WHERE started_at < TIMESTAMP '2001-08-01' - INTERVAL 120 DAY AND run_id NOT IN (SELECT run_id FROM champions)")
def _(spark, sf):
    return lifecycle.prunable_runs(fr.runs(spark, sf), fr.aliases(spark, sf), "2001-08-01").select("run_id")


@query("c36_model_card", "SELECT c.model_name, c.version, c.run_id, c.\"at\" AS promoted_at, r.started_at, r.data_source, r.mape FROM champions c LEFT JOIN runs r ON r.run_id = c.run_id", "mape")
def _(spark, sf):
    card = lifecycle.model_card(fr.aliases(spark, sf), fr.runs(spark, sf).drop("version", "model_name"))
    return card.select(
        "model_name", "version", "run_id", "promoted_at", "started_at", "data_source", F.element_at("metrics", "mape").alias("mape")
    )


C38 = f""", ok AS (SELECT * FROM btl WHERE y_pred IS NOT NULL AND (series_id, ts) IN (SELECT series_id, ts FROM btl WHERE y_pred IS NOT NULL GROUP BY ALL HAVING count(DISTINCT model) = 3)),
m AS (SELECT model, count(*) AS n, count(y_true - y_pred) AS n_scored, {metrics()} FROM ok GROUP BY ALL)
SELECT m.*, m.mape - (SELECT mape FROM m WHERE model = 'day_ahead_reference') AS mape_vs_reference FROM m"""


@query("c38_benchmark_table", C38, "mape rmse_mw mae_mw bias_mw mape_vs_reference")
def _(spark, sf):
    from loadloom.operators.align import matched_rows

    long = matched_rows(fr.backtest_long(spark, sf).filter("y_pred IS NOT NULL"), "model", 3)
    return scores.present_in_order(scores.overall(long))


FLAGGED = C27.replace("SELECT series_id, ce AS checked_at,", ", chk AS (SELECT series_id, ce AS checked_at,", 1) + """)
SELECT series_id, 'check_drift' AS pipeline, 'success' AS event, checked_at AS "at" FROM chk UNION ALL SELECT series_id, 'retrain', 'raise', checked_at FROM chk WHERE status = 'drift'"""


@query("c39_record_check", C27.replace(" AS reason_codes FROM j", " AS rc FROM j").replace("SELECT series_id, ce AS checked_at,", ", chk AS (SELECT series_id, ce AS checked_at,", 1) + ") SELECT * EXCLUDE (rc) FROM chk", "drift_share rolling_mape")
def _(spark, sf):
    """The checks as read back from the appended history."""
    path, flags = shared_dir(spark, "history"), shared_dir(spark, "events")
    monitoring.record_check(_drift_checks(spark, sf), path, flags)
    return tables.read_drift_history(spark, path).select(
        "series_id", "checked_at", "status", "drift_share", "drifted_features", "monitored_features",
        F.coalesce("drifted_names", F.lit("")).alias("drifted_names"), "rolling_mape", "scored_predictions",
        "reference_rows", "current_rows",
    )


@query("c39_raised_flags", FLAGGED)
def _(spark, sf):
    """The events of a recorded check: a success per series, a flag per drifted one."""
    path, flags = shared_dir(spark, "history"), shared_dir(spark, "events")
    monitoring.record_check(_drift_checks(spark, sf), path, flags)
    return tables.read(spark, flags, tables.EVENTS).select("series_id", "pipeline", "event", "at")


C40 = """, e AS (SELECT series_id, max(target_time) AS m FROM preds GROUP BY 1), s AS (SELECT p.* FROM standing p JOIN e USING (series_id) WHERE target_time BETWEEN m - INTERVAL 400 DAY AND m)
SELECT e.series_id, count(id) AS scored, CASE WHEN count(id) = 0 THEN 'empty' WHEN count(id) >= 40 THEN 'measuring' ELSE 'accumulating' END AS status,
  count(id) >= 40 AS sufficient, avg(ape) * 100 AS model_mape, avg(abs((actual_mw - tso_mw) / nullif(actual_mw, 0))) * 100 AS tso_mape,
  avg(ape) * 100 - avg(abs((actual_mw - tso_mw) / nullif(actual_mw, 0))) * 100 AS gap FROM e LEFT JOIN s USING (series_id) GROUP BY 1"""


@query("c40_evaluate", C40, "model_mape tso_mape gap")
def _(spark, sf):
    table = pred.evaluate(fr.predictions(spark, sf), fr.history(spark, sf), window_days=400, min_scored=40)
    return table.select("series_id", "scored", "status", "sufficient", "model_mape", "tso_mape", "gap")


def _ingested(spark, sf):
    path, marks = shared_dir(spark, "dataset"), shared_dir(spark, "marks")
    load, w = fr.load_frame(spark, sf), fr.weather(spark, sf)
    for _ in range(2):
        issues = dataset.ingest(spark, path, load, w, "run-test", marks, "2024-02-01")
    return path, issues


@query("c42_ingest_twice", "SELECT * FROM canon", CANON)
def _(spark, sf):
    """The stored table after the same pull twice: the second run changes nothing."""
    path, _ = _ingested(spark, sf)
    return canonical.read_periods(spark, path)


@query("c42_ingest_issues", "SELECT series_id, name, severity, n FROM (SELECT series_id, 'load missing' AS name, 'warning' AS severity, count(*) AS n FROM canon WHERE load_mw IS NULL GROUP BY 1 UNION ALL SELECT series_id, 'load present but TSO forecast missing', 'error', count(*) FROM canon WHERE load_mw IS NOT NULL AND tso_forecast_mw IS NULL GROUP BY 1 UNION ALL SELECT series_id, 'schema: load_mw failed in_range(10000, 30000)', 'error', count(*) FROM canon WHERE NOT load_mw BETWEEN 10000 AND 30000 GROUP BY 1 UNION ALL SELECT series_id, 'schema: tso_forecast_mw failed in_range(10000, 30000)', 'error', count(*) FROM canon WHERE NOT tso_forecast_mw BETWEEN 10000 AND 30000 GROUP BY 1)")
def _(spark, sf):
    """The issues of the whole stored table after an ingest."""
    _, issues = _ingested(spark, sf)
    return issues.select("series_id", "name", "severity", "n")


def _pulled_in_parts(spark, sf, **how):
    """The table built by three pulls, the later ones of its last days and of some in its middle; its folder state."""
    path, state = shared_dir(spark, "parts"), shared_dir(spark, "parts-state")
    load, weather = through_table(fr.load_frame(spark, sf), "load"), through_table(fr.weather(spark, sf), "weather")
    for days in (range(1, 20), range(15, 32), range(3, 6)):
        some = F.dayofmonth("ts").isin(*days)
        dataset.ingest(spark, path, load.filter(some), weather.filter(some), "run-test", grain="day", whole=False, state_path=state)
    return path, folders.read_state(spark, state)


@query("a15_folder_state", "SELECT series_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, max(ts) FILTER (load_mw IS NOT NULL) AS last_value_ts FROM canon GROUP BY 1")
def _(spark, sf):
    """Hours, ends and newest value of every series from the state of its folders."""
    _, state = _pulled_in_parts(spark, sf)
    return folders.merged_state(state).select("series_id", "n", "first_ts", "last_ts", "last_value_ts")


@query("a18_incremental_fingerprint", "SELECT series_id, count(*) AS n, true AS same_as_whole FROM canon GROUP BY 1")
def _(spark, sf):
    """Fingerprints kept up by folder equal those of the whole table read at once."""
    path, state = _pulled_in_parts(spark, sf)
    whole = folders.fingerprints(folders.folder_state(canonical.read_periods(spark, path), "month"), ["series_id"])
    kept = folders.fingerprints(state, ["series_id"]).withColumnRenamed("fingerprint", "kept").drop("n")
    return whole.join(kept, "series_id").select("series_id", "n", (F.col("fingerprint") == F.col("kept")).alias("same_as_whole"))
