"""Model jobs and backtests."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadloom.functions import errors
from loadloom.functions.names import feature_columns
from loadloom.operators import scores, splits
from loadloom.operators.scores import WEATHER_TREES
from loadloom.plans import evaluation, features, lifecycle, models, predictions as pred, quantiles, training
from loadloom.session import shared_dir, through_table
from loadloom.sources import tables

from . import frames as fr
from .base_sql import hour_no, lag, lead, rolling
from .q_jobs import FLAGS
from .q_joins import SPLITS
from .registry import query

SCHEDULE = {"initial_train_days": 12, "test_days": 4, "step_days": 4}
NAMES = features.feature_names(24)
LINEAR = feature_columns(NAMES, include_lags=False)


def _labelled(spark, sf):
    f = features.make_features(fr.stored(spark, sf), 24)
    return through_table(splits.chronological_split(f, 6, 24), "labelled")


def _train_later(spark, sf):
    rows = _labelled(spark, sf)
    return rows.filter("block = 'train'"), rows.filter("block = 'validation'")


LATER = """, e AS (SELECT series_id, max(ts) - INTERVAL 6 DAY + INTERVAL 1 HOUR AS v0 FROM feats GROUP BY 1),
later AS (SELECT f.*, n.load_mw AS naive FROM feats f JOIN e USING (series_id) JOIN canon n ON n.series_id = f.series_id AND n.ts = f.ts - INTERVAL 168 HOUR WHERE f.ts >= v0)
"""


def _beats_naive(spark, sf, predicted):
    """Rows served with their truth, and whether the model's mean error is below the naive one."""
    naive = evaluation.references(fr.stored(spark, sf)).select("series_id", "ts", "naive_seasonal")
    rows = through_table(predicted.join(naive, ["series_id", "ts"]), "predicted")
    error = rows.agg(F.avg(F.abs(F.col("prediction") - F.col("target"))).alias("m"), F.avg(F.abs(F.col("naive_seasonal") - F.col("target"))).alias("n"))
    return rows.crossJoin(F.broadcast(error)).select(  # one row of two numbers
        "series_id", "ts", "target", F.col("prediction").isNotNull().alias("predicted"), (F.col("m") < F.col("n")).alias("beats_naive")
    )


@query("m1_linear_reference", LATER + "SELECT series_id, ts, target, true AS predicted, true AS beats_naive FROM later", "target")
def _(spark, sf):
    """One pooled least-squares model on calendar and weather, predicting the later block."""
    train, later = _train_later(spark, sf)
    return _beats_naive(spark, sf, models.fit_linear(train, NAMES).predict(later))


@query("m1_linear_normal_equations", f"SELECT unnest({LINEAR!r}) AS feature, true AS orthogonal")
def _(spark, sf):
    """The residuals of the training rows are orthogonal to every column and to the constant."""
    train, _ = _train_later(spark, sf)
    fitted = models.fit_linear(train, NAMES).predict(train)
    r = F.col("target") - F.col("prediction")
    sums = fitted.agg(*[(F.abs(F.sum(r * F.col(c))) / (F.sum(F.abs(r * F.col(c))) + 1e-9)).alias(c) for c in LINEAR])
    return sums.unpivot([], LINEAR, "feature", "share").select("feature", (F.col("share") < 1e-6).alias("orthogonal"))


@query("m1_linear_per_series", LATER + "SELECT series_id, ts, target, true AS predicted FROM later", "target")
def _(spark, sf):
    """One model per series, all in one job."""
    train, later = _train_later(spark, sf)
    fitted = models.fit_linear_groups(train, LINEAR)
    served = models.apply_linear(later.join(fitted, "series_id"), LINEAR)
    return served.select("series_id", "ts", "target", F.col("prediction").isNotNull().alias("predicted"))


ONE = """, ok AS (SELECT series_id, ts, load_mw AS target, tso_forecast_mw FROM hist WHERE load_mw IS NOT NULL AND tso_forecast_mw IS NOT NULL),
fit AS (SELECT series_id, regr_slope(target, tso_forecast_mw) AS b, regr_intercept(target, tso_forecast_mw) AS a FROM ok GROUP BY 1)
SELECT ok.series_id, ts, (a + b * tso_forecast_mw) / 1000 AS prediction_gw FROM ok JOIN fit USING (series_id)"""


def _pairs(spark, sf):
    h = fr.history(spark, sf).select("series_id", "ts", F.col("load_mw").alias("target"), "tso_forecast_mw")
    return h.dropna("any")


@query("m1_linear_one_feature", ONE, "prediction_gw")
def _(spark, sf):
    """Grouped least squares against the closed form, on the whole history."""
    rows = _pairs(spark, sf)
    fitted = models.fit_linear_groups(rows, ["tso_forecast_mw"])
    predicted = models.apply_linear(rows.join(fitted, "series_id"), ["tso_forecast_mw"])
    return predicted.select("series_id", "ts", (F.col("prediction") / 1000).alias("prediction_gw"))


EXPANDING = SPLITS + """, ok AS (SELECT series_id, ts, load_mw AS target, tso_forecast_mw FROM hist WHERE load_mw IS NOT NULL AND tso_forecast_mw IS NOT NULL),
fit AS (SELECT s.series_id, s.origin_no, test_start, test_end, regr_slope(target, tso_forecast_mw) AS b, regr_intercept(target, tso_forecast_mw) AS a
  FROM splits s JOIN ok ON ok.series_id = s.series_id AND ok.ts <= s.train_end GROUP BY ALL)
SELECT ok.series_id, ok.ts, arg_max(a + b * tso_forecast_mw, origin_no) / 1000 AS prediction_gw, max(origin_no) AS origin_no
FROM ok JOIN fit ON fit.series_id = ok.series_id AND ok.ts BETWEEN test_start AND test_end GROUP BY ALL"""


@query("m1_w8_linear_refitted_per_origin", EXPANDING, "prediction_gw")
def _(spark, sf):
    """Every origin of every series refitted in one pass; overlapping blocks, last one wins."""
    h = fr.history(spark, sf)
    table = through_table(splits.rolling_origins(h, 24, 730, 42, 28), "splits")
    served = evaluation.linear_by_origin(_pairs(spark, sf), table, ["tso_forecast_mw"])
    return served.select("series_id", "ts", "origin_no", (F.col("y_pred") / 1000).alias("prediction_gw"))


@query("m2_boosted_trees", LATER + "SELECT series_id, ts, target, true AS predicted, true AS beats_naive, true AS repeatable FROM later", "target")
def _(spark, sf):
    """The default learner beats the naive forecast, and the same seed gives the same trees."""
    train, later = _train_later(spark, sf)
    first, second = (models.fit_trees(train, later, NAMES) for _ in range(2))
    both = first.predict(later).join(
        second.predict(later).select("series_id", "ts", F.col("prediction").alias("again")), ["series_id", "ts"]
    )
    same = through_table(both.agg((F.max(F.abs(F.col("prediction") - F.col("again"))) == 0).alias("repeatable")), "same")
    return _beats_naive(spark, sf, both.drop("again")).crossJoin(F.broadcast(same))  # one row


@query("a20_feature_importance", f"SELECT unnest({NAMES!r}) AS feature, true AS in_range, 1.0::DOUBLE AS total", "total")
def _(spark, sf):
    """One row per column, importances between 0 and 1 that add up to 1."""
    train, later = _train_later(spark, sf)
    gains = models.feature_importance(spark, models.fit_trees(train, later, NAMES))
    total = gains.agg(F.sum("gain").alias("total"))
    return gains.crossJoin(total).select("feature", F.col("gain").between(0, 1).alias("in_range"), "total")


BAND = """, res AS (SELECT series_id, ts, actual, day_ahead_reference AS p, hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Warsaw') AS lh FROM bt WHERE day_ahead_reference IS NOT NULL),
q AS (SELECT series_id, lh, quantile_cont(actual - p, 0.1) AS q10, quantile_cont(actual - p, 0.5) AS q50, quantile_cont(actual - p, 0.9) AS q90 FROM res WHERE ts < TIMESTAMP '2000-01-01' GROUP BY ALL)
SELECT r.series_id, r.ts, p + q10 AS p10, p + q50 AS p50, p + q90 AS p90 FROM res r LEFT JOIN q USING (series_id, lh) WHERE ts >= TIMESTAMP '2000-01-01'"""


@query("m3_quantile_band", BAND, "p10 p50 p90")
def _(spark, sf):
    """Conformal band around the published forecast: residual quantiles by local hour."""
    rows = fr.backtest_wide(spark, sf).filter("day_ahead_reference IS NOT NULL")
    past, later = rows.filter("ts < '2000-01-01'"), rows.filter("ts >= '2000-01-01'")
    names = {"y_true": "actual", "y_pred": "day_ahead_reference"}
    offsets = models.conformal_offsets(past, **names)
    return models.with_band(later, offsets, y_pred="day_ahead_reference").select("series_id", "ts", "p10", "p50", "p90")


@query("m4_parameter_search", "SELECT * FROM (VALUES (3, true, true), (5, true, true)) v(max_depth, scored, best_is_least)")
def _(spark, sf):
    """Every grid point is scored, and the best one has the least error."""
    train, later = _train_later(spark, sf)
    best, trials = models.tune(train, later, NAMES, {"maxDepth": [3, 5], "stepSize": [0.1]})
    least = min(trials, key=lambda t: t[1])[0] == best
    return spark.createDataFrame([(p["maxDepth"], m is not None, least) for p, m in trials], "max_depth int, scored boolean, best_is_least boolean")


def _trained(spark, sf):
    stored = fr.stored(spark, sf)
    f = through_table(features.make_features(stored, 24), "features")
    labelled = through_table(splits.chronological_split(f, 6, 24), "labelled")
    none = spark.createDataFrame([], tables.RUNS)
    return stored, training.train(labelled, NAMES, evaluation.references(stored), none, "load_trees", dataset_version="data-1")


@query("m5_m8_train_variants", "SELECT * FROM (VALUES ('trees_calendar', 'load_trees', '1', 24::BIGINT, true, true), ('trees_weather', 'load_trees', '2', 24, true, true)) v(name, model_name, version, horizon, all_metrics, band_scored)")
def _(spark, sf):
    """Every variant has a run row with its own version, all metrics and the band's loss."""
    path = shared_dir(spark, "runs")
    tables.append(_trained(spark, sf)[1].runs, path, tables.RUNS)
    has = lambda *names: F.size(F.array_intersect(F.map_keys("metrics"), F.array(*[F.lit(n) for n in names]))) == len(names)
    return tables.read(spark, path, tables.RUNS).select(
        "name", "model_name", "version", "horizon", has(*training.METRICS, "naive_mape").alias("all_metrics"),
        has("pinball_p10", "pinball_p50", "pinball_p90").alias("band_scored"),
    )


@query("m6_reference_from_column", "SELECT series_id, ts, tso_forecast_mw AS day_ahead_reference FROM canon", "day_ahead_reference")
def _(spark, sf):
    return evaluation.references(fr.stored(spark, sf)).select("series_id", "ts", "day_ahead_reference")


CUT = "2024-01-25 12:00:00"
SERVED = f""", last AS (SELECT series_id, max(ts) AS m FROM canon WHERE ts <= TIMESTAMP '{CUT}' AND load_mw IS NOT NULL GROUP BY 1),
want AS (SELECT series_id, m + to_hours(k) AS ts FROM last, range(1, 25) t(k)),
serve AS (SELECT series_id, ts, CASE WHEN ts <= TIMESTAMP '{CUT}' THEN load_mw END AS load_mw, temp_c, wind_ms, cloud_cover FROM canon),
l AS (SELECT *, {", ".join(f"{lag(n)} AS l{n}" for n in (24, 25, 48, 168, 192))}, {rolling("avg")} AS rm, {rolling("stddev_samp")} AS rs FROM serve)
SELECT w.series_id, TIMESTAMP '2024-01-25 12:30:00' AS predicted_at, w.ts AS target_time, 24::BIGINT AS horizon_hours, '2' AS model_version, true AS has_point, true AS ordered_band
FROM want w JOIN l ON l.series_id = w.series_id AND l.ts = w.ts
WHERE l24 + l25 + l48 + l168 + l192 + rm + rs + temp_c + wind_ms + cloud_cover IS NOT NULL"""


@query("m7_c13_forecast_records", SERVED)
def _(spark, sf):
    """Train, forecast the reachable hours with their band, append to the log, read back."""
    stored, trained = _trained(spark, sf)
    cut = F.lit(CUT).cast("timestamp")
    history = stored.filter(F.col("ts") <= cut)
    weather = stored.filter(F.col("ts") > cut).select("series_id", "ts", "temp_c", "wind_ms", "cloud_cover", "humidity_pct")
    path = shared_dir(spark, "forecast-log")
    tables.append_predictions(pred.forecast(history, weather, trained.by_version("2"), "2024-01-25 12:30:00"), path)
    log = tables.in_log_order(tables.read_predictions(spark, path))
    return log.select(
        "series_id", "predicted_at", "target_time", "horizon_hours", "model_version",
        F.col("load_mw").isNotNull().alias("has_point"), F.expr("p10 <= p50 AND p50 <= p90").alias("ordered_band"),
    )


ROLLING = f""", span AS (SELECT series_id, {hour_no('min(ts)')} AS h0, {hour_no('max(ts)')} AS h1 FROM feats GROUP BY 1),
origins AS (SELECT series_id, h0 + 12 * 24 - 1 + k * 96 + 24 AS t0, h1 FROM span, range(0, 400) t(k) WHERE h0 + 12 * 24 - 1 + k * 96 + 24 <= h1),
tested AS (SELECT DISTINCT f.series_id, f.ts, f.target FROM feats f JOIN origins o ON o.series_id = f.series_id AND {hour_no('f.ts')} BETWEEN t0 AND least(t0 + 95, h1)),
refs AS (SELECT series_id, ts, {lag(168)} AS naive_seasonal, tso_forecast_mw AS day_ahead_reference FROM canon),
paired AS (SELECT t.series_id, t.ts, t.target AS y_true, naive_seasonal, day_ahead_reference FROM tested t JOIN refs r ON r.series_id = t.series_id AND r.ts = t.ts WHERE naive_seasonal IS NOT NULL AND day_ahead_reference IS NOT NULL)
"""


def _masked(long, models_):
    """Values of the references; of fitted models only whether there is one."""
    return long.withColumn("fitted", F.col("model").isin(*models_)).select(
        "series_id", "ts", "y_true", "model", F.when(~F.col("fitted"), F.col("y_pred")).alias("y_pred"),
        (F.col("fitted") & F.col("y_pred").isNotNull()).alias("fitted"),
    )


def _rolling_sql(*fitted):
    parts = [f"SELECT series_id, ts, y_true, '{m}' AS model, {m} AS y_pred, false AS fitted FROM paired" for m in ("naive_seasonal", "day_ahead_reference")]
    parts += [f"SELECT series_id, ts, y_true, '{m}', NULL, true FROM paired" for m in fitted]
    return ROLLING + " UNION ALL ".join(parts)


@query("c17_rolling_origin_backtest", _rolling_sql(scores.LINEAR, WEATHER_TREES), "y_true y_pred")
def _(spark, sf):
    """References, linear and boosted trees over all rolling origins, on common hours."""
    long = evaluation.run_backtest(fr.stored(spark, sf), 24, **SCHEDULE, trees=[WEATHER_TREES], inner_validation_days=4)
    return _masked(long, [scores.LINEAR, WEATHER_TREES])


@query("c17_linear_backtest", _rolling_sql(scores.LINEAR), "y_true y_pred")
def _(spark, sf):
    """The same without trees: every origin of every series in one pass."""
    return _masked(evaluation.run_backtest(fr.stored(spark, sf), 24, **SCHEDULE, trees=[]), [scores.LINEAR])


PINBALL = "avg(greatest(quantile * (y_true - y_pred), (quantile - 1) * (y_true - y_pred)))"
TAUS = "(VALUES (0.1::DOUBLE), (0.5), (0.9)) v(quantile)"
EXACT = f""", ranked AS (SELECT series_id, target, row_number() OVER (PARTITION BY series_id ORDER BY target) AS k, count(*) OVER (PARTITION BY series_id) AS n FROM hist2),
value AS (SELECT series_id, quantile, n, min(target) AS y_pred FROM ranked, {TAUS} WHERE k >= ceil(quantile * n - 1e-9) GROUP BY ALL)
SELECT v.series_id, v.quantile, v.n, v.y_pred, {PINBALL.replace("y_true", "h.target")} AS pinball FROM value v JOIN hist2 h USING (series_id) GROUP BY ALL"""
EXACT = ", hist2 AS (SELECT series_id, load_mw AS target FROM canon WHERE load_mw IS NOT NULL)" + EXACT


@query("m3_quantile_regression_constant", EXACT, "y_pred pinball")
def _(spark, sf):
    """Without columns the fit is the sample quantile of each series, with the least pinball loss there is."""
    rows = fr.stored(spark, sf).filter("load_mw IS NOT NULL").withColumn("target", F.col("load_mw"))
    fits = quantiles.fit_quantiles(rows, [])
    joined = rows.select("series_id", "target").join(fits.withColumn("y_pred", F.col("coefficients")[0]), "series_id")
    return joined.groupBy("series_id", "quantile", "y_pred").agg(F.count(F.lit(1)).alias("n"), F.avg(errors.pinball("target", "y_pred", F.col("quantile"))).alias("pinball"))


BEST = LATER.replace("later AS", "unused AS") + f"SELECT DISTINCT series_id, quantile, true AS best, true AS below_flat, true AS ordered FROM feats, {TAUS} WHERE ts < (SELECT min(v0) FROM e)"


@query("m3_quantile_regression", BEST, "quantile")
def _(spark, sf):
    """Each series' three quantiles on calendar and weather: each is best at its own pinball loss on the training
    rows, beats the constant quantile there, and no band crosses."""
    train, _ = _train_later(spark, sf)
    keep = ["series_id", "ts", "target"]
    fits = through_table(quantiles.fit_quantiles(train, LINEAR), "fits")
    band = quantiles.band_of(train, fits, LINEAR, ["series_id"], keep)
    flat = quantiles.band_of(train, quantiles.fit_quantiles(train, []), [], ["series_id"], keep).withColumnRenamed("y_pred", "flat")
    judged = band.withColumnRenamed("quantile", "fitted").join(flat, keep).withColumn("loss", errors.pinball("target", "y_pred", F.col("quantile")))
    sums = judged.groupBy("series_id", "quantile", "fitted").agg(F.sum("loss").alias("loss"), F.sum(errors.pinball("target", "flat", F.col("quantile"))).alias("flat"))
    # A series of a few rows is met exactly by every fit: a loss of zero but for rounding.
    own = F.max(F.when(F.col("fitted") == F.col("quantile"), F.col("loss") - 1e-6))
    best = sums.groupBy("series_id", "quantile").agg((own <= F.min("loss")).alias("best"), (own <= F.max("flat")).alias("below_flat"))
    order = band.groupBy(*keep).agg(F.array_sort(F.collect_list(F.struct("quantile", "y_pred"))).alias("b"))
    order = order.groupBy("series_id").agg(F.min((F.col("b")[0]["y_pred"] <= F.col("b")[1]["y_pred"]) & (F.col("b")[1]["y_pred"] <= F.col("b")[2]["y_pred"])).alias("ordered"))
    return best.join(order, "series_id")


TRAILING = f"""{ROLLING.split("tested AS")[0]}trained AS (
  SELECT o.series_id, o.t0, f.target, row_number() OVER w AS k, count(*) OVER (PARTITION BY o.series_id, o.t0) AS n
  FROM origins o JOIN feats f ON f.series_id = o.series_id AND {hour_no('f.ts')} <= o.t0 - 24 WINDOW w AS (PARTITION BY o.series_id, o.t0 ORDER BY f.target)),
fit AS (SELECT series_id, t0, quantile, min(target) AS y_pred FROM trained, {TAUS} WHERE k >= ceil(quantile * n - 1e-9) GROUP BY ALL),
banded AS (SELECT f.series_id, f.ts, f.target AS y_true, b.quantile, b.y_pred FROM feats f JOIN origins o ON o.series_id = f.series_id
  AND {hour_no('f.ts')} BETWEEN o.t0 AND least(o.t0 + 95, h1) JOIN fit b ON b.series_id = o.series_id AND b.t0 = o.t0
  QUALIFY row_number() OVER (PARTITION BY f.series_id, f.ts, b.quantile ORDER BY o.t0 DESC) = 1)
"""


def _band_backtest(spark, sf):
    long = evaluation.run_backtest(fr.stored(spark, sf), 24, **SCHEDULE, trees=[], quantiles=quantiles.BAND, band_columns=[])
    return long.filter(F.col("model") == evaluation.QUANTILE_BAND)


@query("c17_quantile_band_backtest", TRAILING + "SELECT series_id, ts, quantile, y_true, y_pred FROM banded", "y_true y_pred")
def _(spark, sf):
    """Bands of every rolling origin: the sample quantiles of its own training rows on its test rows."""
    return _band_backtest(spark, sf).drop("model")


@query("c37_backtest_pinball", TRAILING + f"SELECT series_id, quantile, {PINBALL} AS pinball FROM banded GROUP BY ALL", "pinball")
def _(spark, sf):
    """Pinball loss per quantile of the band of a rolling-origin backtest."""
    return scores.pinball_table(_band_backtest(spark, sf), ["series_id"])


OWN = f""", own AS (SELECT series_id, ts, load_mw, {lead('ts')} AS h FROM canon WHERE load_mw IS NOT NULL AND temp_c IS NOT NULL AND wind_ms IS NOT NULL AND cloud_cover IS NOT NULL),
roll AS (SELECT series_id, ts, CASE WHEN count(load_mw) OVER w = 24 THEN avg(load_mw) OVER w END AS m, CASE WHEN count(load_mw) OVER w = 24 THEN stddev_samp(load_mw) OVER w END AS s
  FROM canon WINDOW w AS (PARTITION BY series_id ORDER BY ts RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW))
SELECT o.series_id, o.ts, o.h AS horizon, a.load_mw AS lag_h, b.load_mw AS lag_h1, c.load_mw AS lag_h24, d.load_mw AS lag_week, e.load_mw AS lag_week_h, r.m AS roll_mean, r.s AS roll_std, o.load_mw AS target
FROM own o JOIN canon a ON a.series_id = o.series_id AND a.ts = o.ts - to_hours(o.h) JOIN canon b ON b.series_id = o.series_id AND b.ts = o.ts - to_hours(o.h + 1)
JOIN canon c ON c.series_id = o.series_id AND c.ts = o.ts - to_hours(o.h + 24) JOIN canon d ON d.series_id = o.series_id AND d.ts = o.ts - to_hours(168)
JOIN canon e ON e.series_id = o.series_id AND e.ts = o.ts - to_hours(168 + o.h) JOIN roll r ON r.series_id = o.series_id AND r.ts = o.ts - to_hours(o.h)
WHERE a.load_mw IS NOT NULL AND b.load_mw IS NOT NULL AND c.load_mw IS NOT NULL AND d.load_mw IS NOT NULL AND e.load_mw IS NOT NULL AND r.m IS NOT NULL AND r.s IS NOT NULL"""


C18 = OWN.split("\nSELECT o.series_id")[0] + f""", own_rows AS (SELECT o.series_id{OWN.split("SELECT o.series_id")[1]}),
wide AS (SELECT series_id, ts FROM canon WHERE load_mw IS NOT NULL AND temp_c IS NOT NULL AND wind_ms IS NOT NULL AND cloud_cover IS NOT NULL),
anchor AS (SELECT o.series_id, o.ts FROM wide o JOIN canon a ON a.series_id = o.series_id AND a.ts = o.ts - to_hours(37) JOIN canon b ON b.series_id = o.series_id AND b.ts = o.ts - to_hours(38)
  JOIN canon c ON c.series_id = o.series_id AND c.ts = o.ts - to_hours(61) JOIN canon d ON d.series_id = o.series_id AND d.ts = o.ts - to_hours(168)
  JOIN canon e ON e.series_id = o.series_id AND e.ts = o.ts - to_hours(205) JOIN roll r ON r.series_id = o.series_id AND r.ts = o.ts - to_hours(37)
  WHERE a.load_mw + b.load_mw + c.load_mw + d.load_mw + e.load_mw + r.m + r.s IS NOT NULL),
span AS (SELECT series_id, {hour_no('min(ts)')} AS h0, {hour_no('max(ts)')} AS h1 FROM anchor GROUP BY 1),
origins AS (SELECT series_id, h0 + 12 * 24 - 1 + k * 96 + 37 AS t0, h1 FROM span, range(0, 400) t(k) WHERE h0 + 12 * 24 - 1 + k * 96 + 37 <= h1),
tested AS (SELECT DISTINCT f.series_id, f.ts, f.horizon, f.target FROM own_rows f JOIN origins o ON o.series_id = f.series_id AND {hour_no('f.ts')} BETWEEN t0 AND least(t0 + 95, h1)),
refs AS (SELECT series_id, ts, {lag(168)} AS naive_seasonal, tso_forecast_mw AS day_ahead_reference FROM canon),
paired AS (SELECT t.series_id, t.ts, t.horizon, t.target AS y_true, naive_seasonal, day_ahead_reference FROM tested t JOIN refs r ON r.series_id = t.series_id AND r.ts = t.ts WHERE naive_seasonal IS NOT NULL AND day_ahead_reference IS NOT NULL)
SELECT series_id, ts, horizon, y_true, 'gate_closure' AS model, NULL AS y_pred, true AS fitted FROM paired
UNION ALL SELECT series_id, ts, horizon, y_true, 'naive_seasonal', naive_seasonal, false FROM paired
UNION ALL SELECT series_id, ts, horizon, y_true, 'day_ahead_reference', day_ahead_reference, false FROM paired"""


def _lead_matched(spark, sf, **how):
    long = evaluation.run_gate_closure_backtest(fr.stored(spark, sf), **SCHEDULE, **how)
    masked = _masked(long, [evaluation.GATE_MODEL])
    return masked.join(long.select("series_id", "ts", "model", F.col("horizon").cast("long").alias("horizon")), ["series_id", "ts", "model"])


@query("c18_lead_matched_backtest", C18, "y_true y_pred")
def _(spark, sf):
    """Every hour by the linear model of its own lead, all origins and horizons in one pass."""
    return _lead_matched(spark, sf)


@query("c18_p9_features_at_own_lead", OWN, "lag_h lag_h1 lag_h24 lag_week lag_week_h roll_mean roll_std target")
def _(spark, sf):
    """All lead-matched horizons from one feature pass, kept where the lead is the horizon."""
    long = features.make_features_by_lead(fr.stored(spark, sf)).filter("is_own_lead")
    return long.select(
        "series_id", "ts", "horizon", "lag_h", "lag_h1", "lag_h24", "lag_week", "lag_week_h", "roll_mean", "roll_std", "target"
    )


@query("c19_fairness_audit")
def _(spark, sf):
    frame = fr.stored(spark, sf)
    archived = frame.select("series_id", "ts", (F.col("temp_c") + F.sin(F.hour("ts"))).alias("temp_c"))
    return evaluation.audit_table(evaluation.audit(frame, archived, **SCHEDULE))


C41 = FLAGS + """, known AS (SELECT DISTINCT 'u' || (user_id % 45) AS series_id FROM events),
ls AS (SELECT series_id, max("at") AS s FROM pevents WHERE pipeline = 'retrain_if_needed' AND event = 'success' GROUP BY 1),
due AS (SELECT k.series_id FROM known k LEFT JOIN fl USING (series_id) LEFT JOIN ls USING (series_id)
  WHERE raised_at IS NOT NULL OR s IS NULL OR epoch_us(TIMESTAMP '2024-02-01') - epoch_us(s) >= 7 * 86400000000)
SELECT series_id, p AS pipeline, e AS event, TIMESTAMP '2024-02-01' AS "at" FROM due, (VALUES ('retrain', 'clear'), ('retrain_if_needed', 'success')) v(p, e)"""


def _retrained(spark, sf):
    owners = fr.events(spark, sf).select(F.concat(F.lit("u"), F.col("user_id") % 45).alias("series_id")).distinct()
    return lifecycle.retrain(
        fr.stored(spark, sf), fr.pipeline_events(spark, sf), fr.aliases(spark, sf), fr.runs(spark, sf), "m3",
        "2024-02-01", owners, validation_days=6,
    )


@query("c41_retrain_job", C41)
def _(spark, sf):
    """Everyone who is due: one training, then their flags are cleared and successes recorded."""
    return _retrained(spark, sf).events.drop("reason")
