"""Log, scores, drift, gate, state, models, streams."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadloom.functions import scalars
from loadloom.operators import reference_window as ref
from loadloom.operators.twosample import drift_share, drift_verdict, two_sample
from loadloom.plans import dataset, evaluation, features, lifecycle, models, monitoring, predictions as pred
from loadloom.session import shared_dir
from loadloom.sources import canonical, payload, tables
from loadloom.streaming import streams

T0 = datetime(2024, 1, 1)
PRED = "id long, series_id string, predicted_at timestamp, target_time timestamp, horizon_hours int, load_mw double, model_name string, model_version string"
ACT = "series_id string, ts timestamp, load_mw double, tso_forecast_mw double"
TARGET = "2026-08-06 12:00:00"


def record(i=1, at="2026-08-05 12:00:00", load=20000.0, target=TARGET, version="1"):
    return (i, "a", at, target, 24, load, "trees", version)


def test_log_keeps_every_call(spark, frame):
    path = shared_dir(spark, "log")
    made = frame([record()], PRED).drop("id")
    assert tables.read_predictions(spark, path).count() == 0
    tables.append_predictions(made, path)
    tables.append_predictions(made, path)
    log = tables.read_predictions(spark, path)
    assert log.count() == 2 and log.select("id").distinct().count() == 2
    assert tables.latest_per_target(log).count() == 1
    assert tables.read_predictions(spark, path, since=TARGET, until=TARGET).count() == 2
    assert tables.read_predictions(spark, path, since="2026-08-06 13:00:00").count() == 0
    assert tables.read_predictions(spark, path, model_version="2").count() == 0


def test_scores_and_revisions(spark, frame):
    p = frame([record()], PRED)
    first = pred.score(p, frame([("a", TARGET, 20500.0, 20300.0)], ACT), "2026-08-07")
    row = first.first()
    assert row["abs_error_mw"] == 500 and row["ape"] == pytest.approx(500 / 20500) and row["tso_abs_error_mw"] == 200
    again = pred.upsert_scores(first, pred.score(p, frame([("a", TARGET, 21000.0, 20300.0)], ACT), "2026-08-08"))
    assert [(r["actual_mw"]) for r in again.collect()] == [21000.0]
    kept = pred.upsert_scores(first, pred.score(p, frame([], ACT)))
    assert kept.count() == 1  # a score outlives an actual that is no longer delivered


def test_unscored_without_an_actual_and_null_without_a_reference(frame):
    p = frame([record()], PRED)
    assert pred.score(p, frame([("a", TARGET, None, 1.0)], ACT)).isEmpty()
    assert pred.score(p, frame([("a", TARGET, 0.0, 1.0)], ACT)).isEmpty()
    row = pred.score(p, frame([("a", TARGET, 100.0, None)], ACT).drop("tso_forecast_mw")).first()
    assert row["tso_forecast_mw"] is None and row["actual_mw"] == 100.0


def test_stored_scores_are_idempotent(spark, frame):
    log, out = shared_dir(spark, "log"), shared_dir(spark, "scores")
    tables.append_predictions(frame([record()], PRED), log)
    for _ in range(2):
        pred.rescore(spark, log, out, frame([("a", TARGET, 20500.0, 20300.0)], ACT))
    assert tables.read_scores(spark, out).count() == 1


def day_files(path):
    import glob
    import os

    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/period=*/*.parquet")}


def test_only_the_days_of_a_pull_are_rewritten(spark, frame):
    log, out = shared_dir(spark, "log"), shared_dir(spark, "scores")
    days = [f"2026-08-0{d} 12:00:00" for d in (5, 6, 7)]
    tables.append_predictions(frame([record(i, load=20000.0 + i, target=t) for i, t in enumerate(days)], PRED), log)
    pred.rescore(spark, log, out, frame([("a", t, 20500.0, 20300.0) for t in days], ACT))
    before = day_files(out)
    pred.rescore(spark, log, out, frame([("a", days[1], 20900.0, 20300.0)], ACT))
    after = day_files(out)
    assert len(before) == 3 and {f for f in before if "08-06" not in f} <= set(after)
    assert all(after[f] == before[f] for f in before if "08-06" not in f)
    got = {int(r["period"][-2:]): r["actual_mw"] for r in tables.read_scores(spark, out).collect()}
    assert got == {5: 20500.0, 6: 20900.0, 7: 20500.0}


def test_two_revisions_of_an_hour_give_one_score(spark, frame):
    rows = frame([("a", TARGET, 21000.0, None), ("a", TARGET, 20500.0, 1.0)], ACT).withColumn("seq", F.when(F.col("load_mw") > 20600, 1).otherwise(2))
    assert [r["actual_mw"] for r in pred.score(frame([record()], PRED), rows, arrival="seq").collect()] == [20500.0]
    assert pred.score(frame([record()], PRED), rows).count() == 1


@pytest.mark.parametrize("n,status", [(0, "empty"), (10, "accumulating"), (168, "measuring")])
def test_performance_needs_enough_rows(spark, n, status):
    rows = spark.range(n).select(F.lit("a").alias("series_id"), F.lit(100.0).alias("actual_mw"), F.lit(105.0).alias("load_mw"), F.lit(0.05).alias("ape"), F.lit(101.0).alias("tso_mw"))
    r = pred.performance(rows, ["series_id"], groups=spark.createDataFrame([("a",)], "series_id string")).first()
    assert r["status"] == status and r["breached"] == (n >= 168)
    assert r["sufficient"] == (n >= 168) and r["model_mape"] == (pytest.approx(5.0) if n else None)


@pytest.mark.parametrize("n,method", [(200, "ks_p_value"), (3000, "wasserstein_normed")])
@pytest.mark.parametrize("buckets", [None, 16])
def test_drift_names_exactly_the_moved_feature(spark, n, method, buckets):
    rng = np.random.default_rng(0)  # draw 1 is one of the 5 in 100 a 0.05 test must reject
    parts = [("moved", rng.normal(5, 1, n), True), ("moved", rng.normal(0, 1, n), False), ("still", rng.normal(0, 1, n), True), ("still", rng.normal(0, 1, n), False)]
    pdf = pd.concat([pd.DataFrame({"feature": f, "value": v, "is_current": c}) for f, v, c in parts])
    stats = two_sample(spark.createDataFrame(pdf), ["feature"], buckets=buckets)
    verdicts = drift_verdict(stats, method)
    for r in verdicts.collect():  # both scores and verdicts, at every size
        assert r["method"] == method and r["drifted_by_p_value"] == (r["ks_p_value"] < 0.05) and r["drifted_by_distance"] == (r["wasserstein_normed"] >= 0.1)
        assert r["drifted"] == (r["drifted_by_p_value"] if method == "ks_p_value" else r["drifted_by_distance"])
    with pytest.raises(ValueError):
        drift_verdict(stats, "by size")
    share = drift_share(verdicts).first()
    assert share["drifted_names"] == ["moved"] and share["drift_share"] == 0.5
    cur, old = (np.sort(v) for f, v, c in parts if f == "still")
    grid = np.sort(np.concatenate([cur, old]))
    gap = np.abs(np.searchsorted(cur, grid, "right") / n - np.searchsorted(old, grid, "right") / n)
    row = stats.filter("feature = 'still'").first()
    assert row["ks"] == pytest.approx(gap.max())
    assert row["wasserstein"] == pytest.approx(np.sum(gap[:-1] * np.diff(grid)))
    assert row["reference_std"] == pytest.approx(old.std())


def years(frame, days=1200):
    start = datetime(2021, 1, 1)
    return frame([("a", str(start + timedelta(days=i))) for i in range(days)], "series_id string, ts timestamp")


def test_reference_choice(frame):
    df = years(frame)
    tagged = ref.tag_windows(df, ref.current_windows(df))
    rich = ref.choose_reference(tagged, min_rows=60).first()
    assert rich["reference_strategy"] == "seasonal" and rich["reference_rows"] == 3 * 29
    poor = ref.choose_reference(tagged, min_rows=500, fallback_to_trailing=True).first()
    assert poor["reference_strategy"] == "trailing" and poor["reference_rows"] == 14
    kept = ref.choose_reference(tagged, min_rows=500).first()
    assert kept["reference_strategy"] == "seasonal" and (kept["seasonal_rows"], kept["trailing_rows"]) == (3 * 29, 14)


def test_only_hours_within_reach_are_read(spark, frame):
    df = years(frame)
    windows = ref.current_windows(df)
    near = ref.within_reach(df, windows, 48, "trailing")
    assert near.count() == 14 + 14 + 1 + 2
    assert {r["ts"] for r in ref.trailing_reference(df, windows).collect()} <= {r["ts"] for r in near.collect()}
    assert ref.within_reach(df, windows, 48).count() == 31 + 3 * 31


GATE = [
    (2.0, 5.0, None, True), (2.0, 5.0, 2.0, True), (2.04, 5.0, 2.0, True), (2.05, 5.0, 2.0, False), (5.0, 5.0, None, False),
    (6.0, 5.0, None, False), (float("nan"), 5.0, None, False), (float("inf"), 5.0, None, False), (None, 5.0, None, False),
    (2.0, float("nan"), None, False), (2.0, 5.0, float("nan"), False), (2.3075, 5.763, 2.115, False),
]


@pytest.mark.parametrize("candidate,naive,champion,expected", GATE)
def test_promotion_gate(spark, candidate, naive, champion, expected):
    df = spark.createDataFrame([(candidate, naive, champion)], "candidate double, naive double, champion double")
    row = lifecycle.promotion_decision(df).first()
    assert row["promote"] is expected and row["gate_reason"]


def test_tolerance_below_one_is_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0, 0.9)], "candidate double, naive double, champion double, tol double")
    with pytest.raises(ValueError):
        lifecycle.promotion_decision(df, max_regression=0.99)
    with pytest.raises(Exception, match="tolerance below 1"):
        lifecycle.promotion_decision(df, max_regression="tol").collect()


EV = "series_id string, pipeline string, event string, at timestamp, reason string"


def test_flag_keeps_the_first_reason_until_cleared(frame):
    e = [("a", "retrain", "raise", "2024-01-01", "one"), ("a", "retrain", "raise", "2024-01-02", "two")]
    assert lifecycle.retrain_flag(frame(e, EV)).first()["reason"] == "one"
    e.append(("a", "retrain", "clear", "2024-01-03", None))
    assert lifecycle.retrain_flag(frame(e, EV)).isEmpty()
    e.append(("a", "retrain", "raise", "2024-01-04", "three"))
    assert lifecycle.retrain_flag(frame(e, EV)).first()["reason"] == "three"


@pytest.mark.parametrize("events,due", [([], True), ([("2024-01-09")], False), ([("2024-01-03")], True)])
def test_retrain_due_by_cadence(spark, frame, events, due):
    rows = [("a", "retrain_if_needed", "success", at, None) for at in events]
    e = frame(rows, EV)
    known = spark.createDataFrame([("a",)], "series_id string")
    out = lifecycle.retrain_due(known, lifecycle.retrain_flag(e), lifecycle.last_success(e, "2024-01-10", ["series_id"]), "2024-01-10")
    assert out.first()["due"] is due


def test_prune_spares_aliased_runs(frame):
    runs = frame([("r1", "2024-01-01"), ("r2", "2024-01-01"), ("r3", "2024-12-01")], "run_id string, started_at timestamp")
    aliases = frame([("m", "champion", "1", "r1", "2024-01-02")], "model_name string, alias string, version string, run_id string, at timestamp")
    assert [r["run_id"] for r in lifecycle.prunable_runs(runs, aliases, "2024-12-31").collect()] == ["r2"]


def test_rebuild_decision(spark, frame):
    known = spark.createDataFrame([("a",), ("b",), ("c",)], "series_id string")
    stored = frame([("b", "2024-05-01"), ("c", "2019-01-01")], "series_id string, ts timestamp")
    out = {r["series_id"]: r["rebuild_reason"] for r in dataset.rebuild_decision(known, stored, "2019-01-01", 60, 24, 168).collect()}
    assert out == {"a": "no dataset", "b": "too short and starts late", "c": "none"}


def test_payloads(spark, tmp_path):
    good = '{"series_id":"a","hourly":{"time":["2024-01-01T01:00","2024-01-01T00:00"],"temperature_2m":[1.5,null]}}'
    offset = good.replace('{"series_id"', '{"utc_offset_seconds":3600,"series_id"')
    bare = '{"series_id":"b","hourly":{"time":["2024-01-01T00:00"]}}'
    (tmp_path / "p.json").write_text("\n".join([good, offset, bare]))
    from pyspark.sql.types import StringType, StructField, StructType

    raw = payload.read_payloads(spark, str(tmp_path / "p.json"), ["temperature_2m"], StructType([StructField("series_id", StringType())]))
    rows = payload.parse_hourly(raw, ["temperature_2m"], ["series_id"], strict=False).orderBy("ts").collect()
    assert [(r["ts"].hour, r["temp_c"]) for r in rows] == [(0, None), (1, 1.5)]
    assert {r["problem"] for r in payload.rejected_payloads(raw, ["temperature_2m"]).collect()} == {
        "expected UTC, got offset 3600s", "missing variables: temperature_2m"
    }
    with pytest.raises(Exception, match="expected UTC"):
        payload.parse_hourly(raw, ["temperature_2m"], ["series_id"]).collect()
    with pytest.raises(ValueError):
        payload.vintage_suffix(0)


@pytest.fixture(scope="module")
def stored(spark):
    n = 24 * 45
    pdf = pd.concat(
        pd.DataFrame(
            {
                "series_id": sid, "ts": [T0 + timedelta(hours=i) for i in range(n)],
                "load_mw": [18000 + 3000 * math.sin(i / 24 * 2 * math.pi) + 40 * (i % 11) + k * 500 for i in range(n)],
                "tso_forecast_mw": [18100 + 3000 * math.sin(i / 24 * 2 * math.pi) + k * 500 for i in range(n)],
                "temp_c": [float((i * 13) % 29) for i in range(n)], "wind_ms": [float(i % 5) for i in range(n)],
                "cloud_cover": [float(i % 97) for i in range(n)], "humidity_pct": 60.0,
            }
        )
        for k, sid in enumerate("ab")
    )
    path = shared_dir(spark, "stored")
    spark.createDataFrame(pdf).write.parquet(path)
    return spark.read.parquet(path)


def test_ingest_twice_and_extend(spark, stored, frame):
    path, marks = shared_dir(spark, "ds"), shared_dir(spark, "marks")
    load = stored.select("series_id", "ts", "load_mw", "tso_forecast_mw")
    weather = stored.select("series_id", "ts", *canonical.WEATHER)
    early, late = F.col("ts") < "2024-01-20", F.col("ts") >= "2024-02-01 06:00:00"
    dataset.ingest(spark, path, load.filter(early), weather.filter(early), "r1", marks, "2024-02-01")
    for _ in range(2):
        dataset.ingest(spark, path, load.filter(late), weather.filter(late), "r2", marks, "2024-02-02")
    table = canonical.read_periods(spark, path)
    assert table.count() == 2 * 24 * 45  # the hole is filled with null rows, nothing is doubled
    assert table.filter("load_mw is null").count() == 2 * (12 * 24 + 6)
    assert tables.read(spark, marks, tables.EVENTS).count() == 3


def test_grouped_linear_equals_lstsq(spark, stored):
    f = features.make_features(stored, 24)
    cols = ["hour", "temp_c", "wind_ms", "cloud_cover", "is_holiday"]
    got = {r["series_id"]: r["coefficients"] for r in models.fit_linear_groups(f, cols).collect()}
    for sid, part in f.toPandas().groupby("series_id"):
        x = np.column_stack([np.ones(len(part)), part[cols]])
        want = np.linalg.lstsq(x, part["target"], rcond=None)[0]
        np.testing.assert_allclose(x @ got[sid], x @ want, rtol=1e-8)


def test_linear_by_origin_equals_one_fit_per_origin(spark, stored):
    from loadloom.operators import splits

    f = features.make_features(stored, 24)
    table = splits.rolling_origins(f, 24, 14, 5, 5)
    cols = ["hour", "temp_c", "wind_ms"]
    got = evaluation.linear_by_origin(f, table, cols).toPandas().set_index(["series_id", "ts"])["y_pred"]
    data = f.toPandas()
    for s in table.collect():
        rows = data[data.series_id == s["series_id"]]
        train = rows[rows.ts <= s["train_end"]]
        test = rows[(rows.ts >= s["test_start"]) & (rows.ts <= s["test_end"])]
        beta = np.linalg.lstsq(np.column_stack([np.ones(len(train)), train[cols]]), train["target"], rcond=None)[0]
        want = np.column_stack([np.ones(len(test)), test[cols]]) @ beta
        np.testing.assert_allclose(got.loc[s["series_id"]].loc[test["ts"]].to_numpy(), want, rtol=1e-7)


def test_trees_band_and_forecast(spark, stored):
    from loadloom.operators import splits
    from loadloom.operators.scores import pinball_table

    names = features.feature_names(24)
    rows = splits.chronological_split(features.make_features(stored, 24), 10, 24).persist()
    train, later = rows.filter("block = 'train'"), rows.filter("block = 'validation'")
    champion = models.fit_trees(train, later, names, params={"maxIter": 8, "maxDepth": 4}, version="3")
    with pytest.raises(ValueError):
        champion.predict(later.drop("hour"))
    predicted = champion.predict(later)
    band = models.with_band(predicted, models.conformal_offsets(predicted))
    assert band.filter("p10 > p50 or p50 > p90").count() == 0
    long = band.select(F.explode(F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("quantile"), F.col("target").alias("y_true"), "p10", "p50", "p90")
    for q in (0.1, 0.9):
        loss = {c: pinball_table(long.filter(F.col("quantile") == q).withColumn("y_pred", F.col(c))).first()["pinball"] for c in ("p10", "p50", "p90")}
        assert min(loss, key=loss.get) == f"p{int(q * 100)}"
    gains = models.feature_importance(spark, champion)
    assert gains.count() == len(names) and gains.agg(F.sum("gain")).first()[0] == pytest.approx(1)
    weather = stored.select("series_id", "ts", *canonical.WEATHER)
    history = stored.filter("ts < '2024-02-10'")
    records = pred.forecast(history, weather, champion, "2024-02-10")
    assert records.count() == 48 and records.filter("model_version <> '3'").isEmpty()
    text = records.select(scalars.features_json("features").alias("t")).first()["t"]
    assert text.index('"cloud_cover"') < text.index('"wind_ms"')


def test_backtest_scores_every_model_on_the_same_hours(stored):
    out = evaluation.run_backtest(stored, 24, 14, 5, 5, trees=[]).groupBy("model").agg(F.count("*").alias("n"), F.count("y_pred").alias("k")).collect()
    assert len({(r["n"], r["k"]) for r in out}) == 1 and len(out) == 3 and out[0]["n"] == out[0]["k"] > 0


def test_lead_matched_hours_tile_once(stored):
    out = evaluation.run_gate_closure_backtest(stored, 14, 5, 5)
    own = out.filter(F.col("model") == evaluation.GATE_MODEL)
    assert own.groupBy("series_id", "ts").count().filter("count > 1").isEmpty()
    horizons = own.agg(F.min("horizon"), F.max("horizon")).first()
    assert (horizons[0], horizons[1]) == (14, 37)


def test_lead_matched_linear_equals_one_fit_per_horizon(spark, stored):
    """The served values against a plain fit of each horizon's own rows at each origin."""
    from loadloom.operators import splits as sp

    got = evaluation.run_gate_closure_backtest(stored, 14, 5, 5).filter(F.col("model") == evaluation.GATE_MODEL).toPandas()
    long = features.make_features_by_lead(stored)
    table = sp.rolling_origins(long.filter("horizon = 37"), 37, 14, 5, 5).toPandas()
    for h in (14, 25, 37):
        data = long.filter(F.col("horizon") == h).toPandas()
        for sid in "ab":
            rows, want = data[data.series_id == sid], {}
            for s in table[table.series_id == sid].sort_values("origin_no").itertuples():
                train = rows[rows.ts <= s.train_end]
                test = rows[(rows.ts >= s.test_start) & (rows.ts <= s.test_end) & rows.is_own_lead]
                x = lambda d: np.column_stack([np.ones(len(d)), d[list(features.LEAD_FEATURES)]]).astype(float)
                beta = np.linalg.lstsq(x(train), train["target"], rcond=None)[0]
                # A month or holiday that training never saw has no determined coefficient.
                known = test.month.isin(train.month.unique()) & test.is_holiday.isin(train.is_holiday.unique())
                want.update({at: v if k else None for at, v, k in zip(test.ts, x(test) @ beta, known)})
            mine = got[(got.series_id == sid) & (got.horizon == h)].set_index("ts")["y_pred"]
            mine = mine[[want[at] is not None for at in mine.index]]
            assert len(mine) > 10
            np.testing.assert_allclose(mine.to_numpy(), [want[at] for at in mine.index], rtol=1e-6)


def test_drift_check_statuses(spark, stored):
    log = stored.select(F.xxhash64("series_id", "ts").alias("id"), "series_id", F.col("ts").alias("target_time"), F.col("ts").alias("predicted_at"), F.lit(24).alias("horizon_hours"), F.lit("1").alias("model_version"), (F.col("load_mw") * 1.06).alias("load_mw"), F.col("load_mw").alias("actual_mw"))
    scored = log.withColumns({"ape": F.lit(0.06), "tso_mw": F.col("actual_mw")})
    out = monitoring.check_drift(stored, scored, log, strategy="trailing")
    for r in out.collect():
        assert r["status"] == "drift" and r["rolling_mape"] == pytest.approx(6) and "error" in r["reason_codes"].split()
        assert r["reference_strategy"] == "trailing" and r["monitored_features"] == 11
    quiet = monitoring.check_drift(stored.filter("ts < '2024-01-09'"), scored.filter("false"), log.filter("false"))
    assert {r["status"] for r in quiet.collect()} == {"insufficient_data"}
    path, marks = shared_dir(spark, "history"), shared_dir(spark, "flags")
    monitoring.record_check(out, path, marks)
    assert tables.read_drift_history(spark, path).count() == 2
    raised = tables.read(spark, marks, tables.EVENTS).filter("event = 'raise'")
    assert {r["series_id"] for r in raised.collect()} == {"a", "b"}


def test_retrain_outcomes(spark, stored, frame):
    events = frame([("a", "retrain", "raise", "2024-01-01", "drifted")], EV)
    runs, aliases = spark.createDataFrame([], tables.RUNS), spark.createDataFrame([], tables.ALIASES)
    young = lifecycle.retrain(stored, events, aliases, runs, "m", "2024-02-20", validation_days=60)
    assert young.status == lifecycle.INSUFFICIENT_DATA and young.events is None
    assert {(r["series_id"], r["due_code"]) for r in young.due.collect()} == {("a", "flag"), ("b", "never")}


def test_the_loop_closes_on_its_own_tables(spark, stored):
    """Ingest, forecast, check, record, retrain, retrain again: all from stored tables."""
    small = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.5}
    at = {n: shared_dir(spark, n) for n in ("ds", "events", "history", "runs", "gate", "aliases")}
    load = stored.select("series_id", "ts", "load_mw", "tso_forecast_mw")
    issues = dataset.ingest(spark, at["ds"], load, stored.select("series_id", "ts", *canonical.WEATHER), "r1", at["events"], "2024-02-15")
    assert issues.filter("severity = 'error'").isEmpty()
    table = canonical.read_periods(spark, at["ds"])
    log = table.select(F.xxhash64("series_id", "ts").alias("id"), "series_id", F.col("ts").alias("target_time"), F.col("ts").alias("predicted_at"), F.lit(24).alias("horizon_hours"), F.lit("1").alias("model_version"), (F.col("load_mw") * 1.06).alias("load_mw"), F.lit("r").alias("model_name"))
    scored = pred.scored_predictions(log, pred.score(log, table))
    monitoring.record_check(monitoring.check_drift(table, scored, log, strategy="trailing"), at["history"], at["events"])
    events = lambda: tables.read(spark, at["events"], tables.EVENTS)
    assert {r["series_id"] for r in lifecycle.retrain_flag(events()).collect()} == {"a", "b"}

    def retrain(now, **how):
        out = lifecycle.retrain(
            canonical.read_periods(spark, at["ds"]), events(), tables.read(spark, at["aliases"], tables.ALIASES),
            tables.read(spark, at["runs"], tables.RUNS), "m", now, validation_days=7, params=small, **how,
        )
        lifecycle.record_retrain(out, at["events"], at["runs"], at["gate"], at["aliases"])
        return out

    first = retrain("2024-02-20")
    assert first.status == lifecycle.PROMOTED and first.champion.version in ("1", "2")
    assert lifecycle.retrain_flag(events()).isEmpty()
    stored_runs = tables.read(spark, at["runs"], tables.RUNS)
    assert {(r["model_name"], r["version"]) for r in stored_runs.collect()} == {("m", "1"), ("m", "2")}
    best = stored_runs.orderBy(F.element_at("metrics", "mape")).first()
    champion = lifecycle.champion_metric(tables.read(spark, at["aliases"], tables.ALIASES), stored_runs, "mape").first()
    assert (champion["run_id"], champion["version"]) == (best["run_id"], best["version"]) and champion["champion"] > 0
    assert retrain("2024-02-21").status == lifecycle.SKIPPED
    second = retrain("2024-02-22", force=True)
    assert {r["version"] for r in second.decisions.collect()} == {"3", "4"}
    codes = {r["code"] for r in second.decisions.collect()}
    assert codes <= {"accepted", "regression", "worse_than_naive"}  # judged against the stored champion
    served = pred.forecast(table.filter("ts < '2024-02-10'"), table.select("series_id", "ts", *canonical.WEATHER), first.champion, "2024-02-10")
    assert served.count() == 48 and served.filter("p10 IS NULL OR p10 > p50 OR p50 > p90").isEmpty()


def test_an_unknown_champion_run_holds(spark, frame):
    aliases = frame([("m", "champion", "9", "gone", "2024-01-02")], "model_name string, alias string, version string, run_id string, at timestamp")
    value = lifecycle.champion_metric(aliases, spark.createDataFrame([], tables.RUNS), "mape", "ingested")
    cand = spark.createDataFrame([("m", "10", "r10", 1.0, 2.0)], "model_name string, version string, run_id string, candidate double, naive double")
    row = lifecycle.promotion_decision(cand.join(value.select("model_name", "champion"), "model_name", "left")).first()
    assert not row["promote"] and row["gate_code"] == "champion_invalid"


def test_the_best_candidate_gets_the_alias_and_versions_are_numbers(spark, frame):
    rows = [("m", "9", "r9", 1.5, 2.0, None), ("m", "10", "r10", 1.2, 2.0, None), ("m", "11", "r11", 1.9, 2.0, None)]
    cand = spark.createDataFrame(rows, "model_name string, version string, run_id string, candidate double, naive double, champion double")
    _, moves = lifecycle.apply_gate(lifecycle.promotion_decision(cand), "2024-01-01")
    assert [(r["version"], r["run_id"]) for r in moves.collect()] == [("10", "r10")]
    same = frame([("m", "champion", v, f"r{v}", "2024-01-01") for v in ("9", "10")], "model_name string, alias string, version string, run_id string, at timestamp")
    assert lifecycle.current_alias(same).first()["version"] == "10"


def test_a_job_leaves_no_scratch_behind(spark, stored):
    import os

    from loadloom.session import scratch

    with scratch(spark) as made:
        assert evaluation.run_backtest(stored, 24, 14, 5, 5, trees=[]).count() > 0
        assert len(made) >= 2 and all(os.path.isdir(p) for p in made)
    assert not any(os.path.exists(p) for p in made)


def test_a_session_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")


def test_stream_keeps_the_last_revision(spark, frame):
    rows = [("a", str(T0 + timedelta(minutes=15 * i)), 1.0, i) for i in range(4)]
    rows += [("a", str(T0 + timedelta(minutes=15 * i)), 3.0, 10 + i) for i in range(4)]
    rows += [("a", str(T0 + timedelta(days=20)), 0.0, 99)]
    path = shared_dir(spark, "raw")
    df = frame(rows, "series_id string, ts timestamp, value double, ingest_seq long")
    df.write.parquet(path)
    slots = streams.run_upserted(streams.revised_slots_stream(streams.read_stream(spark, path, df.schema)), "t", ["series_id", "ts"])
    out = streams.hourly_of_slots(slots).orderBy("ts")
    assert [(r["load_mw"], r["slots"]) for r in out.collect()] == [(3.0, 4), (0.0, 1)]  # the newest hour is there too


def test_updates_over_several_batches(spark, frame):
    schema = "series_id string, ts timestamp, value double"
    path = shared_dir(spark, "raw")
    for i, v in enumerate((1.0, 3.0, 5.0)):
        frame([("a", str(T0 + timedelta(minutes=15 * i)), v)], schema).coalesce(1).write.mode("append").parquet(path)
    source = streams.read_stream(spark, path, "series_id string, ts timestamp, value double", files_per_trigger=1)
    out = streams.run_upserted(streams.hourly_stream(source), "h", ["series_id", "ts"])
    assert [(r["load_mw"], r["readings"]) for r in out.collect()] == [(3.0, 3)]
