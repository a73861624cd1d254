"""Revision history: intervals, replays, ties, late pulls, touched folders, scores as known then."""

import os

import numpy as np
from pyspark.sql import functions as F

from loadloom.plans import predictions as pred
from loadloom.plans import revisions
from loadloom.sources import tables

SCHEMA = "series_id string, ts timestamp, load_mw double, tso_forecast_mw double, seq int"


def pull(frame, rows):
    return frame([(s, t, *v, i) for i, (s, t, *v) in enumerate(rows)], SCHEMA)


def state(spark, path, df):
    rows = revisions.read_history(spark, path, revisions.history_schema(df)).collect()
    text = lambda t: None if t is None else t.strftime("%d")
    return sorted(((r.series_id, r.ts.strftime("%m-%d %H"), r.load_mw, text(r.valid_from), text(r.valid_to)) for r in rows), key=repr)


def changed(df):
    return sorted((r.series_id, r.ts.strftime("%m-%d %H")) for r in df.collect())


def test_intervals_of_changed_hours_close_and_open(spark, frame, tmp_path):
    path = str(tmp_path / "h")
    first = pull(frame, [("a", "2024-01-01 00:00:00", 1.0, 5.0), ("a", "2024-01-01 01:00:00", None, 5.0), ("b", "2024-02-01 00:00:00", 2.0, None)])
    assert len(changed(revisions.apply_revisions(spark, path, first, "2024-03-01"))) == 3
    second = pull(frame, [("a", "2024-01-01 00:00:00", 1.0, 5.0), ("a", "2024-01-01 01:00:00", 7.0, 5.0), ("b", "2024-02-01 00:00:00", None, None)])
    assert changed(revisions.apply_revisions(spark, path, second, "2024-03-05")) == [("a", "01-01 01"), ("b", "02-01 00")]
    want = [
        ("a", "01-01 00", 1.0, "01", None), ("a", "01-01 01", 7.0, "05", None), ("a", "01-01 01", None, "01", "05"),
        ("b", "02-01 00", 2.0, "01", "05"), ("b", "02-01 00", None, "05", None),
    ]
    assert sorted(state(spark, path, first), key=repr) == sorted(want, key=repr)
    # The same pull again, and one from before: nothing changes.
    assert changed(revisions.apply_revisions(spark, path, second, "2024-03-05")) == []
    assert changed(revisions.apply_revisions(spark, path, first.filter("series_id = 'a'"), "2024-03-02")) == []
    # A second pull of the same time replaces the first.
    third = pull(frame, [("a", "2024-01-01 01:00:00", 8.0, 5.0)])
    assert changed(revisions.apply_revisions(spark, path, third, "2024-03-05")) == [("a", "01-01 01")]
    assert {r[2] for r in state(spark, path, first) if r[1] == "01-01 01"} == {None, 8.0}
    assert sum(r[1] == "01-01 01" for r in state(spark, path, first)) == 2


def test_history_equals_a_plain_one_after_many_pulls(spark, frame, tmp_path):
    rng, path, known, log = np.random.default_rng(5), str(tmp_path / "h"), {}, []
    for day in range(1, 5):
        rows = [(str(s), f"2024-0{m}-01 0{h}:00:00", float(v), None) for s, m, h, v in zip(rng.choice(list("ab"), 12), rng.integers(1, 4, 12), rng.integers(0, 4, 12), rng.integers(0, 3, 12))]
        df = pull(frame, rows)
        found = changed(revisions.apply_revisions(spark, path, df, f"2024-05-0{day}", arrival="seq"))
        latest = {(s, t[5:13]): v for s, t, v, _ in rows}
        assert found == sorted(k for k, v in latest.items() if known.get(k) != v)
        known |= latest
        log.append(dict(known))
    history = revisions.read_history(spark, path, revisions.history_schema(df))
    for day, want in enumerate(log, 1):
        got = {(r.series_id, r.ts.strftime("%m-%d %H")): r.load_mw for r in revisions.as_of(history, f"2024-05-0{day} 12:00:00").collect()}
        assert got == want
    assert revisions.as_of(history, "2024-04-30").count() == 0


def test_only_folders_with_changes_are_written(spark, frame, tmp_path):
    path = str(tmp_path / "h")
    df = pull(frame, [("a", f"2024-0{m}-01 00:00:00", 1.0, None) for m in (1, 2, 3)])
    revisions.apply_revisions(spark, path, df, "2024-05-01")
    files = lambda: {p: sorted(os.listdir(f"{path}/{p}")) for p in os.listdir(path) if p.startswith("period=")}
    before = files()
    revisions.apply_revisions(spark, path, df.withColumn("load_mw", F.when(F.month("ts") == 2, 9.0).otherwise(1.0)), "2024-05-02")
    after = files()
    assert {p for p in after if after[p] != before[p]} == {"period=2024-02"}
    assert changed(revisions.apply_revisions(spark, str(tmp_path / "none"), df.limit(0), "2024-05-01")) == []


def test_scores_of_changed_hours_and_as_known_then(spark, frame, tmp_path):
    path, scores = str(tmp_path / "h"), str(tmp_path / "s")
    made = frame([(i, "a", f"20{y}-06-01 00:00:00", 110.0) for i, y in enumerate((10, 17, 24))], "id long, series_id string, target_time timestamp, load_mw double")
    log = str(tmp_path / "log")
    tables.append_predictions(made, log)
    first = pull(frame, [("a", f"20{y}-06-01 00:00:00", 100.0, 90.0) for y in (10, 17, 24)])
    revisions.apply_revisions(spark, path, first, "2024-07-01")
    history = lambda: revisions.read_history(spark, path, revisions.history_schema(first))
    pred.rescore(spark, log, scores, revisions.as_of(history()))
    found = revisions.apply_revisions(spark, path, first.withColumn("load_mw", F.when(F.year("ts") == 2017, 100.0).otherwise(200.0)), "2024-08-01")
    revisions.rescore_changed(spark, log, scores, history(), found)
    got = {r.prediction_id: round(r.ape, 4) for r in tables.read_scores(spark, scores).collect()}
    assert got == {0: 0.45, 1: 0.1, 2: 0.45}
    then = {r.prediction_id: round(r.ape, 4) for r in revisions.score_as_known(made, history(), "2024-07-15").collect()}
    assert then == {0: 0.1, 1: 0.1, 2: 0.1}


def test_rescoring_reads_only_the_days_it_needs(spark, frame, tmp_path):
    """A revision of 2010 beside one of 2024: no day between them is read from the log."""
    log = str(tmp_path / "log")
    tables.append_predictions(frame([(i, "a", f"20{10 + i}-06-01 00:00:00", 1.0) for i in range(15)], "id long, series_id string, target_time timestamp, load_mw double"), log)
    actuals = frame([("a", "2010-06-01 00:00:00", 1.0), ("a", "2024-06-01 00:00:00", 1.0)], "series_id string, ts timestamp, load_mw double")
    days = [r.d for r in actuals.select(F.to_date("ts").alias("d")).collect()]
    read = tables.read_predictions(spark, log, days=days)
    assert read.count() == 2 and len(read.inputFiles()) == 2 or "PartitionFilters: [target_date" in read._jdf.queryExecution().executedPlan().toString()
    pred.rescore(spark, log, str(tmp_path / "s"), actuals)
    assert tables.read_scores(spark, str(tmp_path / "s")).count() == 2
