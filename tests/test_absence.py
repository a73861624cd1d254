"""Absence detection in a stream: the state by itself, late readings, silence, restarts; panes."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadloom.operators.islands import hour_runs
from loadloom.streaming import streams
from loadloom.streaming.streams import Absence, finalised, with_hours

T0 = datetime(2024, 1, 1)


def test_state_equals_a_plain_scan_in_any_order():
    """Hours arrive up to 30 late, behind a watermark that follows 31 behind the greatest seen."""
    rng = np.random.default_rng(1)
    for _ in range(40):
        present = sorted(rng.choice(200, int(rng.integers(2, 120)), replace=False).tolist())
        rest = sorted(present[1:], key=lambda h: h + rng.uniform(0, 30))
        state, rows, top = None, [], -1
        for part in np.array_split([present[0], *rest], int(rng.integers(1, 12))):
            state = with_hours(state, part.tolist())
            state, found = finalised(state, top - 31) if state else (None, [])
            rows += found
            top = max([top, *part.tolist()])
        state, found = finalised(state, 260)
        rows += found
        assert [a for kind, a, _ in rows if kind == "missing"] == [h for h in range(present[0], 260) if h not in set(present)]
        gaps = [(a + 1, b - 1) for a, b in zip(present, present[1:]) if b > a + 1]
        assert [(a, b) for kind, a, b in rows if kind == "outage"] == gaps
        assert state == Absence(260, present[-1] + 1, [], [])


def test_final_hours_do_not_change():
    state, rows = finalised(with_hours(None, [5, 6, 9]), 8)
    assert rows == [("missing", 7, 7)] and state == Absence(8, 7, [9], [9])
    assert with_hours(state, [7, 5]) == state
    state, rows = finalised(with_hours(state, [8]), 20)
    assert rows[0] == ("outage", 7, 7) and [r for r in rows if r[0] == "missing"] == [("missing", h, h) for h in range(10, 20)]
    assert state == Absence(20, 10, [], [])


@pytest.fixture
def source(spark, tmp_path):
    """Writes a file of (series_id, hour) readings each time it is called; the stream reads the folder."""
    folder = str(tmp_path / "in")

    def put(rows):
        data = [(s, T0 + timedelta(hours=h, minutes=7)) for s, h in rows]
        spark.createDataFrame(data, "series_id string, ts timestamp").coalesce(1).write.mode("append").parquet(folder)
        return streams.read_stream(spark, folder, "series_id string, ts timestamp", files_per_trigger=1)

    return put


def outages(df):
    return sorted((r.series_id, int((r.first_ts - T0).total_seconds() // 3600), r.hours) for r in df.collect() if r.kind == "outage")


def test_outages_in_a_stream_that_restarts(spark, source, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(rows):
        return streams.run_available(streams.absence_stream(source(rows), "5 hours"), "absence", out, checkpoint)

    run([("a", 0), ("a", 1), ("a", 5), ("b", 0)])
    found = run([("a", 3), ("a", 20), ("b", 2)])  # hour 3 and b's hour 2 come late, but not too late
    assert outages(found) == [("a", 2, 1), ("a", 4, 1), ("b", 1, 1)]
    silent = [r for r in found.collect() if r.series_id == "b" and r.kind == "missing"]
    assert [int((r.first_ts - T0).total_seconds() // 3600) for r in silent] == [1, *range(3, 15)]  # by its timer, without a reading
    found = run([("b", 30), ("a", 3), (None, 100)])  # a's hour 3 is final; a row without a series moves the watermark
    assert outages(found) == [("a", 2, 1), ("a", 4, 1), ("a", 6, 14), ("b", 1, 1), ("b", 3, 27)]
    missing = {(r.series_id, r.first_ts) for r in found.collect() if r.kind == "missing"}
    assert len(missing) == found.filter("kind = 'missing'").count()  # none twice


def test_stream_equals_the_runs_of_the_batch_form(spark, source):
    rng = np.random.default_rng(2)
    rows = [(s, int(h)) for s in "abc" for h in sorted(rng.choice(300, 200, replace=False))]
    source(rows[::2])
    found = streams.run_available(streams.absence_stream(source([*rows[1::2], (None, 9000)]), "20 days"), "absence")
    gaps = [(s, T0 + timedelta(hours=h)) for s in "abc" for h in range(min(x for t, x in rows if t == s), max(x for t, x in rows if t == s)) if (s, h) not in set(rows)]
    runs = hour_runs(spark.createDataFrame(gaps, "series_id string, ts timestamp"))
    want = sorted((r.series_id, r.first_ts, r.last_ts, r.hours) for r in runs.collect())
    assert sorted((r.series_id, r.first_ts, r.last_ts, r.hours) for r in found.filter("kind = 'outage'").collect()) == want


def test_panes_give_the_windows_of_the_rows(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(str(s), T0 + timedelta(hours=int(h)), None if h % 11 == 0 else float(h % 7)) for s, h in zip(rng.choice(list("ab"), 400), rng.integers(0, 24 * 40, 400))]
    schema = "series_id string, target_time timestamp, ape double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([(T0 + timedelta(days=200),)], "target_time timestamp").write.parquet(str(tmp_path / "c"))
    stream = streams.with_clock(streams.read_stream(spark, str(tmp_path / "p"), schema), streams.read_stream(spark, str(tmp_path / "c"), "target_time timestamp"), "target_time")
    found = streams.run_available(streams.sliding_performance_stream(stream), "panes").filter("series_id IS NOT NULL")
    batch = spark.createDataFrame(rows, schema).groupBy("series_id", F.window("target_time", "14 days", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"), (F.avg("ape") * 100).alias("m"))
    got = sorted((r.series_id, r.window_start, r.scored, round(r.model_mape, 9)) for r in found.collect())
    assert got == sorted((r.series_id, r.w.start, r.n, round(r.m, 9)) for r in batch.collect())


def test_upserted_table_holds_every_key_once_and_goes_on(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    schema = "series_id string, ts timestamp, value double, ingest_seq long"

    def run(rows):
        data = [(s, T0 + timedelta(hours=h), v, q) for s, h, v, q in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
        slots = streams.revised_slots_stream(streams.read_stream(spark, folder, schema, files_per_trigger=1), "1 hour")
        return streams.run_upserted(slots, "t", ["series_id", "ts"], out, checkpoint=checkpoint)

    def shown(df):
        return sorted((r.series_id, int((r.ts - T0).total_seconds() // 3600), r.value) for r in df.collect())

    assert shown(run([("a", 0, 1.0, 1), ("a", 30, 2.0, 2), ("b", 0, 3.0, 3)])) == [("a", 0, 1.0), ("a", 30, 2.0), ("b", 0, 3.0)]
    before = (tmp_path / "out" / "period=2024-01-02")
    kept = sorted(p.name for p in before.iterdir())
    assert shown(run([("a", 0, 9.0, 4), ("c", 1, 5.0, 5)])) == [("a", 0, 9.0), ("a", 30, 2.0), ("b", 0, 3.0), ("c", 1, 5.0)]
    assert sorted(p.name for p in before.iterdir()) == kept  # an untouched day is not rewritten
