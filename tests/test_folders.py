"""Folder state: sums that merge, ingests that read no stored row outside the touched folders."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadloom.plans import dataset, folders
from loadloom.sources import canonical


def hours(frame, first, n, value=lambda i: 20_000.0 + i):
    rows = [("a", f"2024-{first // 31 + 1:02d}-{first % 31 + i // 24 + 1:02d} {i % 24:02d}:00:00", value(i), 20_000.0) for i in range(n)]
    return frame(rows, "series_id string, ts timestamp, load_mw double, tso_forecast_mw double")


def weather(load):
    return load.select("series_id", "ts", *[F.lit(1.0).alias(c) for c in ("temp_c", "wind_ms", "cloud_cover", "humidity_pct")])


def test_sums_of_parts_are_the_whole_and_follow_content(frame):
    df = hours(frame, 0, 200).withColumn("load_mw", F.when(F.hour("ts") != 3, F.col("load_mw")))
    whole = folders.fingerprints(folders.folder_state(df)).first()["fingerprint"]
    rng = np.random.default_rng(1)
    for grain in ("day", "month"):
        for cut in rng.integers(1, 24, 3).tolist():
            parts = folders.folder_state(df.filter(F.hour("ts") < cut), grain).unionByName(folders.folder_state(df.filter(F.hour("ts") >= cut), grain))
            assert folders.fingerprints(parts).first()["fingerprint"] == whole
    one = F.col("ts") == "2024-01-02 05:00:00"
    others = [
        df.withColumn("load_mw", F.when(one, 1.0).otherwise(F.col("load_mw"))), df.withColumn("load_mw", F.when(~one, F.col("load_mw"))),
        df.filter(~one), df.unionByName(df.filter(one)), df.select("series_id", "ts", F.col("tso_forecast_mw").alias("load_mw"), F.col("load_mw").alias("tso_forecast_mw")),
    ]
    assert len({whole, *[folders.fingerprints(folders.folder_state(d)).first()["fingerprint"] for d in others]}) == 6
    assert folders.fingerprints(folders.folder_state(df.limit(0))).first()["n"] == 0


def test_ingest_reads_touched_folders_only(spark, frame, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    load = hours(frame, 0, 24 * 6)
    dataset.ingest(spark, path, load, weather(load), "r1", grain="day", state_path=state)
    # Whoever reads another folder than the last one now fails.
    for p in os.listdir(path):
        if p.startswith("period=") and p != "period=2024-01-06":
            for f in os.listdir(f"{path}/{p}"):
                if f.endswith(".parquet"):
                    with open(f"{path}/{p}/{f}", "wb") as out:
                        out.write(b"not a parquet file")
                elif f.endswith(".crc"):
                    os.truncate(f"{path}/{p}/{f}", 0)
    later = hours(frame, 5, 48, lambda i: 25_000.0 + i)
    dataset.ingest(spark, path, later, weather(later), "r2", grain="day", whole=False, state_path=state)
    kept = folders.read_state(spark, state)
    total = folders.merged_state(kept).first()
    assert (total["n"], str(total["first_ts"]), str(total["last_ts"])) == (24 * 7, "2024-01-01 00:00:00", "2024-01-07 23:00:00")
    successes = spark.createDataFrame([], "series_id string, last_success timestamp")
    assert str(dataset.resume_points(None, successes, state=kept).first()["resume_from"]) == "2024-01-07 23:00:00"
    known = spark.createDataFrame([("a",), ("b",)], "series_id string")
    reasons = {r.series_id: (r.hours, r.rebuild_reason) for r in dataset.rebuild_decision(known, None, "2023-01-01", 2, 24, 168, state=kept).collect()}
    assert reasons == {"a": (168, "too short and starts late"), "b": (0, "no dataset")}
    with pytest.raises(Exception):
        canonical.read_periods(spark, path).agg(F.sum("load_mw")).collect()


def test_hole_between_stored_hours_and_pull_is_filled_with_state(spark, frame, tmp_path):
    with_state, without = str(tmp_path / "a"), str(tmp_path / "b")
    for path, state in ((with_state, str(tmp_path / "s")), (without, None)):
        for first in (10, 20):
            load = hours(frame, first, 30)
            dataset.ingest(spark, path, load, weather(load), "r", grain="day", whole=False, state_path=state)
    a, b = (canonical.read_periods(spark, p) for p in (with_state, without))
    assert a.count() == b.count() and folders.fingerprints(folders.folder_state(a)).first() == folders.fingerprints(folders.folder_state(b)).first()
    assert folders.fingerprints(folders.read_state(spark, str(tmp_path / "s"))).first() == folders.fingerprints(folders.folder_state(a)).first()


def test_a_table_without_state_gets_one(spark, frame, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    load = hours(frame, 0, 48)
    dataset.ingest(spark, path, load, weather(load), "r", grain="day", whole=False)
    dataset.ingest(spark, path, load.filter("ts > '2024-01-02'"), weather(load), "r", grain="day", whole=False, state_path=state)
    assert folders.merged_state(folders.read_state(spark, state)).first()["n"] == 48
