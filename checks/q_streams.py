"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadloom.plans import predictions as pred
from loadloom.session import shared_dir
from loadloom.streaming import streams

from . import frames as fr
from .registry import query



def _readings_stream(spark, sf):
    raw = streams.read_stream(spark, sf, fr.SCHEMAS["events"], glob="events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    slot = F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 900) * 900)
    return raw.select(F.col("event_type").alias("series_id"), slot.alias("ts"), (F.sqrt("value") * 10).alias("value"), F.col("event_id").alias("ingest_seq"))


def _folder_stream(df, name):
    """A stream over a stored folder of the frame's rows."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return streams.read_stream(spark, path, df.schema)


@query("x1_hourly_stream", "SELECT series_id, date_trunc('hour', ts) AS ts, avg(value) AS load_mw, count(*) AS readings FROM readings GROUP BY ALL", "load_mw")
def _(spark, sf):
    return streams.run_upserted(streams.hourly_stream(_readings_stream(spark, sf)), "x1", ["series_id", "ts"])


@query("x2_revised_hourly_stream", "SELECT series_id, date_trunc('hour', ts) AS ts, avg(value) AS load_mw, count(*) AS slots FROM slots GROUP BY ALL", "load_mw")
def _(spark, sf):
    slots = streams.run_upserted(streams.revised_slots_stream(_readings_stream(spark, sf)), "x2", ["series_id", "ts"])
    return streams.hourly_of_slots(slots)


@query("x3_score_upsert_stream", "SELECT prediction_id, actual_mw, ape FROM scores", "actual_mw ape")
def _(spark, sf):
    """Two revisions of every hour, the wrong one first; a micro-batch for each file."""
    p, h = fr.predictions(spark, sf), fr.history(spark, sf)
    first = h.withColumn("load_mw", F.col("load_mw") * 2).withColumn("seq", F.lit(1))
    both = first.unionByName(h.withColumn("seq", F.lit(2)))
    path = shared_dir(spark, "actuals")
    both.repartition(4, F.year("ts")).write.parquet(path)
    actuals = streams.read_stream(spark, path, both.schema, files_per_trigger=2)
    done = streams.rescore_stream(actuals, p, shared_dir(spark, "stream-scores"), arrival="seq", grain="month")
    return done.select("prediction_id", "actual_mw", "ape")


X4 = """, b AS (SELECT series_id, ape, unnest(generate_series(CAST(floor(epoch(target_time) / 86400) AS BIGINT) - 13, CAST(floor(epoch(target_time) / 86400) AS BIGINT))) AS d FROM standing)
SELECT series_id, make_timestamp(d * 86400000000) AS window_start, make_timestamp((d + 14) * 86400000000) AS window_end, count(*) AS scored, avg(ape) * 100 AS model_mape
FROM b GROUP BY ALL"""


def _clock(spark, times, at, name):
    """One row two months after the last time of a table: whatever came before is final then."""
    late = times.agg((F.max(at).cast("timestamp") + F.expr("INTERVAL 60 DAYS")).alias(at))
    return _folder_stream(late, name)


@query("x4_sliding_performance_stream", X4, "model_mape")
def _(spark, sf):
    """Daily panes, then windows of fourteen of them, chained in append mode."""
    p = fr.predictions(spark, sf)
    standing = pred.scored_predictions(p, pred.score(p, fr.history(spark, sf))).select("series_id", "target_time", "ape")
    rows = streams.with_clock(_folder_stream(standing, "standing"), _clock(spark, p, "target_time", "x4-clock"), "target_time")
    return streams.run_available(streams.sliding_performance_stream(rows), "x4").filter("series_id IS NOT NULL")


X5 = """, m AS (SELECT series_id, ts FROM spine EXCEPT SELECT series_id, ts FROM hourly),
g AS (SELECT *, CAST(epoch(ts) / 3600 AS BIGINT) - row_number() OVER (PARTITION BY series_id ORDER BY ts) AS k FROM m)
SELECT series_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS hours FROM g GROUP BY series_id, k"""


@query("x5_outage_session_stream", X5)
def _(spark, sf):
    """Outages found in the stream of readings itself, by keyed state and timers."""
    readings = streams.with_clock(_readings_stream(spark, sf), _clock(spark, fr.table(spark, sf, "events"), "ts", "x5-clock"))
    found = streams.run_available(streams.absence_stream(readings), "x5")
    return found.filter("kind = 'outage'").drop("kind")


@query("x6_prediction_actual_stream_join", "SELECT p.id, p.series_id, p.target_time, p.load_mw, h.load_mw AS actual_mw FROM preds p JOIN hist h ON h.series_id = p.series_id AND h.ts = p.target_time", "load_mw actual_mw")
def _(spark, sf):
    p = fr.predictions(spark, sf).select("id", "series_id", "target_time", "load_mw")
    a = fr.history(spark, sf).select("series_id", F.col("ts").alias("actual_ts"), "load_mw")
    joined = streams.scored_stream(_folder_stream(p, "made"), _folder_stream(a, "known"))
    return streams.run_available(joined, "x6")
