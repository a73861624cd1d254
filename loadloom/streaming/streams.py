"""The batch semantics as Structured Streaming queries.

Late data up to 14 days is the rule everywhere: that is how far actuals are revised.
Functions take a streaming (or batch) frame and return one; ``run_available`` drives a
query to completion for tests and catch-up jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import KEYS, TS
from ..functions.clock import hour_number, hour_start
from ..plans import predictions as pred
from ..session import shared_dir, through_table
from ..sources import tables
from ..sources.canonical import path_exists

LATENESS = "14 days"


def read_stream(spark: SparkSession, folder: str, schema: T.StructType | str, glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def hourly_stream(readings: DataFrame, value: str = "value", lateness: str = LATENESS, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Tumbling hourly mean. In update mode every hour comes at once and again when revised;
    an hour older than the lateness is final and leaves the state."""
    w = F.window(ts, "1 hour")
    return (
        readings.withWatermark(ts, lateness)
        .groupBy(*keys, w)
        .agg(F.avg(value).alias("load_mw"), F.count(F.lit(1)).alias("readings"))
        .select(*keys, F.col("window.start").alias(ts), "load_mw", "readings")
    )


def revised_slots_stream(
    readings: DataFrame, slot: str = "15 minutes", value: str = "value", seq: str = "ingest_seq",
    lateness: str = LATENESS, keys: Sequence[str] = KEYS, ts: str = TS,
) -> DataFrame:
    """Last revision per slot. The built-in duplicate dropping keeps the first arrival;
    revisions need the last. ``hourly_of_slots`` makes hours of the stored result."""
    return (
        readings.withWatermark(ts, lateness)
        .groupBy(*keys, F.window(ts, slot).alias("_slot"))
        .agg(F.max_by(value, seq).alias(value))
        .select(*keys, F.col("_slot.start").alias(ts), value)
    )


def hourly_of_slots(slots: DataFrame, value: str = "value", keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    return slots.groupBy(*keys, F.date_trunc("hour", ts).alias(ts)).agg(
        F.avg(value).alias("load_mw"), F.count(F.lit(1)).alias("slots")
    )


def sliding_performance_stream(
    scored: DataFrame, window: str = "14 days", slide: str = "1 day", lateness: str = LATENESS,
    by: Sequence[str] = KEYS, at: str = "target_time",
) -> DataFrame:
    """Served error over sliding windows of target time, from panes of one slide.

    A first aggregation keeps one row per key and pane; a closed pane enters the windows that
    hold it as a pair of sums. The state has no copy of a row per window. Append mode: a window
    comes once, when the watermark has passed it.
    """
    panes = (
        scored.withWatermark(at, lateness)
        .groupBy(*by, F.window(at, slide).alias("_pane"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.count("ape").alias("_n"), F.sum("ape").alias("_ape"))
        .withColumn("_at", F.window_time("_pane"))
    )
    return (
        panes.groupBy(*by, F.window("_at", window, slide).alias("_w"))
        .agg(F.sum("_rows").alias("scored"), (F.sum("_ape") / F.nullif(F.sum("_n"), F.lit(0)) * 100).alias("model_mape"))
        .select(*by, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "scored", "model_mape")
    )


def with_clock(stream: DataFrame, clock: DataFrame, ts: str = TS) -> DataFrame:
    """``stream`` with rows of a second stream that carry a time and nothing else.

    They move the watermark on when a source is silent; ``clock`` has the one column ``ts``.
    """
    return stream.unionByName(clock.select(ts), allowMissingColumns=True)


class Absence(NamedTuple):
    """What is kept of a series: hours before ``next`` are final; ``open``: first hour of the outage
    that goes on (none: ``_NO``); runs of hours with readings from ``next`` on."""

    next: int
    open: int
    starts: list[int]
    ends: list[int]


_NO = -(2**62)


def with_hours(state: Absence | None, hours: Iterable[int]) -> Absence | None:
    """``state`` with further hours that have readings; hours that are final already change nothing."""
    known = set(hours)
    if state is not None:
        known = {h for h in known if h >= state.next}
    if not known:
        return state
    runs = sorted([*zip(state.starts, state.ends), *((h, h) for h in known)] if state else ((h, h) for h in known))
    merged = [list(runs[0])]
    for a, b in runs[1:]:
        if a <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return Absence(state.next if state else merged[0][0], state.open if state else _NO, [a for a, _ in merged], [b for _, b in merged])


def finalised(state: Absence, before: int) -> tuple[Absence, list[tuple[str, int, int]]]:
    """All hours under ``before`` made final: the new state, and rows (kind, first hour, last hour).

    Every final hour without readings is a ``missing`` row; an outage is a row when the first
    final hour with readings follows it.
    """
    rows, at, open_, runs = [], state.next, state.open, list(zip(state.starts, state.ends))
    while at < before:
        if runs and runs[0][0] <= at:
            if open_ != _NO:
                rows.append(("outage", open_, at - 1))
                open_ = _NO
            at = min(runs[0][1] + 1, before)
            if runs[0][1] < at:
                runs.pop(0)
        else:
            to = min(runs[0][0] if runs else before, before)
            open_ = at if open_ == _NO else open_
            rows += [("missing", h, h) for h in range(at, to)]
            at = to
    return Absence(max(at, state.next), open_, [max(a, at) for a, _ in runs], [b for _, b in runs]), rows


def absence_stream(readings: DataFrame, lateness: str = LATENESS, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """(keys, kind, first_ts, last_ts, hours): missing hours and outages, found in the stream of readings.

    An hour is missing once the watermark has passed it without a reading; a timer sees to that
    also where a series falls silent. An outage is a row of kind ``outage`` when it closes.
    Each series keeps one record: where it is final up to, the open outage, and runs of the
    hours that are not final. Rows with a null key or time only move the watermark. Append mode.
    """
    keys = list(keys)
    kinds = {f.name: f.dataType.simpleString() for f in readings.schema}
    rows = readings.select(*keys, ts, hour_number(ts).alias("_h")).withWatermark(ts, lateness)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = Absence(*state.get) if state.exists else None
        for b in batches:
            if all(k is not None and k == k for k in key):
                kept = with_hours(kept, b["_h"].dropna().astype("int64").unique().tolist())
        if kept is None:
            return
        watermark = state.getCurrentWatermarkMs()
        kept, found = finalised(kept, watermark // 3_600_000)
        state.update((kept.next, kept.open, list(kept.starts), list(kept.ends)))
        # The end of the first hour that is not final; later than the watermark by construction.
        state.setTimeoutTimestamp((kept.next + 1) * 3_600_000 if watermark < (kept.next + 1) * 3_600_000 else watermark + 1)
        if found:
            out = pd.DataFrame(found, columns=["kind", "h0", "h1"])
            for name, value in zip(keys, key):
                out.insert(0, name, value)
            yield out[[*keys, "kind", "h0", "h1"]]

    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "kind string, h0 long, h1 long"])
    found = rows.groupBy(*keys).applyInPandasWithState(
        step, schema, "next long, open long, starts array<long>, ends array<long>", "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select(*keys, "kind", hour_start("h0").alias("first_ts"), hour_start("h1").alias("last_ts"), (F.col("h1") - F.col("h0") + 1).alias("hours"))


def scored_stream(predictions: DataFrame, actuals: DataFrame, lateness: str = LATENESS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Stream-stream join of predictions and actuals on the target hour."""
    made = predictions.withWatermark("target_time", lateness).alias("p")
    known = actuals.withWatermark("actual_ts", lateness).alias("a")
    on = F.col("p.target_time") == F.col("a.actual_ts")
    for k in keys:
        on = on & (F.col(f"p.{k}") == F.col(f"a.{k}"))
    return made.join(known, on).select("p.*", F.col("a.load_mw").alias("actual_mw"))


def run_available(stream: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process what is there, append to a parquet table in the shared folder, read it back.

    With ``path`` and ``checkpoint`` a later call goes on where this one ended."""
    spark = stream.sparkSession
    out = path or shared_dir(spark, f"{name}-out")
    query = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint or shared_dir(spark, f"{name}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def upsert_each_batch(
    stream: DataFrame, name: str, handle: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None
) -> None:
    """Run ``handle`` on every micro-batch of what is available."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(handle)
        .option("checkpointLocation", checkpoint or shared_dir(stream.sparkSession, f"{name}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_upserted(stream: DataFrame, name: str, key: Sequence[str], path: str | None = None, at: str = TS, checkpoint: str | None = None) -> DataFrame:
    """Process what is there in update mode into a table with the current row of each key.

    Each micro-batch replaces its keys in the day folders of ``at`` (one of the key's columns)
    that it touches, and reads no other: the table holds every key once and needs no ranking.
    A replayed batch writes the same rows again. With ``path`` and ``checkpoint`` a later call
    goes on where this one ended.
    """
    spark, key = stream.sparkSession, list(key)
    out = path or shared_dir(spark, f"{name}-table")
    schema = T.StructType([*stream.schema, T.StructField("period", T.StringType())])

    def merge(batch: DataFrame, n: int) -> None:
        fresh = through_table(batch.withColumn("period", F.date_format(at, tables.GRAINS["day"])), f"{name}-batch")
        periods = [r["period"] for r in fresh.select("period").distinct().collect()]  # a calendar
        if not periods:
            return
        session = batch.sparkSession
        if path_exists(session, out):
            old = session.read.schema(schema).parquet(out).filter(F.col("period").isin(*periods))
            fresh = through_table(old.join(fresh.select(*key), key, "left_anti").unionByName(fresh), f"{name}-merged")
        (
            fresh.repartition("period", *key).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(out)
        )

    upsert_each_batch(stream, name, merge, "update", checkpoint)
    if not path_exists(spark, out):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(schema).parquet(out).drop("period")


def rescore_stream(
    actuals: DataFrame, predictions: DataFrame | str, scores_path: str, name: str = "rescore", arrival: str | None = None,
    grain: str = "day",
) -> DataFrame:
    """Upsert the scores of the hours each micro-batch of actuals touches.

    Only the folders of those hours are read and replaced. A replayed batch yields the
    same scores, so repeating it changes nothing; a batch with two revisions of an hour
    takes the later arrival.
    """
    upsert_each_batch(
        actuals, name, lambda batch, _: pred.rescore(batch.sparkSession, predictions, scores_path, batch, arrival=arrival, grain=grain)
    )
    return tables.read_scores(actuals.sparkSession, scores_path)
