"""Scans, sources, sinks, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom.functions import clock, names, scalars
from loadloom.operators import asof
from loadloom.plans import features as feats
from loadloom.session import shared_dir
from loadloom.sources import canonical, payload, tables

from . import frames as fr
from .base_sql import CANON, FEATURES, lead, midnight
from .registry import query

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@query("s1_read_table", "SELECT event_id, ts, event_type, value FROM events", "value")
def _(spark, sf):
    return canonical.read_table(spark, f"{sf}/events.parquet", EVENTS_SCHEMA)


@query("s2_write_canonical", "SELECT series_id, ts, load_mw, temp_c, is_holiday, data_source_version FROM canon", "load_mw temp_c")
def _(spark, sf):
    path = canonical.write_table(fr.canonical(spark, sf), shared_dir(spark, "canonical"))
    return canonical.read_periods(spark, path).select("series_id", "ts", "load_mw", "temp_c", "is_holiday", "data_source_version")


VARIABLES = tuple(payload.HOUSE_COLUMNS)


def _payload_files(spark, sf):
    """One JSON payload per series and day; each seventh day carries a zone offset."""
    day = F.to_date("ts")
    hours = fr.weather(spark, sf).withColumn("hour_text", F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    house = [payload.HOUSE_COLUMNS[v] for v in VARIABLES]
    packed = (
        hours.groupBy("series_id", day.alias("day"))
        .agg(F.array_sort(F.collect_list(F.struct("hour_text", *house))).alias("r"))
        .select(
            "series_id",
            F.when(F.dayofyear("day") % 7 == 0, 3600).otherwise(0).alias("utc_offset_seconds"),
            F.struct(
                F.col("r.hour_text").alias("time"),
                *[F.col(f"r.{c}").alias(v) for v, c in zip(VARIABLES, house)],
            ).alias("hourly"),
        )
    )
    path = shared_dir(spark, "payloads")
    packed.write.option("ignoreNullFields", False).json(path)
    extra = T.StructType([T.StructField("series_id", T.StringType())])
    return payload.read_payloads(spark, path, VARIABLES, extra)


@query(
    "s3_parse_hourly_payload",
    "SELECT series_id, ts, temp_c, wind_ms, cloud_cover, humidity_pct FROM weather WHERE dayofyear(ts) % 7 <> 0",
    "temp_c wind_ms cloud_cover humidity_pct",
)
def _(spark, sf):
    return payload.parse_hourly(_payload_files(spark, sf), VARIABLES, ["series_id"], strict=False)


@query(
    "s3_rejected_payloads",
    "SELECT series_id, 'expected UTC, got offset 3600s' AS problem, count(DISTINCT CAST(ts AS DATE)) AS n "
    "FROM weather WHERE dayofyear(ts) % 7 = 0 GROUP BY series_id",
)
def _(spark, sf):
    bad = payload.rejected_payloads(_payload_files(spark, sf), VARIABLES)
    return bad.groupBy("series_id", "problem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s4_vintage_columns",
    "SELECT series_id, ts, station, 1::BIGINT AS lead_days, temp_c - 1 AS temp_c, wind_ms AS wind_ms FROM stations "
    "UNION ALL SELECT series_id, ts, station, 2, temp_c - 2, wind_ms * 2 FROM stations",
    "temp_c wind_ms",
)
def _(spark, sf):
    wide = fr.stations(spark, sf).select(
        "series_id", "ts", "station",
        *[(F.col("temp_c") - n).alias(f"temperature_2m{payload.vintage_suffix(n)}") for n in (1, 2)],
        *[(F.col("wind_ms") * n).alias(f"wind_speed_10m{payload.vintage_suffix(n)}") for n in (1, 2)],
    )
    return payload.vintages_long(wide, ["series_id", "ts", "station"], ["temperature_2m", "wind_speed_10m"], [1, 2])


@query("s5_value_column", "SELECT series_id, ts, value AS load_mw FROM slots", "load_mw")
def _(spark, sf):
    from loadloom.operators.resample import latest_revision

    return canonical.value_column(latest_revision(fr.readings(spark, sf)), "Actual Load", "load_mw")


@query("s6_missing_source_is_empty", f"SELECT series_id, ts, {', '.join(CANON.split())} FROM canon", CANON)
def _(spark, sf):
    absent = canonical.read_if_present(spark, shared_dir(spark, "nothing-here"))
    return fr.canonical(spark, sf).unionByName(absent).select("series_id", "ts", *CANON.split())


@query("s7_append_predictions", "SELECT series_id, model_version, 2 * count(*) AS n, count(*) * 2 AS ids, avg(load_mw) AS mean_mw FROM preds GROUP BY ALL", "mean_mw")
def _(spark, sf):
    """Two identical calls are both kept, with ids of their own."""
    path = shared_dir(spark, "predictions")
    made = fr.predictions(spark, sf).select("id", "series_id", "load_mw", "model_version", "predicted_at")
    made = made.withColumns(
        {"target_time": F.trunc("predicted_at", "year").cast("timestamp"), "horizon_hours": F.col("id").cast("int")}
    ).drop("id")
    for batch in ("first", "second"):
        tables.append_predictions(made, path, batch)
    log = tables.read_predictions(spark, path)
    return log.groupBy("series_id", "model_version").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.avg("load_mw").alias("mean_mw")
    )


SINCE, UNTIL = "1997-03-01 06:00:00", "1999-05-02 12:00:00"


@query(
    "s8_read_predictions",
    f"SELECT id, series_id, predicted_at, target_time, load_mw FROM preds WHERE target_time >= TIMESTAMP '{SINCE}' "
    f"AND target_time <= TIMESTAMP '{UNTIL}' AND model_version = 'F'",
    "load_mw",
)
def _(spark, sf):
    kept = tables.filter_predictions(fr.predictions(spark, sf), SINCE, UNTIL, "F")
    return tables.in_log_order(kept.select("id", "series_id", "predicted_at", "target_time", "load_mw"))


@query(
    "s9_drift_history",
    "SELECT date_trunc('day', ts) AS checked_at, CASE WHEN avg(value) > 50 THEN 'drift' ELSE 'ok' END AS status, "
    "count(*) AS current_rows, avg(value) AS rolling_mape FROM events GROUP BY 1",
    "rolling_mape",
)
def _(spark, sf):
    path = shared_dir(spark, "drift-history")
    daily = fr.events(spark, sf).groupBy(F.date_trunc("day", "ts").alias("checked_at")).agg(
        F.when(F.avg("value") > 50, "drift").otherwise("ok").alias("status"),
        F.count(F.lit(1)).alias("current_rows"), F.avg("value").alias("rolling_mape"),
    )
    tables.append_drift_history(daily, path)
    return tables.read_drift_history(spark, path).select("checked_at", "status", "current_rows", "rolling_mape")


@query("s10_export_csv", "SELECT segment_kind, segment, model, n, mape FROM segs", "mape")
def _(spark, sf):
    from loadloom.operators.scores import by_segment

    path = tables.export_csv(
        by_segment(fr.backtest_long(spark, sf)).select("segment_kind", "segment", "model", "n", "mape"),
        shared_dir(spark, "segments-csv"),
    )
    schema = "segment_kind string, segment string, model string, n long, mape double"
    return spark.read.schema(schema).option("header", True).csv(path)


@query("s11_load_evidence", "SELECT series_id, ts, actual, trees_weather FROM bt WHERE trees_weather IS NOT NULL", "actual trees_weather")
def _(spark, sf):
    """The preferred audit export does not exist, so the backtest export is used."""
    path = shared_dir(spark, "backtest-csv")
    wide = fr.backtest_wide(spark, sf).select("series_id", "ts", "actual", "trees_weather")
    tables.export_csv(wide.dropna("any"), path)
    schema = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("ts", T.TimestampType())])
    frame, column, _ = tables.load_evidence(
        spark,
        [(shared_dir(spark, "no-audit"), "gate_closure", "audit"), (path, "trees_weather", "backtest")],
        schema,
    )
    return frame.select("series_id", "ts", "actual", column)


@query("s12_typed_empty_history", "SELECT date_trunc('day', ts) AS checked_at, count(*) AS current_rows FROM events GROUP BY 1")
def _(spark, sf):
    absent = tables.read_drift_history(spark, shared_dir(spark, "no-history")).select("checked_at", "current_rows")
    daily = fr.events(spark, sf).groupBy(F.date_trunc("day", "ts").alias("checked_at"))
    return absent.unionByName(daily.agg(F.count(F.lit(1)).alias("current_rows")))


SWAP_SQL = """, archived AS (SELECT series_id, ts, CASE WHEN hour(ts) <> 5 THEN temp_c + 1 END AS temp_c FROM weather
  WHERE day(ts) BETWEEN 4 AND 25),
covered AS (SELECT a.series_id, min(a.ts) AS lo, max(a.ts) AS hi FROM archived a JOIN canon c USING (series_id, ts)
  WHERE a.temp_c IS NOT NULL GROUP BY a.series_id)
SELECT c.series_id, c.ts, c.load_mw, a.temp_c, c.wind_ms FROM canon c JOIN covered v ON v.series_id = c.series_id
  AND c.ts BETWEEN v.lo AND v.hi LEFT JOIN archived a ON a.series_id = c.series_id AND a.ts = c.ts"""


@query("s13_p10_swap_archived_weather", SWAP_SQL, "load_mw temp_c wind_ms")
def _(spark, sf):
    archived = fr.weather(spark, sf).filter(F.dayofmonth("ts").between(4, 25)).select(
        "series_id", "ts", F.when(F.hour("ts") != 5, F.col("temp_c") + 1).alias("temp_c")
    )
    path = shared_dir(spark, "archived-weather")
    archived.write.parquet(path)
    stored = canonical.read_table(spark, path, None)
    swapped = feats.swap_weather(fr.canonical(spark, sf), stored, ["temp_c"])
    return swapped.select("series_id", "ts", "load_mw", "temp_c", "wind_ms")


#: Hours before the target at which a vintage was issued; the last one came after every publication time.
ISSUED = (5, 16, 23, 30, 41, 54)
VINTAGES = f""", vintages AS (SELECT series_id, ts, temp_c + k AS temp_c, wind_ms, ts - to_hours(k) AS issued_at FROM weather, (SELECT unnest({list(ISSUED)!r}) AS k) WHERE (hour(ts) + k) % 7 <> 0),
pub AS (SELECT series_id, ts, {midnight('ts')} - to_hours(14) AS known FROM (SELECT DISTINCT series_id, ts FROM vintages))
"""


def vintages(spark, sf):
    """Several forecasts of every hour, some missing."""
    w = fr.weather(spark, sf).withColumn("k", F.explode(F.array(*[F.lit(k) for k in ISSUED]))).filter((F.hour("ts") + F.col("k")) % 7 != 0)
    return w.select("series_id", "ts", (F.col("temp_c") + F.col("k")).alias("temp_c"), "wind_ms", clock.plus_hours("ts", -F.col("k")).alias("issued_at"))


@query("s4_as_known_at", VINTAGES + """SELECT p.series_id, p.ts, v.temp_c, v.wind_ms, v.issued_at FROM pub p ASOF JOIN vintages v
  ON v.series_id = p.series_id AND v.ts = p.ts AND p.known >= v.issued_at""", "temp_c wind_ms")
def _(spark, sf):
    """For each hour the newest weather forecast that was out at its publication time."""
    return asof.as_known_at(vintages(spark, sf), ["temp_c", "wind_ms"])


@query("s4_last_reading_at_forecast_time", """, made AS (SELECT id, series_id, predicted_at FROM preds), known AS (SELECT series_id, ts, load_mw FROM hist WHERE load_mw IS NOT NULL)
SELECT m.id, m.series_id, m.predicted_at, k.load_mw AS known_mw, k.ts AS matched_at FROM made m ASOF LEFT JOIN known k ON k.series_id = m.series_id AND m.predicted_at >= k.ts""", "known_mw")
def _(spark, sf):
    """The last actual that each forecast could have known, whatever its own hour."""
    made = fr.predictions(spark, sf).select("id", "series_id", "predicted_at")
    known = fr.history(spark, sf).filter("load_mw IS NOT NULL").select("series_id", "ts", F.col("load_mw").alias("known_mw"))
    return asof.asof_join(made, known, ["known_mw"], "predicted_at")


@query(
    "s14_date_chunks",
    """, ranges AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY 1),
    parts AS (SELECT o_custkey, s, e, unnest(range(0, datediff('day', s, e) // 365 + 1)) AS k FROM ranges)
    SELECT o_custkey, CAST(s + CAST(k * 365 AS INT) AS TIMESTAMP) AS chunk_start,
      CAST(least(s + CAST(k * 365 + 364 AS INT), e) AS TIMESTAMP) AS chunk_end FROM parts""",
)
def _(spark, sf):
    ranges = fr.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("start_date"), F.to_date(F.max("o_orderdate")).alias("end_date")
    )
    return payload.date_chunks(ranges)


# --- projections, filters, predicates ---------------------------------------------------


@query("p1_canonical_projection", "SELECT series_id, ts, load_mw, CAST(NULL AS DOUBLE) AS tso_forecast_mw, CAST(NULL AS DOUBLE) AS humidity_pct, 'run-test' AS data_source_version FROM hourly", "load_mw tso_forecast_mw humidity_pct")
def _(spark, sf):
    return canonical.project(fr.hourly(spark, sf), fr.RUN).select(
        "series_id", "ts", "load_mw", "tso_forecast_mw", "humidity_pct", "data_source_version"
    )


@query("p2_required_columns", "SELECT series_id, ts, load_mw, temp_c, wind_ms, cloud_cover FROM canon", "load_mw temp_c wind_ms cloud_cover")
def _(spark, sf):
    from loadloom.session import require_columns

    checked = require_columns(fr.canonical(spark, sf), feats.REQUIRED, "feature input")
    return checked.select("series_id", "ts", *feats.REQUIRED)


@query("p3_drop_incomplete_rows", f"SELECT series_id, ts, {', '.join(CANON.split())} FROM canon WHERE load_mw IS NOT NULL AND tso_forecast_mw IS NOT NULL AND temp_c IS NOT NULL AND wind_ms IS NOT NULL AND cloud_cover IS NOT NULL AND humidity_pct IS NOT NULL", CANON)
def _(spark, sf):
    return fr.canonical(spark, sf).select("series_id", "ts", *CANON.split()).dropna("any")


LOADED = "load_lag_24 load_lag_25 load_lag_48 load_lag_168 load_lag_192 load_roll_mean_24 load_roll_std_24"
CALENDAR_ONLY = "hour dow month is_weekend is_holiday hour_sin hour_cos dow_sin dow_cos"


@query("p4_feature_family", f"SELECT series_id, ts, {', '.join((CALENDAR_ONLY + ' ' + LOADED).split())} FROM feats", CALENDAR_ONLY + " " + LOADED)
def _(spark, sf):
    f = feats.make_features(fr.canonical(spark, sf), 24)
    kept = names.feature_columns(f.drop("series_id", "ts").columns, include_weather=False)
    return f.select("series_id", "ts", *kept)


@query("p5_load_derived_columns", f"SELECT series_id, ts, {', '.join(LOADED.split())}, target FROM feats", LOADED + " target")
def _(spark, sf):
    f = feats.make_features(fr.canonical(spark, sf), 24)
    return f.select("series_id", "ts", *names.target_derived_columns(f.columns))


@query("p6_monitored_columns", f"SELECT series_id, ts, {', '.join(LOADED.split())}, temp_c, temp_sq, wind_ms, cloud_cover FROM feats", LOADED + " temp_c temp_sq wind_ms cloud_cover")
def _(spark, sf):
    f = feats.make_features(fr.canonical(spark, sf), 24)
    return f.select("series_id", "ts", *names.monitored_columns(f.columns))


@query("p7_closed_time_range", f"SELECT series_id, ts, load_mw FROM hist WHERE ts BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}'", "load_mw")
def _(spark, sf):
    return fr.history(spark, sf).filter(F.col("ts").between(SINCE, UNTIL)).select("series_id", "ts", "load_mw")


@query("p8_recent_actuals", "SELECT h.series_id, h.ts, h.load_mw, h.tso_forecast_mw FROM hist h JOIN (SELECT series_id, max(ts) AS m FROM hist WHERE load_mw IS NOT NULL GROUP BY 1) l ON l.series_id = h.series_id AND h.ts BETWEEN m - INTERVAL 14 DAY AND m", "load_mw tso_forecast_mw")
def _(spark, sf):
    return feats.recent_actuals(fr.history(spark, sf), 14)


@query("p9_rows_at_own_lead", f"SELECT series_id, ts, load_mw, {lead('ts')} AS lead_h FROM hist WHERE {lead('ts')} = 24", "load_mw")
def _(spark, sf):
    tagged = fr.history(spark, sf).select("series_id", "ts", "load_mw", clock.lead_hours("ts").alias("lead_h"))
    return tagged.filter(F.col("lead_h") == F.lit(24))


@query("p11_constant_version", "SELECT series_id, data_source_version, count(*) AS n FROM canon GROUP BY ALL")
def _(spark, sf):
    return fr.canonical(spark, sf).groupBy("series_id", "data_source_version").agg(F.count(F.lit(1)).alias("n"))


@query("p12_optional_rounding", "SELECT id, round(sqrt(load_mw), 1) AS p50, CASE WHEN id % 3 = 0 THEN NULL ELSE round(sqrt(load_mw + 3), 1) END AS p10 FROM preds", "p50 p10")
def _(spark, sf):
    return fr.predictions(spark, sf).select(
        "id", scalars.optional(F.sqrt("load_mw")).alias("p50"),
        scalars.optional(F.when(F.col("id") % 3 != 0, F.sqrt(F.col("load_mw") + 3))).alias("p10"),
    )


@query("p13_ordered_model_input", f"SELECT {', '.join(FEATURES.split())}, series_id, ts FROM feats", FEATURES)
def _(spark, sf):
    from loadloom.session import require_columns

    wanted = FEATURES.split()
    f = feats.make_features(fr.canonical(spark, sf), 24)
    return require_columns(f, wanted).select(*wanted, "series_id", "ts")


