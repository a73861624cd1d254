"""Shared WITH clause of the oracle SQL: the input frames, written for DuckDB."""

ZONE = "Europe/Warsaw"


def local(ts: str) -> str:
    return f"(({ts} AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}')"


def to_utc(wall: str) -> str:
    return f"(({wall} AT TIME ZONE '{ZONE}') AT TIME ZONE 'UTC')"


def midnight(ts: str) -> str:
    return to_utc(f"date_trunc('day', {local(ts)})")


def lead(ts: str, publication: int = 10) -> str:
    return f"CAST((epoch({ts}) - epoch({midnight(ts)})) / 3600 AS BIGINT) + {24 - publication}"


def hour_no(ts: str) -> str:
    return f"CAST(floor(epoch({ts}) / 3600) AS BIGINT)"


def lag(n: int, value: str = "load_mw") -> str:
    return (
        f"max({value}) OVER (PARTITION BY series_id ORDER BY ts RANGE BETWEEN "
        f"INTERVAL {n} HOUR PRECEDING AND INTERVAL {n} HOUR PRECEDING)"
    )


def rolling(fn: str, h: int = 24, w: int = 24, value: str = "load_mw") -> str:
    frame = (
        f"OVER (PARTITION BY series_id ORDER BY ts RANGE BETWEEN INTERVAL {h + w - 1} HOUR PRECEDING "
        f"AND INTERVAL {h} HOUR PRECEDING)"
    )
    return f"CASE WHEN count({value}) {frame} = {w} THEN {fn}({value}) {frame} END"


def calendar(ts: str = "ts") -> str:
    t = local(ts)
    dow = f"(isodow({t}) - 1)"
    return f"""CAST(hour({t}) AS DOUBLE) AS hour, CAST({dow} AS DOUBLE) AS dow, CAST(month({t}) AS DOUBLE) AS month,
      CAST({dow} >= 5 AS DOUBLE) AS is_weekend,
      sin(2 * pi() * hour({t}) / 24) AS hour_sin, cos(2 * pi() * hour({t}) / 24) AS hour_cos,
      sin(2 * pi() * {dow} / 7) AS dow_sin, cos(2 * pi() * {dow} / 7) AS dow_cos"""


CALENDAR_NAMES = "hour dow month is_weekend is_holiday hour_sin hour_cos dow_sin dow_cos"
FEATURES = (
    CALENDAR_NAMES + " load_lag_24 load_lag_25 load_lag_48 load_lag_168 load_lag_192 "
    "load_roll_mean_24 load_roll_std_24 temp_c temp_sq wind_ms cloud_cover"
)
CANON = "load_mw tso_forecast_mw temp_c wind_ms cloud_cover humidity_pct"


def segments(ts: str = "ts", is_holiday: str = "hol_d IS NOT NULL") -> str:
    t = local(ts)
    return f"""CASE WHEN hour({t}) >= 7 AND hour({t}) < 22 THEN 'peak' ELSE 'off-peak' END AS period,
      CASE WHEN isodow({t}) >= 6 THEN 'weekend' ELSE 'weekday' END AS daytype,
      CASE WHEN {is_holiday} THEN 'holiday' ELSE 'ordinary day' END AS holiday,
      CASE WHEN month({t}) IN (12, 1, 2) THEN 'winter' WHEN month({t}) IN (3, 4, 5) THEN 'spring'
           WHEN month({t}) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
      CASE WHEN (month({t}) = 12 AND day({t}) >= 24) OR (month({t}) = 1 AND day({t}) = 1)
           THEN 'christmas–new year' ELSE 'rest of year' END AS special"""


def metrics(t: str = "y_true", p: str = "y_pred") -> str:
    return f"""avg(abs(({t} - {p}) / nullif({t}, 0))) * 100 AS mape, sqrt(avg(({t} - {p}) * ({t} - {p}))) AS rmse_mw,
      avg(abs({t} - {p})) AS mae_mw, avg({p} - {t}) AS bias_mw"""


def feature_cte(source: str, include_target: bool = True) -> str:
    """Feature rows (H = 24) over a canonical relation."""
    names = FEATURES.split() + (["target"] if include_target else [])
    whole = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return f"""SELECT series_id, ts, {', '.join(names)} FROM (
      SELECT c.series_id, c.ts, {calendar('c.ts')}, CAST(h.d IS NOT NULL AS DOUBLE) AS is_holiday,
        load_lag_24, load_lag_25, load_lag_48, load_lag_168, load_lag_192, load_roll_mean_24, load_roll_std_24,
        temp_c, temp_c * temp_c AS temp_sq, wind_ms, cloud_cover, load_mw AS target
      FROM (SELECT *, {lag(24)} AS load_lag_24, {lag(25)} AS load_lag_25, {lag(48)} AS load_lag_48,
              {lag(168)} AS load_lag_168, {lag(192)} AS load_lag_192,
              {rolling('avg')} AS load_roll_mean_24, {rolling('stddev_samp')} AS load_roll_std_24
            FROM {source}) c
      LEFT JOIN hol h ON h.d = CAST({local('c.ts')} AS DATE)) WHERE {whole}"""


BASE = f"""WITH
hol_years AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM range(1990, 2031) t(y)),
hol_epact AS (SELECT y, a, b, c, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM hol_years),
hol_week AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM hol_epact),
hol_code AS (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS code FROM hol_week),
hol_easter AS (SELECT y, make_date(CAST(y AS INT), CAST(code // 31 AS INT), CAST(code % 31 + 1 AS INT)) AS e FROM hol_code),
hol AS (
  SELECT e + CAST(n AS INT) AS d FROM hol_easter, (VALUES (0), (1), (49), (60)) o(n)
  UNION SELECT make_date(CAST(y AS INT), m, dd) FROM hol_years,
    (VALUES (1, 1, 0), (1, 6, 2011), (5, 1, 0), (5, 3, 1990), (8, 15, 1990), (11, 1, 0),
            (11, 11, 1990), (12, 24, 2025), (12, 25, 0), (12, 26, 0)) f(m, dd, since) WHERE y >= since),
readings AS (
  SELECT event_type AS series_id, make_timestamp((epoch_us(ts) // 900000000) * 900000000) AS ts,
    sqrt(value) * 10 AS value, event_id AS ingest_seq FROM events),
slots AS (SELECT series_id, ts, arg_max(value, ingest_seq) AS value FROM readings GROUP BY ALL),
hourly AS (SELECT series_id, date_trunc('hour', ts) AS ts, avg(value) AS load_mw FROM slots GROUP BY ALL),
spine AS (SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM hourly GROUP BY series_id),
hourly_full AS (SELECT s.series_id, s.ts, h.load_mw FROM spine s LEFT JOIN hourly h ON h.series_id = s.series_id AND h.ts = s.ts),
reference AS (
  SELECT event_type AS series_id, date_trunc('hour', ts) AS ts,
    CASE WHEN count(*) > 1 THEN avg(sqrt(value) * 10) END AS tso_forecast_mw FROM events GROUP BY ALL),
load_frame AS (
  SELECT coalesce(l.series_id, r.series_id) AS series_id, coalesce(l.ts, r.ts) AS ts, load_mw, tso_forecast_mw
  FROM hourly l FULL JOIN reference r ON l.series_id = r.series_id AND l.ts = r.ts),
stations AS (
  SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, 'st' || (user_id % 5) AS station,
    avg(value) / 10 - 5 AS temp_c,
    CASE WHEN min(event_id) % 7 <> 0 THEN avg(user_id % 20) END AS wind_ms,
    avg(CAST(json_extract(props, '$.k') AS DOUBLE)) AS cloud_cover,
    avg(event_id % 101) AS humidity_pct
  FROM events GROUP BY ALL),
weights AS (SELECT 'st' || (user_id % 5) AS station, sqrt(count(*)) / sum(sqrt(count(*))) OVER () AS weight FROM events GROUP BY ALL),
weather AS (
  SELECT series_id, ts,
    sum(temp_c * weight) / sum(CASE WHEN temp_c IS NOT NULL THEN weight END) AS temp_c,
    sum(wind_ms * weight) / sum(CASE WHEN wind_ms IS NOT NULL THEN weight END) AS wind_ms,
    sum(cloud_cover * weight) / sum(CASE WHEN cloud_cover IS NOT NULL THEN weight END) AS cloud_cover,
    sum(humidity_pct * weight) / sum(CASE WHEN humidity_pct IS NOT NULL THEN weight END) AS humidity_pct
  FROM stations JOIN weights USING (station) GROUP BY ALL),
axis AS (
  SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
  FROM (SELECT series_id, ts FROM load_frame UNION ALL SELECT series_id, ts FROM weather) GROUP BY series_id),
canon AS (
  SELECT a.series_id, a.ts, load_mw, tso_forecast_mw, temp_c, wind_ms, cloud_cover, humidity_pct,
    h.d IS NOT NULL AS is_holiday, 'run-test' AS data_source_version
  FROM axis a LEFT JOIN load_frame l ON l.series_id = a.series_id AND l.ts = a.ts
  LEFT JOIN weather w ON w.series_id = a.series_id AND w.ts = a.ts
  LEFT JOIN hol h ON h.d = CAST({local('a.ts')} AS DATE)),
hist AS (
  SELECT 's' || (l_suppkey % 5) AS series_id, l_shipdate + to_hours(l_orderkey % 24) AS ts,
    CASE WHEN max(l_quantity) < 50 THEN avg(sqrt(l_extendedprice) * 100) END AS load_mw,
    CASE WHEN min(l_linenumber) <> 3 THEN avg(sqrt(l_extendedprice * (1 - l_discount)) * 100) END AS tso_forecast_mw,
    avg(l_quantity) - 15 AS temp_c, avg(l_tax * 100) AS wind_ms, avg(l_discount * 1000) AS cloud_cover,
    CAST(avg(l_suppkey % 110) AS DOUBLE) AS humidity_pct
  FROM lineitem GROUP BY ALL),
preds AS (
  SELECT o_orderkey AS id, 's' || (o_custkey % 5) AS series_id,
    o_orderdate + to_hours(o_orderkey % 24 - 24 - o_custkey % 5) AS predicted_at,
    o_orderdate + to_hours(o_orderkey % 24) AS target_time, 24 AS horizon_hours, o_totalprice / 10 AS load_mw,
    o_orderstatus AS model_version FROM orders),
scores AS (
  SELECT id AS prediction_id, h.load_mw AS actual_mw, abs(p.load_mw - h.load_mw) AS abs_error_mw,
    abs(p.load_mw - h.load_mw) / h.load_mw AS ape, h.tso_forecast_mw,
    abs(h.tso_forecast_mw - h.load_mw) AS tso_abs_error_mw
  FROM preds p JOIN hist h ON h.series_id = p.series_id AND h.ts = p.target_time
  WHERE h.load_mw IS NOT NULL AND h.load_mw <> 0),
scored AS (
  SELECT p.*, s.actual_mw, s.abs_error_mw, s.ape, s.tso_forecast_mw AS tso_mw, s.tso_abs_error_mw
  FROM preds p JOIN scores s ON s.prediction_id = p.id),
standing AS (
  SELECT * FROM scored QUALIFY row_number() OVER (
    PARTITION BY series_id, target_time, horizon_hours, model_version ORDER BY predicted_at DESC, id DESC) = 1),
bt AS (
  SELECT series_id, ts, load_mw AS actual, tso_forecast_mw + temp_c AS trees_weather,
    tso_forecast_mw AS day_ahead_reference, temp_c * 800 AS naive_seasonal FROM hist WHERE load_mw IS NOT NULL),
btl AS (
  SELECT series_id, ts, actual AS y_true, 'trees_weather' AS model, trees_weather AS y_pred FROM bt
  UNION ALL SELECT series_id, ts, actual, 'day_ahead_reference', day_ahead_reference FROM bt
  UNION ALL SELECT series_id, ts, actual, 'naive_seasonal', naive_seasonal FROM bt),
btseg AS (
  SELECT b.*, {segments('b.ts', 'h.d IS NOT NULL')} FROM btl b
  LEFT JOIN hol h ON h.d = CAST({local('b.ts')} AS DATE)),
segs AS (
  SELECT kind AS segment_kind, segment, model, count(*) AS n, count(y_true - y_pred) AS n_scored, {metrics()} FROM (
    SELECT model, y_true, y_pred, 'period' AS kind, period AS segment FROM btseg
    UNION ALL SELECT model, y_true, y_pred, 'daytype', daytype FROM btseg
    UNION ALL SELECT model, y_true, y_pred, 'holiday', holiday FROM btseg
    UNION ALL SELECT model, y_true, y_pred, 'season', season FROM btseg
    UNION ALL SELECT model, y_true, y_pred, 'special', special FROM btseg) GROUP BY ALL),
pevents AS (
  SELECT 'u' || (user_id % 40) AS series_id,
    CASE event_type WHEN 'error' THEN 'retrain' WHEN 'purchase' THEN 'retrain' WHEN 'view' THEN 'ingest'
      WHEN 'signup' THEN 'retrain_if_needed' ELSE 'evaluate' END AS pipeline,
    CASE event_type WHEN 'error' THEN 'raise' WHEN 'purchase' THEN 'clear' ELSE 'success' END AS event,
    ts AS "at", 'reason ' || event_id AS reason FROM events),
runs AS (
  SELECT 'r' || o_orderkey AS run_id, 'm' || o_custkey AS model_name, o_orderdate AS started_at,
    CASE WHEN o_orderstatus = 'F' THEN 'synthetic' ELSE 'ingested' END AS data_source,
    sqrt(o_totalprice) / 100 AS mape, CAST(o_custkey % 7 AS DOUBLE) AS naive, CAST(o_orderkey AS VARCHAR) AS version
  FROM orders),
aliases AS (
  SELECT 'm' || o_custkey AS model_name, 'champion' AS alias, CAST(o_orderkey AS VARCHAR) AS version,
    'r' || o_orderkey AS run_id, o_orderdate + to_hours(o_orderkey % 24) AS "at"
  FROM orders WHERE o_orderpriority = '1-URGENT'),
champions AS (
  SELECT * FROM aliases QUALIFY row_number() OVER (PARTITION BY model_name, alias ORDER BY "at" DESC, CAST(version AS BIGINT) DESC) = 1),
feats AS ({feature_cte('canon')})
"""
