"""The minimum slice end to end: readings to error per segment."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadloom.operators import scores
from loadloom.operators.history import seasonal_naive

from . import frames as fr
from .base_sql import lag, local, metrics, segments
from .registry import query

KINDS = ("period", "daytype", "holiday", "season", "special")
SPREAD = " UNION ALL ".join(
    f"SELECT series_id, y_true, y_pred, '{k}' AS segment_kind, {k} AS segment FROM labelled" for k in KINDS
)
SQL = f""", n AS (SELECT series_id, ts, load_mw AS y_true, {lag(168)} AS y_pred FROM hourly),
labelled AS (SELECT n.*, {segments('n.ts', 'h.d IS NOT NULL')} FROM n LEFT JOIN hol h ON h.d = CAST({local('n.ts')} AS DATE) WHERE y_pred IS NOT NULL)
SELECT segment_kind, segment, series_id, count(*) AS n, count(y_true - y_pred) AS n_scored, {metrics()} FROM ({SPREAD}) GROUP BY ALL"""


@query("flagship_naive_error_by_segment", SQL, "mape rmse_mw mae_mw bias_mw")
def _(spark, sf):
    """Readings, hourly table, week-old forecast, local segments, four metrics."""
    naive = seasonal_naive(fr.hourly(spark, sf)).select(
        "series_id", "ts", F.col("load_mw").alias("y_true"), F.col("naive_seasonal").alias("y_pred")
    )
    return scores.by_segment(naive.filter("y_pred IS NOT NULL"), by=["series_id"])
