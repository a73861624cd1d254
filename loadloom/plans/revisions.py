"""Revision history: every value with the interval in which it was the known one.

Each ingest compares its hours with the open intervals of the folders they lie in, closes those
that changed and opens new ones. What comes back is the set of changed hours: scores, features
and checks that depend on them can be redone for these alone, and anything that was computed
earlier can be computed again from what was known then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import KEYS, TS
from ..session import through_table
from ..sources.canonical import path_exists
from ..sources.tables import GRAINS
from . import predictions as pred

VALUES = ("load_mw", "tso_forecast_mw")
FROM, TO = "valid_from", "valid_to"


def read_history(spark: SparkSession, path: str, schema: T.StructType, only: Sequence[str] | None = None) -> DataFrame:
    """The stored intervals; ``only`` names the folders to read. No table yet: no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(T.StructType([*schema, T.StructField("period", T.StringType())])).parquet(path)
    return (df if only is None else df.filter(F.col("period").isin(*only))).drop("period")


def history_schema(df: DataFrame, values: Sequence[str] = VALUES, keys: Sequence[str] = KEYS, ts: str = TS) -> T.StructType:
    at = [T.StructField(c, T.TimestampType()) for c in (FROM, TO)]
    return T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in [*keys, ts, *values]], *at])


def as_of(history: DataFrame, at=None) -> DataFrame:
    """The values known at ``at``, an interval's end not included; without it, those known now."""
    if at is None:
        return history.filter(F.col(TO).isNull())
    t = F.lit(at).cast("timestamp")
    return history.filter((F.col(FROM) <= t) & (F.col(TO).isNull() | (F.col(TO) > t)))


def apply_revisions(
    spark: SparkSession, path: str, incoming: DataFrame, at, values: Sequence[str] = VALUES, arrival: str | None = None,
    keys: Sequence[str] = KEYS, ts: str = TS, grain: str = "month",
) -> DataFrame:
    """Take in a pull made at ``at``; the stored set of changed hours ``(keys, ts)``. Runs jobs.

    Only folders with a pulled hour are read and only those with a changed one are written. An
    hour is changed if it is new or any value differs, a null included. Of several rows of an
    hour the greatest ``arrival`` counts, else the greatest values. The same pull again changes
    nothing; an hour whose value was taken in later than ``at`` keeps it, and a second pull of
    the same time replaces the first.
    """
    keys, values, on = list(keys), list(values), [*keys, ts]
    order = F.struct(*([arrival] if arrival else []), *values)
    latest = incoming.groupBy(*on).agg(F.max_by(F.struct(*values), order).alias("_v")).select(*on, "_v.*")
    period = F.date_format(ts, GRAINS[grain])
    pulled = through_table(latest.withColumn("_period", period), "pulled")
    schema, now = history_schema(latest, values, keys, ts), F.lit(at).cast("timestamp")
    periods = [r["_period"] for r in pulled.select("_period").distinct().collect()]  # the calendar of one pull
    stored = read_history(spark, path, schema, periods)
    known = as_of(stored).select(*on, F.struct(*values).alias("_old"), F.col(FROM).alias("_since"))
    differs = F.lit(False)
    for v in values:
        differs = differs | ~F.col(v).eqNullSafe(F.col(f"_old.{v}"))
    compared = pulled.join(known, on, "left")
    changed = through_table(compared.filter(F.col("_since").isNull() | (differs & (F.col("_since") <= now))).drop("_old", "_since"), "changed")
    periods = [r["_period"] for r in changed.select("_period").distinct().collect()]
    if periods:
        marks = changed.select(*on, F.lit(True).alias("_hit"))
        kept = read_history(spark, path, schema, periods).join(marks, on, "left")
        ends = F.col("_hit").isNotNull() & F.col(TO).isNull()
        kept = kept.withColumn(TO, F.when(ends, now).otherwise(F.col(TO))).filter(F.col(FROM) < F.coalesce(TO, F.lit("9999-12-31").cast("timestamp")))
        opened = changed.select(*on, *values, now.alias(FROM), F.lit(None).cast("timestamp").alias(TO))
        rows = through_table(kept.select(*schema.names).unionByName(opened), "revised").withColumn("period", period)
        # Rows of a folder are spread by series and day: neither is one writer.
        (
            rows.repartition(F.col("period"), *[F.col(k) for k in keys], F.to_date(ts)).sortWithinPartitions("period", *on, FROM)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)
        )
    return changed.select(*on)


def rescore_changed(
    spark: SparkSession, predictions: DataFrame | str, scores_path: str, history: DataFrame, changed: DataFrame, scored_at=None,
    keys: Sequence[str] = KEYS, ts: str = TS, grain: str = "day",
) -> None:
    """Score the predictions of the changed hours again, from the values known now. Runs jobs.

    Reads the log's and the scores' folders of those days and no other.
    """
    known = as_of(history).join(changed, [*keys, ts], "left_semi")
    pred.rescore(spark, predictions, scores_path, through_table(known, "changed-actuals"), scored_at, grain=grain)


def score_as_known(predictions: DataFrame, history: DataFrame, at, keys: Sequence[str] = KEYS) -> DataFrame:
    """The scores as a run at ``at`` gave them."""
    return pred.score(predictions, as_of(history, at), at, keys=keys)
