"""Hourly weather payloads: parallel arrays inside one JSON object per request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import require_positive

# Provider variable -> house column, and the vintage suffix.
HOUSE_COLUMNS = {
    "temperature_2m": "temp_c",
    "wind_speed_10m": "wind_ms",
    "cloud_cover": "cloud_cover",
    "relative_humidity_2m": "humidity_pct",
}
VINTAGE_SUFFIX = "_previous_day"
CHUNK_DAYS = 365


def vintage_suffix(lead_days: int) -> str:
    require_positive(lead_days=lead_days)
    return f"{VINTAGE_SUFFIX}{lead_days}"


def payload_schema(variables: Sequence[str]) -> T.StructType:
    arrays = [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    return T.StructType(
        [
            T.StructField("utc_offset_seconds", T.LongType()),
            T.StructField(
                "hourly", T.StructType([T.StructField("time", T.ArrayType(T.StringType())), *arrays])
            ),
        ]
    )


def read_payloads(spark: SparkSession, path: str, variables: Sequence[str], extra: T.StructType | None = None) -> DataFrame:
    """JSON files with a declared schema; ``extra`` names key fields kept beside them."""
    fields = list(payload_schema(variables)) + (list(extra) if extra else [])
    return spark.read.schema(T.StructType(fields)).json(path)


def payload_problem(variables: Sequence[str]) -> Column:
    """Null for a good payload, else what is wrong with it."""
    absent = F.array_compact(
        F.array(*[F.when(F.col(f"hourly.`{v}`").isNull(), F.lit(v)) for v in variables])
    )
    offset = F.coalesce(F.col("utc_offset_seconds"), F.lit(0))
    return (
        F.when(offset != 0, F.concat(F.lit("expected UTC, got offset "), offset, F.lit("s")))
        .when(F.size(absent) > 0, F.concat(F.lit("missing variables: "), F.array_join(absent, ", ")))
    )


def parse_hourly(
    payloads: DataFrame, variables: Sequence[str] = tuple(HOUSE_COLUMNS), keep: Sequence[str] = (),
    strict: bool = True, lead_days: int | None = None,
) -> DataFrame:
    """One row per hour with house column names.

    A payload with an offset or a missing variable is a runtime error in strict mode and
    left out otherwise (``rejected_payloads`` lists those). With ``lead_days`` the
    variables are the vintage columns of that lead and the suffix is stripped.
    """
    suffix = vintage_suffix(lead_days) if lead_days is not None else ""
    asked = [f"{v}{suffix}" for v in variables]
    problem = payload_problem(asked)
    if strict:
        good = payloads.filter(
            F.when(problem.isNull(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
        )
    else:
        good = payloads.filter(problem.isNull())
    zipped = F.arrays_zip(F.col("hourly.time").alias("time"), *[F.col(f"hourly.`{a}`").alias(a) for a in asked])
    rows = good.select(*keep, F.explode(zipped).alias("_r"))
    return rows.select(
        *keep,
        F.to_timestamp(F.col("_r.time"), "yyyy-MM-dd'T'HH:mm").alias("ts"),
        *[F.col(f"_r.`{a}`").alias(HOUSE_COLUMNS.get(v, v)) for v, a in zip(variables, asked)],
    )


def rejected_payloads(payloads: DataFrame, variables: Sequence[str] = tuple(HOUSE_COLUMNS)) -> DataFrame:
    return payloads.withColumn("problem", payload_problem(variables)).filter("problem IS NOT NULL")


def vintages_long(df: DataFrame, keys: Sequence[str], variables: Sequence[str], leads: Sequence[int]) -> DataFrame:
    """All vintages as rows ``(keys, lead_days, house columns)``: one pass, no union."""
    per_lead = [
        F.struct(
            F.lit(n).alias("lead_days"),
            *[F.col(f"{v}{vintage_suffix(n)}").alias(HOUSE_COLUMNS.get(v, v)) for v in variables],
        )
        for n in leads
    ]
    return df.select(*keys, F.explode(F.array(*per_lead)).alias("_v")).select(*keys, "_v.*")


def date_chunks(ranges: DataFrame, start: str = "start_date", end: str = "end_date", days: int = CHUNK_DAYS) -> DataFrame:
    """Closed windows of at most ``days`` days covering each closed date range."""
    require_positive(days=days)
    chunk = F.explode(F.sequence(F.lit(0), F.floor(F.datediff(end, start) / days).cast("int")))
    others = [c for c in ranges.columns if c not in (start, end)]
    return (
        ranges.filter(F.col(start) <= F.col(end))
        .withColumn("_k", chunk)
        .select(
            *others,
            F.date_add(start, F.col("_k") * days).alias("chunk_start"),
            F.least(F.date_add(start, F.col("_k") * days + (days - 1)), F.col(end)).alias("chunk_end"),
        )
    )
