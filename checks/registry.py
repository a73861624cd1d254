"""Pairs every query with the SQL that must give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom.session import default_shared_dir

from .base_sql import BASE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6
#: Working folder of a local session that names none.
SCRATCH = f"/tmp/loadloom-{os.getpid()}"


def plain(df: DataFrame) -> DataFrame:
    """Types both engines agree on: rounded doubles, bigint, zoneless UTC timestamps."""

    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return (F.round(c.cast("double"), DIGITS) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.DateType)):
            return c.cast("timestamp_ntz").alias(f.name)
        return c

    return df.select(*[shown(f) for f in df.schema])


def query(name: str, sql: str | None = None, floats: str = ""):
    """Register ``fn(spark, sf_dir)``; ``floats`` names the double columns the SQL rounds."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            default_shared_dir(spark, SCRATCH)
            return plain(fn(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            body = BASE + sql
            rounded = ", ".join(f"round({c}, {DIGITS}) + 0.0 AS {c}" for c in floats.split())
            ORACLES[name] = f"SELECT * REPLACE ({rounded}) FROM ({body})" if rounded else f"SELECT * FROM ({body})"
        return fn

    return register
