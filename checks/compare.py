"""Run registered queries and their oracle SQL side by side.

    python -m checks.compare [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cells(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, float):
            return f"{v:.6f}".replace("-0.000000", "0.000000")
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


def differences(spark_df: pd.DataFrame, oracle: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(oracle.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(oracle.columns)}"
    if len(spark_df) != len(oracle):
        return f"rows {len(spark_df)} != {len(oracle)}"
    a, b = _cells(spark_df), _cells(oracle)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first: {bad[0]}" if bad else None


def check(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[str | None, int, float]:
    from .registry import ORACLES, QUERIES

    t0 = time.time()
    got = QUERIES[name](spark, sf_dir).toPandas()
    took = time.time() - t0
    if name not in ORACLES:
        return None, len(got), took
    return differences(got, con.execute(ORACLES[name]).df()), len(got), took


def main(argv: list[str]) -> int:
    from . import load_all

    load_all()
    from .registry import ORACLES, QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in QUERIES:
        if len(argv) > 1 and not any(name.startswith(p) for p in argv[1:]):
            continue
        try:
            problem, rows, took = check(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001 - report and go on
            problem, rows, took = f"{type(e).__name__}: {str(e)[:600]}", 0, 0.0
        failed += problem is not None
        oracle = "oracle" if name in ORACLES else "rows-only"
        print(f"{'FAIL' if problem else 'ok':4} {took:6.2f}s {rows:7d} {oracle:9} {name} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
