"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

#: Folders handed out inside the innermost ``scratch`` scope.
_scope: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def require_utc(spark: SparkSession) -> None:
    """Fail early when the session would read wall-clock times in a local zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"this library stores UTC; session time zone is {zone!r}")


def default_shared_dir(spark: SparkSession, folder: str) -> None:
    """Name a working folder for a *local* session that has none (tests, a laptop).

    A cluster's own setting is never touched, and none is made up for a cluster: a
    machine-local folder would not outlive an executor.
    """
    if not spark.conf.get(CHECKPOINT_SETTING, None) and spark.sparkContext.master.partition("[")[0] == "local":
        spark.conf.set(CHECKPOINT_SETTING, folder)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared folder, ``spark.checkpoint.dir``.

    Without that setting this is an error, on a laptop as on a cluster.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors can reach")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if (held := _scope.get()) is not None:
        held.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Working tables made inside the block go when it ends, also after an error.

    Frames that read them must be written or collected before that.
    """
    held: list[str] = []
    token = _scope.set(held)
    try:
        yield held
    finally:
        _scope.reset(token)
        for path in held:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def through_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Strict mode for operators whose empty result is an error. Runs a one-row action."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def require_columns(df: DataFrame, names, what: str = "input") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df


def require_positive(**values: float) -> None:
    """Every given number must be one or more."""
    low = {name: v for name, v in values.items() if v < 1}
    if low:
        raise ValueError("must be 1 or more: " + ", ".join(f"{n}={v}" for n, v in low.items()))
