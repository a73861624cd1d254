"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadloom.session import default_shared_dir, through_table

#: The six ASCII white-space characters; every word and line rule here uses exactly these.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A missing id takes part under this value, before every other one.
NO_ID = -(2**63)


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """``wanted`` maps output names to input columns; every other column is left out.

    Columns are taken by their exact name and position, so further columns may have any
    name, names that differ in case only included.
    """
    names = df.columns
    missing = [c for c in wanted.values() if c not in names]
    if missing:
        raise ValueError(f"input is missing required columns: {missing}")
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return flat.select(*[F.col(f"_c{names.index(c)}").alias(out) for out, c in wanted.items()])


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, text): a null text is empty, a null id is the smallest of all.

    ``id`` and ``text_key`` name a document: rows equal in both are repeated rows of one
    document and share one result, rows that share only the id are documents of their own.
    """
    return pick(df, id=id_col, text=text_col).select(
        F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def whole_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``documents``, with every column of ``df`` beside it as _c0, _c1, ... in order."""
    names = df.columns
    missing = [c for c in (id_col, text_col) if c not in names]
    if missing:
        raise ValueError(f"input is missing required columns: {missing}")
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    doc_id, text = f"_c{names.index(id_col)}", f"_c{names.index(text_col)}"
    return flat.select(
        "*", F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), F.coalesce(text, F.lit("")).alias("text"),
    )


def shown_id(c: str = "id") -> Column:
    """The id as it came in: the value for a missing id is null again."""
    return F.when(F.col(c) != NO_ID, F.col(c))


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case and nothing else; ASCII-only values take the fast built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches cut into small ones, so that what a task holds beside them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, survives lost executors."""
    return through_table(df, name)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed on the executors; there the path is just not found.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH")]))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    default_shared_dir(spark, f"/tmp/loadloom-{os.getpid()}")  # a local session without one; never a cluster's
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
