"""Line deduplication in DataFrame functions only.

Lines are exploded, normalised and hashed; a hash aggregate finds the keys that more than
one document holds and the document that keeps them; the lines to drop come back as
positions per document, and each text is put together again from the slices between them.
Only hashes and positions are shuffled by line key: the aggregate combines before its
shuffle, and the join on the key leaves a hot key to Spark's split of skewed joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, documents, stored, whole_rows

#: Shorter keys (blank lines, brackets, numbers) are never dropped.
LEAST_CHARS = 10


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_keys(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(id, text_key, pos, h1, h2) of every line whose key is long enough."""
    lines = docs.select("id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = lines.select("id", "text_key", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars)
    return keys.select("id", "text_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def without(lines: Column, drop: Column) -> Column:
    """``lines`` but for the positions in the sorted array ``drop``: slices, linear in the text."""
    starts = F.concat(F.array(F.lit(-1)), drop)
    ends = F.concat(drop, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 2, b - a - 1)))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS
) -> DataFrame:
    """One row per input row: id, text_key, text, n_lines, n_dropped, and the input's columns
    as _c0, _c1, ... in their order.

    A key found in at least two documents (ids) loses its lines everywhere but in the
    smallest id, where all its lines stay. Null and empty texts have one empty line. A null
    id counts as one id before all others. Repeated rows (same id and text) are one
    document; rows that share an id never count as two documents.
    """
    base = whole_rows(docs, id_col, text_col)
    keys = stored(line_keys(documents(docs, id_col, text_col), least_chars), "line-keys")
    shared = keys.groupBy("h1", "h2").agg(F.min("id").alias("keeper"), F.max("id").alias("_last")).where("keeper < _last")
    # As a table of its own the side of a hot key can be split in the join that follows.
    shared = stored(shared.select("h1", "h2", "keeper"), "shared-lines")
    drops = (
        keys.join(shared, ["h1", "h2"]).where("id > keeper")
        .groupBy("id", "text_key").agg(F.sort_array(F.collect_set("pos")).alias("drop"))
    )
    whole = base.join(drops, ["id", "text_key"], "left")
    # The array of lines is bound once, as the variable of a one-element transform.
    made = F.transform(
        F.array(F.split("text", "\n", -1)),
        lambda lines: F.struct(
            F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(without(lines, F.col("drop")), "\n")).alias("text"),
            F.size(lines).cast("long").alias("n"),
        ),
    )
    n_dropped = F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long")
    kept = whole.withColumn("n_dropped", n_dropped).withColumn("made", made[0])
    carried = [f"_c{i}" for i in range(len(docs.columns))]
    return kept.select(*carried, "id", "text_key", F.col("made.text").alias("text"), F.col("made.n").alias("n_lines"), "n_dropped")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with its texts deduplicated, and ``chars_col`` counted anew where it exists."""
    found = dedup_lines(docs, id_col, text_col)
    types = dict(docs.dtypes)

    def column(i: int, c: str) -> Column:
        if c == text_col:
            return F.col("text").alias(c)
        if c == chars_col:
            return F.char_length("text").cast(types[c]).alias(c)
        return F.col(f"_c{i}").alias(c)

    return found.select(*[column(i, c) for i, c in enumerate(docs.columns)])
