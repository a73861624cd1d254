"""Fill-in-the-middle transformation of texts, as a pyarrow.compute pipeline over line units.

A text is a list of lines, each with its line break. Two cut points make a prefix, a middle
and a suffix of whole lines, which are written in another order behind sentinels, so that a
model that reads left to right learns to fill the middle. Every choice follows from a hash of
the document's id: it stays the same in every run and on every executor.

Per batch: the texts become a list array of lines, the lists are flattened beside the index of
their text, the ordinal of each line within its text follows from the list offsets, the lines
of each role are filtered by ordinal and counted back into lists, and ``binary_join`` makes the
three pieces. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import pick, pieces

#: Sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text that one step of a task holds.
_STEP_BYTES = 32 << 20
_EMPTY = pa.scalar("", pa.large_string())
_RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


class Plan(NamedTuple):
    """What is drawn: the salt before an id, and the percentages of rearranged texts and of those in spm order."""

    salt: str = "7:"
    fim_percent: int = 100
    spm_percent: int = 50


def draws(id_col: str, salt: str) -> list:
    """h1 to h4: the first four groups of 8 hex digits of the id's SHA-256, as numbers; a null id is no digits."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(unit, parent, ordinal): the lines of all texts with their breaks, flat."""
    lists = pc.split_pattern(texts.cast(pa.large_string()), "\n")
    parent = pc.list_parent_indices(lists).to_numpy()
    starts = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    ordinal = np.arange(len(parent)) - starts[parent]
    last = ordinal == (np.diff(starts) - 1)[parent]
    # Every part but the last ended at a break; a last part without characters is no line.
    lines = pc.binary_join_element_wise(lists.flatten(), pc.if_else(pa.array(last), _EMPTY, pa.scalar("\n", pa.large_string())), _EMPTY)
    keep = ~last | (pc.binary_length(lines).to_numpy(zero_copy_only=False) > 0)
    return lines.filter(pa.array(keep)), parent[keep], ordinal[keep]


def joined(lines: pa.Array, parent: np.ndarray, role: np.ndarray, n: int) -> pa.Array:
    """For each of ``n`` texts, its lines of one role as one string."""
    offsets = np.append(0, np.cumsum(np.bincount(parent[role], minlength=n)))
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), lines.filter(pa.array(role)))
    return pc.binary_join(lists, _EMPTY)


def transformed(texts: pa.Array, h: np.ndarray, plan: Plan = Plan()) -> tuple[pa.Array, ...]:
    """n, form, prefix_chars, middle_chars and output of texts without nulls; ``h`` has a row h1 to h4 for each."""
    n_texts, texts = len(texts), texts.cast(pa.large_string())
    lines, parent, ordinal = units(texts)
    n = np.bincount(parent, minlength=n_texts)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    before, after = ordinal < cuts[parent, 0], ordinal >= cuts[parent, 1]
    head, mid, tail = (joined(lines, parent, r, n_texts) for r in (before, ~before & ~after, after))
    marked = pc.or_(pc.or_(pc.match_substring(texts, PREFIX), pc.match_substring(texts, SUFFIX)), pc.match_substring(texts, MIDDLE))
    plain = pc.or_(marked, pa.array((n == 0) | (h[:, 2] % 100 >= plan.fim_percent)))
    spm = pa.array(h[:, 3] % 100 < plan.spm_percent)
    p, s, m = (pa.scalar(x, pa.large_string()) for x in (PREFIX, SUFFIX, MIDDLE))
    psm_text = pc.binary_join_element_wise(p, head, s, tail, m, mid, _EMPTY)
    spm_text = pc.binary_join_element_wise(s, tail, p, head, m, mid, _EMPTY)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(x).cast(pa.int64())) for x in (head, mid)]
    return pa.array(n, pa.int64()), form, *chars, pc.if_else(plain, texts, pc.if_else(spm, spm_text, psm_text))


def restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The exact texts, from output and form alone: a rearranged text holds each sentinel once."""
    outputs = outputs.cast(pa.large_string())
    first = {"psm": (PREFIX, SUFFIX), "spm": (SUFFIX, PREFIX)}
    out = outputs
    for form, (a, b) in first.items():
        some = pc.equal(forms, form)
        if not pc.any(some).as_py():
            continue
        body = pc.utf8_slice_codeunits(outputs.filter(some), len(a))
        parts = pc.split_pattern(pc.split_pattern(body, b, max_splits=1).flatten(), MIDDLE, max_splits=1)
        # Two strings a text before the split at the middle's sentinel, the second of which holds it.
        flat, ends = parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
        x, y, mid = (flat.take(pa.array(i)) for i in (ends[0:-1:2], ends[1:-1:2], ends[1:-1:2] + 1))
        head, tail = (x, y) if form == "psm" else (y, x)
        out = pc.replace_with_mask(out, some, pc.binary_join_element_wise(head, mid, tail, _EMPTY))
    return out


def _steps(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Small batches whose texts stay under ``_STEP_BYTES``, or hold one text."""
    for b in pieces(batches):
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(at)), 0).to_numpy(zero_copy_only=False)) // _STEP_BYTES
        edges = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), b.num_rows]
        yield from (b.slice(x, y - x) for x, y in zip(edges, edges[1:]) if y > x)


def _columns(arrays, schema) -> list[pa.Array]:
    return [x.cast(f.type) for x, f in zip(arrays, schema)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per input row.

    ``form`` is ``plain`` (the text as it is), ``psm`` or ``spm``. A null text is empty, and
    empty texts and those that hold a sentinel stay plain. Repeated rows give equal rows; a
    null id draws like an id without digits and is shown as null.
    """
    rows = pick(docs, id=id_col, text=text_col)
    kind = dict(rows.dtypes)["id"]
    rows = rows.select("id", F.coalesce("text", F.lit("")).alias("text"), *draws("id", plan.salt))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _steps(batches, 1):
            h = np.stack([b.column(k).to_numpy() for k in range(2, 6)], axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), *_columns(transformed(b.column(1), h, plan), shown)], ["id", *shown.names])

    shown = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
    return rows.mapInArrow(mapped, f"id {kind}, {_RESULT}").withColumnRenamed("id", "doc_id")


def restore(docs: DataFrame, output_col: str = "output", form_col: str = "form", text_col: str = "restored") -> DataFrame:
    """``docs`` with the text rebuilt from output and form appended; a column of that name is replaced.

    A null output is the empty text; any form but ``psm`` and ``spm`` is taken as plain.
    """
    names = docs.columns
    at, form = names.index(output_col), names.index(form_col)
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _steps(batches, at):
            back = restored(pc.fill_null(b.column(at), ""), pc.fill_null(b.column(form), "plain"))
            yield pa.RecordBatch.from_arrays([*b.columns, back.cast(pa.string())], [*b.schema.names, "_text"])

    out = flat.mapInArrow(mapped, StructType([*flat.schema, StructField("_text", StringType())]))
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names) if c != text_col], F.col("_text").alias(text_col))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``transform`` with digests of the output and of the text restored from it in place of the output."""
    found = restore(transform(docs, id_col, text_col, plan))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )
