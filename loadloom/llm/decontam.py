"""Benchmark decontamination by the q-gram lemma.

A passage of m characters that occurs in a text with at most k edits shares at least
``m + 1 - q (k + 1)`` q-grams with it, and all of them lie on diagonals (text position
minus passage position) that differ by at most k. So: look up every q-gram of a text in an
index of the passages' q-grams, count the hits in overlapping bands of diagonals, keep the
bands that reach the passage's bound, and verify those by an alignment that stays in the
band. The filter loses no match; the alignment lets no other region through.

An item is found whole (its passages with up to a tenth of edits) or in part: a quote of
some of it holds one of the item's short overlapping windows nearly as it is.

The passages are cut from the items in tasks and dealt into blocks of bounded size whatever an
item's length; one block at a time is collected, broadcast and released, and its index is built
in the Python workers. The documents are only mapped, never shuffled. Texts of any length and
form take bounded memory: long repetitions of a few characters are shortened first (a match
lies within one end of them or is repeated there), and hits are counted stretch by stretch.

Texts are compared in lower case with runs of white space as one space; offsets are given
in the text as it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, pick, pieces, shown_id, stored

Q = 8
#: Edits allowed, as a share of a passage's characters.
EDIT_SHARE = 0.1
#: Items with fewer characters (after normalising) are no evidence of a leak.
LEAST_CHARS = 32
#: Longer items are cut into passages of this length that overlap by half.
PASSAGE_CHARS = 512
#: Extracts: every item over this length is also searched in windows of it, at this stride, with
#: these few edits. A text that holds 149 characters of an item in a row holds a window.
EXTRACT_CHARS, EXTRACT_STRIDE, EXTRACT_EDITS = 100, 50, 3
#: Characters of passages in one broadcast block, about.
BLOCK_CHARS = 2_000_000
#: Characters that any match stays under, with its edits and a q-gram at its ends.
_REACH = 640
#: Characters of a text looked at in one stretch, and hits counted in one step.
STRETCH, STEP_HITS = 1 << 16, 1 << 21
_BLOOM_BITS = 22
_MUL = 0x9E3779B97F4A7C15


class Index(NamedTuple):
    """Passages of one block and their q-grams, sorted; postings by q-gram."""

    ids: list
    codes: list[np.ndarray]
    edits: np.ndarray
    bound: np.ndarray
    seen: np.ndarray
    grams: np.ndarray
    offsets: np.ndarray
    passage: np.ndarray
    place: np.ndarray
    #: Whether a passage is a window of a longer item.
    extract: np.ndarray


@lru_cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and white space by code point (one-to-one lower cases only)."""
    low = np.arange(0x110000, dtype=np.uint32)
    space = np.zeros(0x110000, bool)
    for i in range(0x20000):
        c = chr(i)
        if len(x := c.lower()) == 1:
            low[i] = ord(x)
        space[i] = c.isspace()
    return low, space


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with single spaces, and each one's place in ``text``."""
    low, space = _tables()
    c = low[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    blank = space[c]
    c[blank] = 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    at = np.flatnonzero(keep)
    return c[at], at


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of all q-grams, by doubling: 1, 2, 4, 8 characters."""
    h, width, mul = codes.astype(np.uint64) + np.uint64(1), 1, _MUL
    while width < Q:
        h = h[:-width] * np.uint64(mul) + h[width:] if len(h) > width else h[:0]
        mul, width = mul * mul % 2**64, 2 * width
    return (h ^ (h >> np.uint64(29))) * np.uint64(_MUL)


def shortened(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and places without the middle of long runs that repeat 1 to ``Q`` characters.

    Both ends of a run stay, longer than any match, and the cut is a multiple of the period:
    every stretch of ``_REACH`` characters of the text still occurs, and no other.
    """
    for period in range(1, Q + 1):
        if len(codes) <= 3 * _REACH:
            break
        same = np.concatenate([[False], codes[period:] == codes[:-period], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = edges[::2], edges[1::2] + period
        long = ends - starts > 3 * _REACH
        if long.any():
            keep = np.ones(len(codes), bool)
            for a, b in zip(starts[long].tolist(), ends[long].tolist()):
                keep[a + _REACH : a + _REACH + (b - a - 2 * _REACH) // period * period] = False
            codes, at = codes[keep], at[keep]
    return codes, at


def cut(text: str) -> list[tuple[np.ndarray, bool]]:
    """(characters, whether a window of a longer item) of one item's passages; short items have none."""
    c = normalised(text)[0]
    c = c[int(len(c) > 0 and c[0] == 32) : len(c) - int(len(c) > 1 and c[-1] == 32)]
    if len(c) < LEAST_CHARS:
        return []
    starts = range(0, max(1, len(c) - PASSAGE_CHARS // 2), PASSAGE_CHARS // 2)
    windows = [*range(0, len(c) - EXTRACT_CHARS, EXTRACT_STRIDE), len(c) - EXTRACT_CHARS] if len(c) > EXTRACT_CHARS else []
    return [(c[s : s + PASSAGE_CHARS], False) for s in starts] + [(c[s : s + EXTRACT_CHARS], True) for s in windows]


def build(passages: list[tuple[object, np.ndarray, bool]]) -> Index:
    """Index of (item id, characters, window) passages."""
    ids, codes, extract = ([p[k] for p in passages] for k in range(3))
    m, extract = np.array([len(c) for c in codes]), np.array(extract)
    # The budget never leaves the range in which the lemma filters (a bound of 1 at least).
    edits = np.where(extract, EXTRACT_EDITS, np.minimum((m * EDIT_SHARE).astype(int), (m - Q) // Q))
    hashes = [gram_hashes(c) for c in codes]
    h = np.concatenate(hashes)
    passage = np.repeat(np.arange(len(codes)), [len(x) for x in hashes])
    place = np.concatenate([np.arange(len(x)) for x in hashes])
    order = np.argsort(h, kind="stable")
    grams, first = np.unique(h[order], return_index=True)
    seen = np.zeros(1 << _BLOOM_BITS, bool)
    seen[grams >> np.uint64(64 - _BLOOM_BITS)] = True
    return Index(
        ids, codes, edits, m + 1 - Q * (edits + 1), seen, grams, np.append(first, len(h)), passage[order], place[order], extract
    )


def bands(codes: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(passage, lowest diagonal) of the bands whose shared q-grams reach the bound.

    A band is ``2 k + 2`` diagonals wide and starts at a multiple of ``k + 1``, so the
    diagonals of any alignment with k edits fit into one. Stretches overlap by more than a
    match, so each match has all its hits in one of them.
    """
    h = gram_hashes(codes)
    at = np.flatnonzero(index.seen[h >> np.uint64(64 - _BLOOM_BITS)])
    g = np.searchsorted(index.grams, h[at])
    hit = index.grams[np.minimum(g, len(index.grams) - 1)] == h[at]
    at, g = at[hit], g[hit]
    n = index.offsets[g + 1] - index.offsets[g]
    reached = [np.zeros(0, np.int64)]
    for low in range(0, len(codes), STRETCH):
        a, b = np.searchsorted(at, (low, low + STRETCH + _REACH))
        if a < b:
            reached.append(_reached(at[a:b], g[a:b], n[a:b], index))
    key = np.unique(np.concatenate(reached))
    p = key >> 40
    return p, (key & ((1 << 40) - 1)) * (index.edits[p] + 1) - PASSAGE_CHARS


def _reached(at: np.ndarray, g: np.ndarray, n: np.ndarray, index: Index) -> np.ndarray:
    """Keys (passage and band) of one stretch that reach their bound; hits are counted in steps of ``STEP_HITS``."""
    part = np.cumsum(n) // STEP_HITS
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(at)]
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for a, b in zip(edges, edges[1:]):
        some = n[a:b]
        posting = np.repeat(index.offsets[g[a:b]] - np.append(0, np.cumsum(some)[:-1]), some) + np.arange(some.sum())
        p = index.passage[posting]
        band = (np.repeat(at[a:b], some) - index.place[posting] + PASSAGE_CHARS) // (index.edits[p] + 1)
        key = (p << 40) + band
        key, count = np.unique(np.concatenate([key, key[band > 0] - 1]), return_counts=True)
        if len(keys):
            key, back = np.unique(np.concatenate([keys, key]), return_inverse=True)
            count = np.bincount(back, np.concatenate([counts, count])).astype(np.int64)
        keys, counts = key, count
    return keys[counts >= index.bound[keys >> 40]]


def align(texts: list[np.ndarray], passages: list[np.ndarray], low: np.ndarray, edits: np.ndarray):
    """Banded alignment of many (text, passage, band) at once: edits, start and end in the text.

    Row by row over the passages; a cell holds cost and start diagonal in one number, so
    the minimum carries the start along.
    """
    n, rows = len(texts), np.array([len(p) for p in passages])
    width, top = 2 * int(edits.max()) + 2, int(rows.max())
    text = np.zeros((n, top + width), np.uint32)
    pattern = np.ones((n, top), np.uint32)
    for i, (t, p, lo) in enumerate(zip(texts, passages, low)):
        a, b = max(lo, 0), min(len(t), lo + top + width)
        text[i, a - lo : b - lo] = t[a:b]
        pattern[i, : len(p)] = p
    one, ramp = 1 << 20, np.arange(width, dtype=np.int64) << 20
    inside = np.arange(width) < (2 * edits + 2)[:, None]
    far = np.int64(1) << 50
    cost = np.where(inside, np.arange(width, dtype=np.int64), far)
    last = np.zeros((n, width), np.int64)
    for j in range(top):
        step = cost + one * (text[:, j : j + width] != pattern[:, j, None])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + one)
        step = np.minimum.accumulate(np.where(inside, step, far) - ramp, axis=1) + ramp
        cost = np.where(inside, step, far)
        ended = rows == j + 1
        last[ended] = cost[ended]
    best = last.argmin(1)
    value = last[np.arange(n), best]
    return value >> 20, low + (value & (one - 1)), low + rows + best


def matches(texts: list[str], index: Index) -> list[tuple[int, int, int, int, int]]:
    """(text number, passage number, edits, start, end) of verified regions, best per pair; a
    window's only if none of the item's passages is found in the text."""
    docs, where, found = [], [], []
    for i, t in enumerate(texts):
        codes, at = shortened(*normalised(t))
        if len(codes) < Q:
            continue
        for p, low in zip(*bands(codes, index)):
            found.append((i, int(p), int(low), len(docs)))
        if found and found[-1][3] == len(docs):
            docs.append(codes)
            where.append(at)
    best: dict[tuple[int, object], tuple] = {}
    for windows in (False, True):  # windows only where no passage was found
        some = [f for f in found if index.extract[f[1]] == windows and not (windows and (f[0], index.ids[f[1]]) in best)]
        for a in range(0, len(some), 512):
            part = some[a : a + 512]
            ps, lows = np.array([f[1] for f in part]), np.array([f[2] for f in part])
            cost, start, end = align([docs[f[3]] for f in part], [index.codes[p] for p in ps], lows, index.edits[ps])
            for (i, p, _, d), c, s, e in zip(part, cost.tolist(), start.tolist(), end.tolist()):
                if c <= index.edits[p]:
                    at = where[d]
                    s, e = max(s, 0), min(max(e, 1), len(at))
                    key, row = (i, index.ids[p]), (c, int(at[min(s, len(at) - 1)]), int(at[e - 1]) + 1, p)
                    best[key] = min(best.get(key, row), row)
    return [(i, p, c, s, e) for (i, _), (c, s, e, p) in sorted(best.items(), key=lambda x: (x[0][0], x[1]))]


def _passages(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, str, int]:
    """The passages (item, codes, extract, block) as a table, the items' type, and the number of
    blocks; null texts and short items have none."""
    items = pick(benchmark, item=item_col, text=text_col).where(F.col("text").isNotNull()).distinct()
    # Integer item ids are carried as long, all others as text.
    kind = "long" if dict(items.dtypes)["item"] in ("tinyint", "smallint", "int", "bigint") else "string"
    items = items.withColumn("item", F.col("item").cast(kind))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 16):
            rows = [(i, c.tobytes(), x) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for c, x in cut(t)]
            for at in range(0, len(rows), 4096):
                cols = zip(zip(*rows[at : at + 4096]), (pa.int64() if kind == "long" else pa.string(), pa.binary(), pa.bool_()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in cols], ["item", "codes", "extract"])

    cut_ = stored(items.mapInArrow(mapped, f"item {kind}, codes binary, extract boolean"), "passages")
    total = cut_.agg(F.coalesce(F.sum(F.octet_length("codes")), F.lit(0))).first()[0] // 4
    n = -(-total // BLOCK_CHARS)
    return cut_.withColumn("block", F.pmod(F.xxhash64("item", "codes"), F.lit(max(n, 1)))), kind, n


_INDEXES: dict[str, Index] = {}


def _index(shared, key: str) -> Index:
    """One block's index per Python worker."""
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = build([(i, np.frombuffer(c, np.uint32), x) for i, c, x in shared.value])
    return _INDEXES[key]


def per_block(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text"):
    """(index of a block, inside a task) for each block in turn; the block before is released then."""
    table, _, n = _passages(benchmark, item_col, text_col)
    for k in range(n):
        rows = sorted(((r["item"], bytes(r["codes"]), r["extract"]) for r in table.where(F.col("block") == k).collect()), key=lambda r: (r[2], str(r[0]), r[1]))
        if not rows:
            continue
        shared, key = benchmark.sparkSession.sparkContext.broadcast(rows), uuid4().hex
        del rows
        yield lambda shared=shared, key=key: _index(shared, key), n
        if n > 1:
            shared.unpersist()


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """(doc_id, item_id, n_edits, start, end): the best verified region of each document and item.

    Edits and region are those of the whole item (or its passage of ``PASSAGE_CHARS``) where it
    is found, else of its best window. ``start`` and ``end`` count code points of the text. Null or empty texts have no region;
    repeated rows have their own; an empty benchmark gives no rows; a null document id is
    shown as null.
    """
    spark, base = docs.sparkSession, documents(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    kind = "long" if dict(benchmark.dtypes)[item_col] in ("tinyint", "smallint", "int", "bigint") else "string"
    schema = f"id long, row long, item_id {kind}, window boolean, n_edits int, start int, end int"
    types = [pa.int64(), pa.int64(), pa.int64() if kind == "long" else pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.int32()]
    out = None
    for index, n in per_block(benchmark, item_col):

        def mapped(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            x = index()
            for b in pieces(batches):
                ids, row = b.column(0).to_pylist(), b.column(3).to_pylist()
                rows = [(ids[i], row[i], x.ids[p], bool(x.extract[p]), c, s, e) for i, p, c, s, e in matches(b.column(2).to_pylist(), x)]
                cols = list(zip(*rows)) if rows else [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["id", "row", "item_id", "window", "n_edits", "start", "end"])

        found = base.mapInArrow(mapped, schema)
        found = stored(found, "leaks") if n > 1 else found  # its block may go then
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], schema).select(shown_id().alias("doc_id"), "item_id", "n_edits", "start", "end")
    if n > 1:  # an item's passages may lie in several blocks: its best region, a passage before a window
        out = out.groupBy("id", "row", "item_id").agg(F.min(F.struct("window", "n_edits", "start", "end")).alias("r")).select("id", "item_id", "r.*")
    return out.select(shown_id().alias("doc_id"), "item_id", "n_edits", "start", "end")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept, in one pass per block.

    Null and empty texts stay; of repeated rows all stay or go; an empty benchmark keeps all.
    """
    names = docs.columns
    at, out = names.index(text_col), docs.toDF(*[f"_c{i}" for i in range(len(names))])
    for index, n in per_block(benchmark):

        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            x = index()
            for b in pieces(batches):
                keep = np.ones(b.num_rows, bool)
                keep[[m[0] for m in matches([t or "" for t in b.column(at).to_pylist()], x)]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(clean, out.schema)
        out = stored(out, "clean") if n > 1 else out
    return out.toDF(*names)
