"""Substring deduplication with difference-cover anchors.

A difference cover of period v is a set of residues such that any two positions have a
common offset below v that puts both on the cover. Anchors are runs of ``window - v + 1``
words that start at cover positions of their own document: two equal windows, wherever
they start, hold an equal anchor at the same offset. So only anchors are hashed and
shuffled at first (4 of 13 positions here). An anchor found once proves that no window with
it at that place repeats. Around repeated anchors matches are extended: first to whole
regions that anchors cover, of which equal ones (copies, passages) leave one to look at,
then to the single windows of the others, compared by 96-bit hashes. All but the first of
equals are removed.

Hot passages: each task reduces its anchors, regions and windows to one row per hash before the
shuffle, and marks what repeats within its own rows, so a group holds at most one row per
chunk of input, however often a passage occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NO_ID, documents, pieces, raw_texts

WINDOW = 20
#: Difference covers by period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9)}
#: Words whose anchors or windows a task reduces at a time.
CHUNK_WORDS = 400_000
_B1, _B2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def period_for(window: int) -> int:
    """The largest period whose anchors still have over a third of the window's words."""
    return max(v for v in COVERS if window - v + 1 >= max(1, window // 3))


def word_hashes(raw: bytes) -> np.ndarray:
    words = raw.split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def run_hashes(h: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes: a polynomial, put together from powers of two."""
    if len(h) < size:
        return h[:0]
    out, done, width, part = None, 0, 1, h
    while True:
        if size & width:
            piece = part[done:] if out is not None else part
            n = len(h) - (done + width) + 1
            out = piece[:n] if out is None else out[:n] * np.uint64(pow(base, width, 2**64)) + piece[:n]
            done += width
        if done == size:
            return out ^ (out >> np.uint64(31))
        part = part[:-width] * np.uint64(pow(base, width, 2**64)) + part[width:]
        width *= 2


def mixed(h: np.ndarray) -> np.ndarray:
    """A second, unrelated hash of the same words."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27))


def scattered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys that spread rows which need no partner."""
    return mixed(a.view(np.uint64) * np.uint64(_B1) + b.astype(np.uint64) * np.uint64(_B2))


def _chunks(batches: Iterator[pa.RecordBatch], rows_of) -> Iterator[list[np.ndarray]]:
    """Concatenated columns of ``rows_of(row)`` for about CHUNK_WORDS words at a time."""
    held, words = [], 0
    for b in pieces(batches):
        for row in zip(*(raw_texts(c) if pa.types.is_string(c.type) else c.to_pylist() for c in b.columns)):
            made, n = rows_of(*row)
            words += n
            if len(made[0]):
                held.append(made)
            if words >= CHUNK_WORDS and held:
                yield [np.concatenate(c) for c in zip(*held)]
                held, words = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def repeated_anchors(docs: DataFrame, window: int) -> DataFrame:
    """(doc, places): for each document key the positions of anchors that occur elsewhere too.

    The key may be shared by documents; places are then those of any of them. That is only
    a filter, and the list is bounded by the length of the longest text.
    """
    period = period_for(window)
    size, cover = window - period + 1, np.isin(np.arange(period), COVERS[period])

    def of_document(doc, raw):
        h = word_hashes(raw)
        at = np.flatnonzero(cover[np.arange(max(0, len(h) - size + 1)) % period])
        return (run_hashes(h, size, _B1)[at], np.full(len(at), doc, np.int64), at), len(h)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, doc, at in _chunks(batches, of_document):
            order = np.argsort(h, kind="stable")
            sorted_h = h[order]
            same = np.append(False, sorted_h[1:] == sorted_h[:-1])
            # Back in the order of the documents, in which the rows compress best.
            extra, local = np.zeros(len(h), bool), np.zeros(len(h), bool)
            extra[order], local[order] = same, same | np.append(same[1:], False)
            h = np.where(extra, scattered(doc, at), h)
            at = np.where(local, -at - 1, at).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(at), pa.array(doc)], ["h", "at", "doc"])

    # A negative place (-at - 1) is known to repeat within its task's own rows. Columns that
    # vary come first and those that a document's rows share last: so shuffles compress best.
    rows = docs.select("doc", "text").mapInArrow(reduced, "h long, at int, doc long")
    found = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("h"))).where("at < 0 OR n > 1")
    return found.groupBy("doc").agg(F.collect_set(F.when(F.col("at") < 0, -F.col("at") - 1).otherwise(F.col("at"))).alias("places"))


def regions(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches that repeated anchors cover without a gap."""
    p = np.unique(places)
    new = np.append(True, p[1:] > p[:-1] + size)
    heads = np.flatnonzero(new)
    return p[heads], p[np.append(heads[1:], len(p)) - 1] + size


def _firsts(h1: np.ndarray, h2: np.ndarray, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in order of their places: which are the first of their hash, and which are
    later than it (a repeated row of the same place is neither)."""
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    same = np.append(False, (a[1:] == a[:-1]) & (b[1:] == b[:-1]))[: len(a)]
    first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    lone, later = np.ones(len(h1), bool), np.zeros(len(h1), bool)
    lone[order] = ~same
    later[order] = same & np.logical_or.reduce([x[order] != x[first] for x in places])
    return lone, later


def _judged(rows: DataFrame) -> DataFrame:
    """Rows (h1, h2, start, id, text_key, run): those that start later than an equal one. A
    negative run is known to."""
    place = F.struct("id", "text_key", "start")
    first = F.min(place).over(Window.partitionBy("h1", "h2"))
    later = rows.withColumn("first", first).where((F.col("run") < 0) | (place > F.col("first")))
    return later.select("id", "text_key", "start", F.abs("run").alias("run"))


_ROWS = "h1 long, h2 int, start int, id long, text_key long, run int"


def _batch(h1, h2, doc, key, start, run, known) -> pa.RecordBatch:
    h2 = (h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)
    run = np.where(known, -run, run).astype(np.int32)
    cols = [h1.view(np.int64), h2, start.astype(np.int32), doc, key, run]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["h1", "h2", "start", "id", "text_key", "run"])


def later_regions(held: DataFrame, window: int) -> DataFrame:
    """(id, text_key, start, run): whole regions of repeated anchors that are equal, word for
    word, to one that starts earlier: all windows inside them are later ones.

    A copy of a text or a passage is one such region, so its windows need not be compared
    one by one.
    """
    size = window - period_for(window) + 1

    def of_document(doc, key, raw, places):
        h = word_hashes(raw)
        lo, hi = regions(np.array(places), size)
        ok = (hi - lo >= window) & (hi <= len(h))  # places may be those of another text under the id
        lo, hi = lo[ok], hi[ok]
        digest = b"".join(xxhash.xxh3_128_digest(h[x:y].tobytes()) for x, y in zip(lo.tolist(), hi.tolist()))
        d = np.frombuffer(digest, np.uint64).reshape(-1, 2)
        return (d[:, 0], d[:, 1], np.full(len(lo), doc, np.int64), np.full(len(lo), key, np.int64), lo, hi - lo), len(h)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h1, h2, doc, key, start, n in _chunks(batches, of_document):
            order = np.lexsort((start, key, doc))
            h1, h2, doc, key, start, n = (x[order] for x in (h1, h2, doc, key, start, n))
            lone, later = _firsts(h1, h2, [doc, key, start])
            h1 = np.where(later, scattered(doc ^ key, start), h1)
            keep = lone | later
            yield _batch(*(x[keep] for x in (h1, h2, doc, key, start, n - window + 1, later)))

    return _judged(held.select("id", "text_key", "text", "places").mapInArrow(reduced, _ROWS))


def later_windows(held: DataFrame, window: int) -> DataFrame:
    """(id, text_key, start, run): runs of window starts whose words also start earlier.

    ``held`` has the places of repeated anchors and, in ``skip``, the regions that are known
    to be later ones; these are handed on as they are, all other windows around repeated
    anchors are compared.
    """
    period = period_for(window)

    def of_document(doc, key, raw, places, skip):
        h = word_hashes(raw)
        n = len(h) - window + 1
        if n < 1:
            return [h[:0]] * 6, len(h)
        near, done = np.zeros(n + 1, np.int32), np.zeros(n + 1, np.int32)
        at = np.array(places)
        np.add.at(near, np.clip(at - period + 1, 0, n), 1)
        np.add.at(near, np.minimum(at + 1, n), -1)
        own = [(r["start"], r["run"]) for r in skip or () if r["id"] == doc and r["text_key"] == key]
        for start, run in own:
            done[start] += 1
            done[start + run] -= 1
        start = np.flatnonzero((np.cumsum(near[:-1]) > 0) & (np.cumsum(done[:-1]) == 0))
        h1, h2 = run_hashes(h, window, _B1)[start], run_hashes(mixed(h), window, _B2)[start]
        runs = np.zeros(len(start), np.int64)
        if own:
            known = np.array(own)
            start, runs = np.concatenate([start, known[:, 0]]), np.concatenate([runs, known[:, 1]])
            spread = scattered(np.full(len(own), doc ^ key, np.int64), known[:, 0])
            h1, h2 = np.concatenate([h1, spread]), np.concatenate([h2, spread])
        return (h1, h2, np.full(len(start), doc, np.int64), np.full(len(start), key, np.int64), start, runs), len(h)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in _chunks(batches, of_document):
            # In order of documents: rows compress best so, and the first of equals comes first.
            order = np.lexsort((cols[4], cols[3], cols[2]))
            h1, h2, doc, key, start, run = (x[order] for x in cols)
            known = run > 0
            yield _batch(h1[known], h2[known], doc[known], key[known], start[known], run[known], known[known])
            h1, h2, doc, key, start = (x[~known] for x in (h1, h2, doc, key, start))
            lone, later = _firsts(h1, h2, [doc, key, start])
            one = np.ones(int(lone.sum()), np.int64)
            yield _batch(h1[lone], h2[lone], doc[lone], key[lone], start[lone], one, np.zeros(len(one), bool))
            # Later ones of the chunk go on as runs of starts, under keys that spread.
            d, k, s = doc[later], key[later], start[later]
            new = np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1]) | (s[1:] > s[:-1] + 1))[: len(d)]
            heads = np.flatnonzero(new)
            run = s[np.append(heads[1:], len(d)) - 1] - s[heads] + 1 if len(heads) else s[:0]
            spread = scattered(d[heads] ^ k[heads], s[heads])
            yield _batch(spread, spread, d[heads], k[heads], s[heads], run, np.ones(len(heads), bool))

    return _judged(held.select("id", "text_key", "text", "places", "skip").mapInArrow(reduced, _ROWS))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, text_key, n_words, n_removed, kept), one row per input row.

    Words are runs of anything but the six ASCII spaces, unchanged. A window is ``window``
    words in a row of one document; every word covered by a window whose words also start
    earlier (smaller id, or the same document, earlier start) is removed, judged on the
    input. ``kept`` is the other words joined by one space.

    Null and blank texts have no word and an empty ``kept``. A null id is smaller than all
    others. Repeated rows (same id and text) are one document, not copies of each other;
    rows that share only the id are ordered by a hash of their text.
    """
    # One join key for all: the id, or the hash of the text where the id is missing. All joins
    # shuffle the texts by it in the same way, so they are shuffled once.
    doc = F.when(F.col("id") == NO_ID, F.col("text_key")).otherwise(F.col("id")).alias("doc")
    base = documents(docs, id_col, text_col).select(doc, "id", "text_key", "text")
    places = repeated_anchors(base, window)
    held = base.join(places, "doc")
    skip = later_regions(held, window).groupBy(doc).agg(F.collect_list(F.struct("id", "text_key", "start", "run")).alias("skip"))
    later = later_windows(held.join(skip, "doc", "left"), window)
    runs = later.groupBy(doc).agg(F.collect_list(F.struct("id", "text_key", "start", "run")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            rows = []
            for doc, key, raw, runs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), raw_texts(b.column(2)), b.column(3).to_pylist()):
                words = raw.split()
                gone = 0
                if runs := [r for r in runs or () if r["id"] == doc and r["text_key"] == key]:
                    edge = np.zeros(len(words) + 1, np.int32)
                    start = np.array([r["start"] for r in runs])
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + [r["run"] + window - 1 for r in runs], -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    gone = len(words) - int(keep.sum())
                    kept = [w for w, k in zip(words, keep.tolist()) if k]
                else:
                    kept = words
                rows.append((len(words), gone, b" ".join(kept)))
            n, gone, kept = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["id", "text_key", "n_words", "n_removed", "kept"],
            )

    whole = base.join(runs, "doc", "left").select("id", "text_key", "text", "runs")
    return whole.mapInArrow(cut, "id long, text_key long, n_words long, n_removed long, kept string")
