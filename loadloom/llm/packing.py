"""Packing of documents into training sequences by non-negative least squares.

Every document is encoded once and cut into full windows and a rest; a full window is a
sequence of its own and is never moved. The rests are packed by their lengths alone: all
combinations of up to three lengths that fill a window exactly are enumerated, and repeat
counts for them are fitted to the histogram of lengths by non-negative least squares. The
counts are rounded, and what the rounding leaves over is packed greedily: longest piece
first, and where nothing fits the gap, the shortest piece that is too long is cut at it.

The histogram has one number per length, whatever the data, and so has the outcome: a list of
*slots*, each of which says in which sequences and at which offset the pieces of one length
and of a range of ranks go. Pieces are ranked within (length, bucket), so that a length that
a third of all documents share is many groups, and meet their slots in a broadcast join. The
token ids are shuffled once.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import documents, pieces, shown_id, stored

WINDOW = 1024
#: Most lengths in one combination.
DEPTH = 3
#: Rows of one (length, bucket) group, about.
BUCKET_ROWS = 2000
#: Most slots that are broadcast (under 80 bytes each); beyond, the join shuffles.
BROADCAST_SLOTS = 200_000
#: The fit ends when this share of the pieces is unexplained.
UNEXPLAINED = 0.05
_MAX_VOCABULARY_BYTES = 64_000_000


class Slot(NamedTuple):
    """Pieces of ``length`` with ranks ``low`` to ``high`` (not included): their tokens from
    ``cut`` on, ``size`` of them, are at ``offset`` of the sequences from ``sequence`` on."""

    length: int
    low: int
    high: int
    cut: int
    size: int
    sequence: int
    offset: int


# Tokens


def byte_of_letter() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_of(path: str) -> dict[bytes, int]:
    """Entries and ids of a byte-level BPE file of the tokenizers library whose ids follow its merges."""
    with open(path, encoding="utf-8") as f:
        text = f.read(_MAX_VOCABULARY_BYTES + 1)
    if len(text) > _MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary file is over {_MAX_VOCABULARY_BYTES} characters")
    model, letters = json.loads(text)["model"], byte_of_letter()
    vocab = model["vocab"]
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        raise ValueError("the ids of the vocabulary do not follow its merges")
    return {bytes(letters[c] for c in token): i for token, i in vocab.items()}


class Encoder:
    """Texts to packed ids; what the fast coder's pattern search cannot hold (very long runs of
    white space) takes the linear-time coder of the same entries."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern, self.slow = ranks, pattern, None
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.kind = np.dtype("<u2" if max(ranks.values()) < 1 << 16 else "<u4")

    def ids(self, text: str) -> np.ndarray:
        """The text's ids, little-endian, of 2 or 4 bytes."""
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(self.kind)
        except ValueError:  # the search ran out of stack
            self.slow = self.slow or bpe.Coder(bpe.vocabulary(self.ranks, self.pattern))
            return self.slow.encode(text).astype(self.kind)


class Vocabulary(NamedTuple):
    ranks: dict[bytes, int]
    pattern: str

    @property
    def width(self) -> int:
        return 2 if max(self.ranks.values()) < 1 << 16 else 4


_ENCODERS: dict[str, Encoder] = {}


def cut_pieces(docs: DataFrame, vocabulary: Vocabulary, window: int, end_id: int) -> DataFrame:
    """(id, text_key, start, length, doc_tokens, spread, ids): every document's full windows and its rest.

    ``spread`` numbers the pieces of a task; written once, it deals them into buckets.
    """
    shared, key, width = docs.sparkSession.sparkContext.broadcast(tuple(vocabulary)), f"{hash(vocabulary.pattern)} {len(vocabulary.ranks)}", vocabulary.width
    end = end_id.to_bytes(width, "little")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = Encoder(*shared.value)
        encoder, spread = _ENCODERS[key], 0
        for b in pieces(batches, 256):
            rows = []
            for i, k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                ids = encoder.ids(text).tobytes() + end
                n = len(ids) // width
                for at in range(0, n, window):
                    part = ids[width * at : width * (at + window)]
                    rows.append((i, k, at, len(part) // width, n, spread, part))
                    spread += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = ["id", "text_key", "start", "length", "doc_tokens", "spread", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return docs.mapInArrow(mapped, "id long, text_key long, start long, length int, doc_tokens long, spread long, ids binary")


# Lengths


def combinations(present: np.ndarray, window: int, depth: int = DEPTH) -> np.ndarray:
    """All rising combinations of up to ``depth`` (1 to 3) present lengths that fill the window; 0: none."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    out = [np.array([[0, 0, window]])] if has[window] else []
    if depth > 1:
        a = np.arange(1, window // 2 + 1)
        a = a[has[a] & has[window - a]]
        out.append(np.stack([np.zeros_like(a), a, window - a], axis=1))
    if depth > 2:
        for a in np.flatnonzero(has[: window // 3 + 1]):
            b = np.arange(a, (window - a) // 2 + 1)
            b = b[has[b] & has[window - a - b]]
            out.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), int)


def fitted_counts(columns: np.ndarray, histogram: np.ndarray, rounds: int = 3000) -> dict[int, float]:
    """Non-negative repeat counts of the combinations, least squares to the histogram.

    The active-set method: the combination with the steepest gain enters, those that would
    turn negative leave. The inverse of the active combinations' Gram matrix is kept and
    updated by bordering, so a round costs the square of their number.
    """
    scale = max(float(histogram.max()), 1.0)
    h = histogram / scale
    h[0] = 0.0
    active: list[int] = []
    barred: set[int] = set()
    inverse, x = np.zeros((0, 0)), np.zeros(0)
    m = len(columns)
    allowed = np.ones(m, bool)
    target = h[columns].sum(axis=1)  # each combination's product with the histogram
    row = np.zeros(len(h))

    def products(j: int, others: list[int]) -> np.ndarray:
        np.add.at(row, columns[j], 1.0)
        row[0] = 0.0
        out = row[columns[others]].sum(axis=1) if others else np.zeros(0)
        row[columns[j]] = 0.0
        return out

    for _ in range(rounds if m else 0):
        left = h.copy()
        for k in range(3):
            np.subtract.at(left, columns[active, k], x)
        left[0] = 0.0
        if np.abs(left).sum() <= UNEXPLAINED * h.sum():
            break
        gain = np.where(allowed, left[columns].sum(axis=1), -np.inf)
        j = int(gain.argmax())
        if gain[j] <= 1e-9:
            break
        b, own = products(j, active), float(products(j, [j])[0])
        u = inverse @ b
        pivot = own - b @ u
        allowed[j] = False
        if pivot < 1e-6:  # made of the active ones
            barred.add(j)
            continue
        n = len(active)
        grown = np.empty((n + 1, n + 1))
        grown[:n, :n] = inverse + np.outer(u, u) / pivot
        grown[n, :n] = grown[:n, n] = -u / pivot
        grown[n, n] = 1 / pivot
        inverse, active, x = grown, [*active, j], np.append(x, 0.0)
        while True:
            want = inverse @ target[active]
            if (want > 0).all():
                x = want
                break
            low = want <= 0
            step = float((x[low] / np.maximum(x[low] - want[low], 1e-300)).min())
            x = x + step * (want - x)
            out = int(np.where(low, x, np.inf).argmin())
            keep = np.arange(len(active)) != out
            v = inverse[keep, out]
            inverse = inverse[np.ix_(keep, keep)] - np.outer(v, v) / inverse[out, out]
            gone = active.pop(out)
            x = np.maximum(x[keep], 0.0)
            if gone != j:
                allowed[gone] = True
            allowed[list(barred)] = True
            barred.clear()
    return {j: float(v) * scale for j, v in zip(active, x)}


class Shelf:
    """Pieces by length as ranges of ranks; what is taken becomes slots."""

    def __init__(self, histogram: np.ndarray):
        self.count = histogram.astype(np.int64).copy()
        self.ranges = defaultdict(deque)
        for n in np.flatnonzero(self.count):
            self.ranges[int(n)].append((int(n), 0, int(self.count[n]), 0))
        self.slots: list[Slot] = []
        self.sequences = 0

    def take(self, length: int, n: int, offset: int, size: int | None = None) -> None:
        """One piece of ``length`` for each of the next ``n`` sequences; cut to ``size`` if given."""
        size = length if size is None else size
        sequence, self.count[length] = self.sequences, self.count[length] - n
        while n:
            of, low, high, cut = self.ranges[length].popleft()
            some = min(n, high - low)
            if low + some < high:
                self.ranges[length].appendleft((of, low + some, high, cut))
            self.slots.append(Slot(of, low, low + some, cut, size, sequence, offset))
            if size < length:
                self.ranges[length - size].append((of, low, low + some, cut + size))
                self.count[length - size] += some
            sequence, n = sequence + some, n - some

    def repeat(self, shape: list[tuple[int, int]], n: int) -> None:
        """``n`` sequences of one shape: pairs of a piece's length and the part of it that is taken."""
        offset = 0
        for length, size in shape:
            self.take(length, n, offset, size)
            offset += size
        self.sequences += n


def pack_lengths(histogram: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> tuple[list[Slot], int]:
    """Slots for all pieces of a histogram of lengths 1 to ``window``, and the number of sequences."""
    shelf = Shelf(histogram)
    columns = combinations(np.flatnonzero(histogram), window, depth)
    counts = fitted_counts(columns, histogram.astype(float))
    for j, x in sorted(counts.items(), key=lambda c: (-c[1], c[0])):
        shape = [int(n) for n in columns[j] if n]
        n = min([round(x), *(int(shelf.count[k]) // shape.count(k) for k in set(shape))])
        if n > 0:
            shelf.repeat([(k, k) for k in shape], n)
    lengths, unit = np.arange(window + 1), 1 << int(shelf.count.max()).bit_length()
    # Pieces go in lots, ever smaller ones, so that the number of slots does not grow with that of the pieces.
    while (total := int(shelf.count @ lengths)) > 0:
        left, shape, free = min(window, total), [], shelf.count // unit
        if int(free @ lengths) < left:
            unit //= 2
            continue
        while left:
            fits = np.flatnonzero(free[: left + 1])
            if len(fits):
                k = int(fits[-1])
                n = min(left // k, int(free[k]))
                shape += [(k, k)] * n
                free[k] -= n
                left -= n * k
            else:
                k = left + 1 + int(np.flatnonzero(free[left + 1 :])[0])
                shape.append((k, left))
                left = 0
        used = [k for k, _ in shape]
        shelf.repeat(shape, min(int(shelf.count[k]) // used.count(k) for k in set(used)))
    return shelf.slots, shelf.sequences


# Sequences


def padding(length: int, window: int = WINDOW) -> int:
    """Pads behind ``length`` tokens: up to the window, none at a power of two."""
    return 0 if length & (length - 1) == 0 else window - length


def pack(
    docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 0, depth: int = DEPTH
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids), one row per piece.

    A document is its text's ids and ``end_id``. ``ids`` are the piece's, little-endian, of
    2 bytes each (4 if the vocabulary has more than 65,536 entries). A sequence's pieces follow
    each other without a gap from offset 0; only the last sequence of all may have room left.
    Null and empty texts are the end id alone; repeated rows are documents of their own; a
    null id is shown as null; an empty table gives no piece.
    """
    spark, width = docs.sparkSession, vocabulary.width
    every = stored(cut_pieces(documents(docs, id_col, text_col), vocabulary, window, end_id), "pieces")
    rests = every.where(F.col("length") < window)
    # One number per length, whatever the data.
    found = rests.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = np.zeros(window + 1, np.int64)
    for r in found:
        histogram[r["length"]] = r["n"]
    slots, n_sequences = pack_lengths(histogram, window, depth)
    # As many buckets for each length as its pieces need.
    buckets = F.array(*[F.lit(int(n)) for n in -(-np.maximum(histogram, 1) // BUCKET_ROWS)])
    bucket = F.pmod("spread", F.get(buckets, F.col("length"))).alias("bucket")
    sizes = rests.select("length", bucket).groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("length", "bucket").orderBy("spread", "id", "start", "text_key", "ids")
    ranked = rests.select("*", bucket).withColumn("row", F.row_number().over(order)).join(firsts, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("first") + F.col("row") - 1)
    rows = pd.DataFrame(slots or [Slot(*[0] * 7)], columns=Slot._fields).add_prefix("s_")
    table = spark.createDataFrame(rows)
    if len(slots) <= BROADCAST_SLOTS:
        table = F.broadcast(table)
    put = ranked.join(table, (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("s_low")) & (F.col("rank") < F.col("s_high")))
    part = F.expr(f"substring(ids, cast(s_cut * {width} + 1 AS int), cast(s_size * {width} AS int))")
    packed = put.select(
        shown_id().alias("doc_id"), (F.col("start") + F.col("s_cut")).alias("start"), F.col("s_size").alias("length"), "doc_tokens",
        (F.col("s_sequence") + F.col("rank") - F.col("s_low")).alias("sequence_id"), F.col("s_offset").alias("offset"), part.alias("ids"),
    )
    # Full windows stay where they are; their numbers follow those of the packed sequences.
    full = every.where(F.col("length") == window).select(
        shown_id().alias("doc_id"), "start", F.col("length").cast("long").alias("length"), "doc_tokens",
        (F.monotonically_increasing_id() + n_sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids",
    )
    return packed.union(full)


def digests(packed: DataFrame, width: int) -> DataFrame:
    """``pack``'s rows with the CRC-32 of the ids as 32-bit numbers in place of the ids."""
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
    kind = np.dtype(f"<u{width}")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 4096):
            sums = [crc32(np.frombuffer(v.as_buffer(), kind).astype("<u4").tobytes()) for v in b.column(6)]
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(sums, pa.int64())], names)

    return packed.mapInArrow(mapped, ", ".join(f"{n} long" for n in names))


def id_arrays(packed: DataFrame, width: int) -> DataFrame:
    """``pack``'s rows with ``ids`` as array<int>."""
    kind = np.dtype(f"<u{width}")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1024):
            raw = [v.as_py() for v in b.column(6)]
            ends = np.cumsum([0, *(len(v) // width for v in raw)]).astype(np.int32)
            flat = np.frombuffer(b"".join(raw), kind).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], b.schema.names)

    return packed.mapInArrow(mapped, ", ".join(f"{n} long" for n in packed.columns[:6]) + ", ids array<int>")
