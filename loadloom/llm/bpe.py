"""Byte-level BPE encoding and decoding with the exact merges, in linear time.

Bytes are mapped to Latin-1 characters so that an Aho-Corasick automaton over characters
finds every vocabulary entry in a piece. Encoding starts from the longest entry at each
position and backtracks to shorter ones; an entry may follow another only if merging the
bytes of both keeps them apart. That test walks down the two entries' merges, and its
outcome is memoised per pair. The one sequence in which all neighbours are compatible is
the sequence the merges give.

The vocabulary file is read by the driver from a path that is a parameter, checked for
size, and broadcast.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, StructField, StructType

from .common import pick, pieces, raw_texts

#: Broadcast bounds: bytes of the vocabulary file, and kept results per Python worker.
MAX_VOCABULARY_BYTES = 64_000_000
MAX_KEPT_PIECES = 600_000
MAX_KEPT_BYTES = 48


class Vocabulary(NamedTuple):
    """Entries by id; ``left``/``right``: the pair whose merge makes an entry (-1: none);
    ``shorter``: the longest entry that is a proper prefix (-1: none)."""

    tokens: list[bytes | None]
    left: np.ndarray
    right: np.ndarray
    shorter: np.ndarray
    pattern: str


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary file is over {MAX_VOCABULARY_BYTES} bytes")
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Pairs:
    """Memoised answer to: may entry ``b`` directly follow entry ``a``?"""

    def __init__(self, left, right):
        self.left, self.right = left, right
        self.merged: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}

    def __call__(self, a: int, b: int) -> bool:
        if (a, b) not in self.known:
            if len(self.known) > 1_000_000:
                self.known.clear()
            self.known[a, b] = self._apart(a, b)
        return self.known[a, b]

    def _apart(self, a: int, b: int) -> bool:
        """Undo the merges of both from the latest on; the parts that touch must never merge
        at a rank below that of the merge just undone."""
        limit = len(self.left)
        while True:
            if self.merged.get((a, b), limit) < limit:
                return False
            # Equal ranks merge from the left, so the right entry is undone first then.
            if a > b:
                if self.left[a] >= 0:
                    limit, a = a, self.right[a]
                elif self.left[b] >= 0:
                    limit, b = b + 1, self.left[b]
                else:
                    return True
            elif self.left[b] >= 0:
                limit, b = b + 1, self.left[b]
            elif self.left[a] >= 0:
                limit, a = a, self.right[a]
            else:
                return True


def vocabulary(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
    """The merges behind the ranks: each entry is split where its two parts, both of lower
    rank, stay apart until they merge. Entries no merge makes keep -1 and are only used for
    a piece that equals them."""
    size = max(ranks.values()) + 1
    tokens: list[bytes | None] = [None] * size
    left, right, shorter = ([-1] * size for _ in range(3))
    apart = Pairs(left, right)
    for token, i in sorted(ranks.items(), key=lambda x: x[1]):
        tokens[i] = token
        prefixes = [p for n in range(len(token) - 1, 0, -1) if (p := ranks.get(token[:n])) is not None]
        shorter[i] = prefixes[0] if prefixes else -1
        for p in prefixes:
            rest = ranks.get(token[len(tokens[p]) :] if tokens[p] is not None else b"")
            if tokens[p] is not None and rest is not None and max(p, rest) < i and apart(p, rest):
                left[i], right[i] = p, rest
                apart.merged[p, rest] = i
                apart.known.clear()
                break
    return Vocabulary(tokens, np.array(left), np.array(right), np.array(shorter), pattern)


class Coder:
    """Encoder and decoder of one Python worker."""

    def __init__(self, v: Vocabulary):
        self.tokens, self.shorter = v.tokens, v.shorter.tolist()
        self.sizes = [len(t) if t else 0 for t in v.tokens]
        self.find = regex.compile(v.pattern).findall
        left = v.left.tolist()
        self.apart = Pairs(left, v.right.tolist())
        self.apart.merged = {(a, b): i for i, (a, b) in enumerate(zip(left, v.right.tolist())) if a >= 0}
        self.whole = {t: i for i, t in enumerate(v.tokens) if t is not None}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.whole.items():
            if left[i] >= 0:
                self.automaton.add_word(t.decode("latin-1"), i)
        made = {i for i in self.whole.values() if self.sizes[i] == 1 or left[i] >= 0}
        # Prefixes that no merge makes are skipped once and for all.
        for i, p in enumerate(self.shorter):
            while p >= 0 and p not in made:
                p = self.shorter[p]
            self.shorter[i] = p
        self.automaton.make_automaton()
        self.single = [self.whole[bytes([b])] for b in range(256)]
        self.kept: dict[str, bytes] = {}
        self.entries = pa.array(v.tokens, pa.large_binary())
        self.decimals = pa.array([f"{i},".encode() for i in range(len(v.tokens))], pa.large_binary())

    def piece(self, raw: bytes) -> list[int]:
        """Ids of one piece: from the longest entries, back to shorter ones where needed."""
        if (i := self.whole.get(raw)) is not None:
            return [i]
        longest, sizes, shorter = list(map(self.single.__getitem__, raw)), self.sizes, self.shorter
        for end, i in self.automaton.iter(raw.decode("latin-1")):
            longest[end + 1 - sizes[i]] = i  # ends grow, so the longest comes last
        known, apart, size = self.apart.known, self.apart, len(raw)
        out, at, last, token, closed = [], 0, -1, longest[0], set()
        while True:
            end = at + sizes[token]
            if end not in closed:
                fits = last < 0 or known.get((last, token))
                if fits or (fits is None and apart(last, token)):
                    out.append(token)
                    if end == size:
                        return out
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token < 0:  # nothing fits here: this end is closed for good
                closed.add(at)
                token = out.pop()
                at -= sizes[token]
                last = out[-1] if out else -1
                token = shorter[token]

    def _kept(self, p: str) -> bytes:
        """A piece's ids as packed 32-bit numbers, kept for the next time."""
        raw = p.encode()
        packed = np.array(self.piece(raw), np.int32).tobytes()
        if len(raw) <= MAX_KEPT_BYTES:
            if len(self.kept) >= MAX_KEPT_PIECES:
                self.kept.clear()
            self.kept[p] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        get, miss = self.kept.get, self._kept
        return np.frombuffer(b"".join([get(p) or miss(p) for p in self.find(text)]), np.int32)

    def encode_column(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every text; a null text has none."""
        ids = [self.encode(t or "") for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    def _joined(self, ids: pa.ListArray, words: pa.Array) -> pa.Array:
        """For each list, the entries of ``words`` at its ids one after the other; null: null."""
        flat, ends = ids.flatten(), np.cumsum(np.append(0, pc.fill_null(pc.list_value_length(ids), 0).to_numpy()))
        taken = words.take(flat)
        starts = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
        data = taken.buffers()[2] if len(taken) else pa.py_buffer(b"")
        nulls = None if not ids.null_count else ids.is_valid().buffers()[1]
        bounds = pa.py_buffer(np.ascontiguousarray(starts[ends]).tobytes())
        return pa.Array.from_buffers(pa.large_binary(), len(ids), [nulls, bounds, data])

    def decode_column(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of every id list; an id outside the vocabulary is an error."""
        return self._joined(ids, self.entries)

    def text_column(self, ids: pa.ListArray) -> pa.Array:
        """The ids in decimal, each followed by a comma."""
        return self._joined(ids, self.decimals)


_CODERS: dict[str, Coder] = {}


def _coder(shared, key: str) -> Coder:
    """One coder per Python worker and vocabulary."""
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(shared.value)
    return _CODERS[key]


class Tokenizer:
    """Encodes and decodes columns; made on the driver from a rank file and a pattern."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.shared = spark.sparkContext.broadcast(vocabulary(read_ranks(path), pattern))
        self.key = f"{path}\n{pattern}"

    def encode(
        self, docs: DataFrame, text_col: str = "text", ids_col: str = "ids", check_col: str | None = None
    ) -> DataFrame:
        """``docs`` with the ids of each text appended as array<int>; null and empty texts: no id.

        ``check_col`` also appends whether the ids, decoded in the same pass, give the text's
        bytes again. A column that already has one of the names is replaced.
        """
        shared, key, names = self.shared, self.key, docs.columns
        at = names.index(text_col)
        flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])

        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = _coder(shared, key)
            for b in pieces(batches, 256):
                ids = coder.encode_column(b.column(at))
                cols = [*b.columns, ids]
                if check_col:
                    back = coder.decode_column(ids).to_pylist()
                    cols.append(pa.array([x == y for x, y in zip(back, raw_texts(b.column(at)))], pa.bool_()))
                yield pa.RecordBatch.from_arrays(cols, [*b.schema.names, *[f.name for f in added]])

        added = [StructField("_ids", ArrayType(IntegerType()))] + [StructField("_same", BooleanType())] * bool(check_col)
        out = flat.mapInArrow(mapped, StructType([*flat.schema, *added]))
        keep = [F.col(f"_c{i}").alias(c) for i, c in enumerate(names) if c not in (ids_col, check_col)]
        checked = [F.col("_same").alias(check_col)] if check_col else []
        return out.select(*keep, F.col("_ids").alias(ids_col), *checked)

    def decode(self, docs: DataFrame, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
        """``docs`` with the bytes of each id array appended as binary; null: null.

        An id outside the vocabulary is an error.
        """
        shared, key, names = self.shared, self.key, docs.columns
        at = names.index(ids_col)
        flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])

        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = _coder(shared, key)
            for b in pieces(batches, 256):
                raw = coder.decode_column(b.column(at)).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns, raw], [*b.schema.names, "_raw"])

        out = flat.mapInArrow(mapped, StructType([*flat.schema, StructField("_raw", BinaryType())]))
        keep = [F.col(f"_c{i}").alias(c) for i, c in enumerate(names) if c != out_col]
        return out.select(*keep, F.col("_raw").alias(out_col))


def digests(docs: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: every text is encoded and its ids are
    decoded in the same pass, so that neither ids nor texts leave the worker."""
    shared, key = tokenizer.shared, tokenizer.key

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, key)
        for b in pieces(batches, 256):
            ids = coder.encode_column(b.column(1))
            texts = [sha256(memoryview(t.as_buffer())[:-1]).hexdigest() for t in coder.text_column(ids)]
            bytes_ = [sha256(t.as_buffer()).hexdigest() for t in coder.decode_column(ids)]
            n = pc.list_value_length(ids).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n, pa.array(texts, pa.string()), pa.array(bytes_, pa.string())], names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(mapped, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
