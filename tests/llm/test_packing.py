"""Packing: ids against the tokenizers library, every id in one piece, fits and hot lengths by brute force."""

from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loadloom.llm import packing, queries

from .conftest import ODD


@pytest.fixture(scope="module")
def vocabulary():
    return queries.packed_vocabulary()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path(queries.PACKED_FILE))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizers_library(spark, small, vocabulary, library):
    encoder = packing.Encoder(*vocabulary)
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()] + [t or "" for _, t in ODD]
    texts += ["".join(map(chr, range(a, min(a + 4096, 0x110000)))) for a in [*range(0, 0xD000, 4096), *range(0xE000, 0x20000, 4096)]]
    texts += ["a\n \nb", "a  ", "   x", "<|endoftext|> x", "it's we'LL 12 345", "\x0b\x0c  　y", "a" * 3000, "\t \t x \r\n\r\n y"]
    for t in texts:
        assert encoder.ids(t).tolist() == library(t), t[:60]


def test_long_white_space_takes_the_linear_coder(vocabulary):
    encoder = packing.Encoder(*vocabulary)
    text = "a" + " " * 1_500_000 + "b"
    ids = encoder.ids(text)
    back = {i: t for t, i in vocabulary.ranks.items()}
    assert encoder.slow is not None and b"".join(back[i] for i in ids.tolist()) == text.encode()


def rebuilt(rows, want):
    """Checks the pieces of all documents against their ids; gives the sequences' lengths."""
    of, at = defaultdict(list), defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
        at[r.sequence_id].append((r.offset, r.length))
    assert set(of) == set(want)
    for d, parts in of.items():
        ids, parts = want[d], sorted(parts, key=lambda r: r.start)
        assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist()
        assert sum(r.length for r in parts) == len(ids) and {r.doc_tokens for r in parts} == {len(ids)}
        for r in parts:
            piece = ids[r.start : r.start + r.length]
            if hasattr(r, "ids_crc32"):
                assert r.ids_crc32 == crc32(np.array(piece, "<u4").tobytes())
            else:
                assert list(r.ids) == piece
    lengths = []
    for parts in at.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist()
        lengths.append(sum(n for _, n in parts))
    return lengths


def test_query_packs_every_id_once(spark, small, library):
    want = {r.doc_id: [*library(r.text), 0] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    lengths = rebuilt(queries.op11_packing(spark, small).collect(), want)
    assert max(lengths) <= 1024 and sum(n < 1024 for n in lengths) <= 1
    assert sum(map(packing.padding, lengths)) < 0.01 * sum(lengths)


def test_odd_rows_and_small_windows(docs, vocabulary, library):
    data = [(i, t) for i, (_, t) in enumerate(ODD)]
    found = packing.id_arrays(packing.pack(docs(data), vocabulary, window=16, end_id=7), vocabulary.width).collect()
    lengths = rebuilt(found, {d: [*library(t), 7] for d, t in data})
    assert max(lengths) <= 16 and sum(n < 16 for n in lengths) <= 1
    repeated = packing.pack(docs(ODD + [(1, None), (12, "same text twice")]), vocabulary).collect()
    assert len(repeated) == sum(-(-(len(library(t)) + 1) // 1024) for _, t in ODD) + 2 + sum(r.start % 1024 > 0 for r in repeated)
    assert packing.pack(docs([]), vocabulary).count() == 0


def test_a_length_of_many_documents_is_many_groups(docs, vocabulary, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    data = [(i, "one two three " * (10 if i % 3 else i % 40)) for i in range(400)]
    found = packing.pack(docs(data), vocabulary, window=64).collect()
    sizes = defaultdict(int)
    for r in found:
        sizes[r.sequence_id] += r.length
    assert sum(sizes.values()) == sum({r.doc_id: r.doc_tokens for r in found}.values()) and sum(n < 64 for n in sizes.values()) <= 1


@pytest.mark.parametrize("counts", [{}, {3: 1}, {1: 5000}, {700: 10**9 + 7, 701: 3 * 10**9 + 1}, {512: 10, 511: 3}, {1023: 5, 1: 2, 1000: 7}, "random", "vast"])
def test_slots_hold_every_piece_once(counts):
    h = np.zeros(1025, np.int64)
    if isinstance(counts, str):
        h[1:1024] = np.random.default_rng(4).integers(0, 9, 1023) ** (6 if counts == "vast" else 1)
    else:
        h[list(counts)] = list(counts.values())
    slots, n = packing.pack_lengths(h)
    taken, filled = defaultdict(list), 0
    for s in slots:
        assert 0 < s.size and s.cut + s.size <= s.length and 0 <= s.low < s.high <= h[s.length]
        taken[s.length].append(s)
        filled += s.size * (s.high - s.low)
        assert s.sequence + s.high - s.low <= n and s.offset + s.size <= 1024
    total = int(h @ np.arange(1025))
    assert filled == total and n == -(-total // 1024) and len(slots) < 20_000
    for length, some in taken.items():  # every token of every rank lies in exactly one slot
        edges = sorted({x for s in some for x in (s.low, s.high)})
        for a, b in zip(edges, edges[1:]):
            cuts = sorted((s.cut, s.size) for s in some if s.low <= a and b <= s.high)
            assert [c for c, _ in cuts] == np.cumsum([0, *(k for _, k in cuts)])[:-1].tolist() and sum(k for _, k in cuts) == length


def test_fit_is_a_least_squares_optimum(monkeypatch):
    monkeypatch.setattr(packing, "UNEXPLAINED", 0.0)
    rng = np.random.default_rng(5)
    h = np.append(0, rng.integers(0, 50, 24)).astype(float)
    columns = packing.combinations(np.flatnonzero(h), 24)
    assert {tuple(c) for c in columns.tolist()} == {
        (a, b, c) for a in range(25) for b in range(a, 25) for c in range(b, 25)
        if a + b + c == 24 and c and not (a and not b) and all(x == 0 or h[x] for x in (a, b, c))
    }
    x = packing.fitted_counts(columns, h)
    left = h.copy()
    for j, v in x.items():
        assert v >= 0
        for k in columns[j]:
            left[k] -= v * (k > 0)
    gain = np.where(columns > 0, left[columns], 0).sum(axis=1)
    assert gain.max() < 1e-6 and max(abs(gain[j]) for j in x) < 1e-6  # no combination would help, and none in use could change
