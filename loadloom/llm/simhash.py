"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a covering code: the perfect Hamming code of length 63, with the
64th bit free. Every 64-bit fingerprint is within one bit of an anchor (covering radius 1),
and the anchors near a fingerprint follow from its syndrome alone, so none is ever stored.

Two fingerprints within a threshold of t bits have a point between them at most ceil(t / 2)
bits from either; the anchor that covers that point is within ``1 + ceil(t / 2)`` of both.
Replicating every fingerprint to all anchors within that distance (the covering radius plus
each side's share of the threshold, 33 anchors for t = 2) therefore makes every linked
pair meet. An anchor's group can never pass the number of points that near it, 2,081 for
t = 2, whatever the data: no hot group exists, and the groups are compared as wholes.

Each anchor's group returns a spanning forest of its links, not its pairs; components come
from large-star and small-star rounds whose results are tables in the shared folder.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, pieces, raw_texts, shown_id, stored, whole_rows

SHINGLE_WORDS = 3
THRESHOLD = 2
RADIUS = 1
SEED = 42
_CHUNK = 1 << 16


def shingles(words: list[bytes], size: int) -> Iterator[bytes]:
    """Every run of ``size`` words, repeats included; fewer words: the whole sequence."""
    if len(words) < size:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(islice(words, i, None) for i in range(size))))


def fingerprint(raw: bytes, size: int = SHINGLE_WORDS, seeds: Sequence[int] = (SEED,)) -> list[int]:
    """One fingerprint per seed: bit i is set if it is set in over half of the shingles' XXH64
    values; no word: zero.

    ``bytes.lower`` and ``bytes.split`` know A-Z and the six ASCII spaces only, as wanted.
    """
    runs, total, ones = shingles(raw.lower().split(), size), 0, np.zeros((len(seeds), 64), np.int64)
    while part := list(islice(runs, _CHUNK)):
        total += len(part)
        for k, seed in enumerate(seeds):
            h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(seed)), np.uint64, len(part))
            ones[k] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return np.packbits(2 * ones > total, axis=1, bitorder="little").view(np.uint64)[:, 0].tolist()


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS, seeds: Sequence[int] = (SEED,)) -> DataFrame:
    """(id, text_key, fp0, fp1, ...), one fingerprint per seed, for every row of ``docs``."""
    names = [f"fp{k}" for k in range(len(seeds))]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            fps = np.array([fingerprint(t, size, seeds) for t in raw_texts(b.column(2))], np.uint64).reshape(-1, len(names))
            cols = [pa.array(np.ascontiguousarray(fps[:, k]).view(np.int64)) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], ["id", "text_key", *names])

    return docs.mapInArrow(mapped, "id long, text_key long, " + ", ".join(f"{n} long" for n in names))


@lru_cache
def anchor_masks(reach: int, width: int = 64) -> list[np.ndarray]:
    """For each syndrome (64 of them at 64 bits), the bit changes that lead to an anchor within ``reach``.

    Bit i < width - 1 has the check column i + 1 and the last bit none: a set of bits leads to
    an anchor exactly if its columns add up to the syndrome. ``width`` is a power of two.
    """
    found = defaultdict(list)
    for n in range(reach + 1):
        for bits in combinations(range(width), n):
            syndrome = 0
            for i in bits:
                syndrome ^= i + 1 if i < width - 1 else 0
            found[syndrome].append(sum(1 << i for i in bits))
    return [np.array(found[s], np.uint64) for s in range(width)]


def syndromes(fps: np.ndarray, width: int = 64) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for k in range(width.bit_length() - 1):
        check = np.uint64(sum(1 << i for i in range(width - 1) if (i + 1) >> k & 1))
        out |= (np.bitwise_count(fps & check) & 1).astype(np.int64) << k
    return out


def anchors(fps: np.ndarray, reach: int, width: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, fingerprint) for every anchor within ``reach`` of each fingerprint."""
    masks, own = anchor_masks(reach, width), syndromes(fps, width)
    a, f = [], []
    for s in np.unique(own):
        part = fps[own == s]
        a.append((part[:, None] ^ masks[s][None, :]).ravel())
        f.append(np.repeat(part, len(masks[s])))
    return np.concatenate(a), np.concatenate(f)


def forest(group: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """(fingerprint, least of its component) within one anchor's group, by breadth-first search."""
    left, out = np.sort(group), []
    while len(left) > 1:
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for f in front:
                near |= np.bitwise_count(left ^ f) <= threshold
            front, left = left[near], left[~near]
            out += [(int(f), int(root)) for f in front]
    return out


def links(fps: DataFrame, threshold: int = THRESHOLD, reach: int | None = None, width: int = 64) -> DataFrame:
    """(a, b): links whose components are those of all pairs within ``threshold`` bits.

    ``fps`` has one row per distinct fingerprint in column ``fp``. ``reach`` may be given to
    widen the replication; the links stay the same. Fingerprints of fewer bits, ``width`` a
    power of two, may hold a number above them: only those with the same number are linked.
    """
    reach = RADIUS + -(-threshold // 2) if reach is None else reach

    def replicated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 4096):
            a, f = anchors(b.column(0).to_numpy().view(np.uint64), reach, width)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(f.view(np.int64))], ["anchor", "fp"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1024):
            found = [e for g in b.column(0).to_pylist() for e in forest(np.array(g, np.int64).view(np.uint64), threshold)]
            e = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(e[:, 0])), pa.array(np.ascontiguousarray(e[:, 1]))], ["a", "b"])

    # A count of partitions that stays, by another key than the grouping's: small partitions that
    # are joined before the replication make few tasks of its many rows.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = fps.select("fp").repartition(parts, F.xxhash64("fp")).mapInArrow(replicated, "anchor long, fp long")
    groups = near.groupBy("anchor").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")
    return groups.mapInArrow(compared, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the least node of each component, for nodes that have a link.

    Large-star and small-star rounds; each result is a stored table, so lost executors cost
    one round. Minimums combine before the shuffle; joins leave hubs to the skew split.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))

    def signature(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    mark = signature(e)
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = least(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e = stored(small.where("u <> v").distinct(), "stars")
        if (now := signature(e)) == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS, threshold: int = THRESHOLD,
    seeds: Sequence[int] = (SEED,),
) -> DataFrame:
    """(id, text_key, fp0, ..., component_id, first_key), one row per input row.

    Documents are linked if the fingerprints of any one seed differ in at most ``threshold``
    bits. One seed is the plain operator; each further seed is another independent chance
    for a near copy whose bits happen to differ. ``component_id`` is the least id reachable
    over links, itself included, and ``first_key`` the least text key under it. Texts without a word (null, empty, blank) have the
    fingerprint zero and are linked like any other. Repeated rows share a fingerprint and so
    a component. A null id counts as the smallest.
    """
    names = [f"fp{k}" for k in range(len(seeds))]
    marked = stored(fingerprints(documents(docs, id_col, text_col), size, seeds), "fingerprints")
    # A node is a set of fingerprints under a number of its own; ids name documents, not nodes.
    nodes = marked.groupBy(*names).agg(F.min(F.struct("id", "text_key")).alias("least"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    edges = []
    for name in names:
        owners = nodes.groupBy(F.col(name).alias("fp")).agg(F.min("node").alias("owner"))
        if len(names) > 1:  # several nodes may share this fingerprint
            owners = stored(owners, "owners")
            same = nodes.join(owners, nodes[name] == owners.fp).where("node <> owner")
            edges.append(same.select(F.col("node").alias("a"), F.col("owner").alias("b")))
        found = links(owners, threshold)
        named = owners.select(F.col("fp").alias("a"), F.col("owner").alias("_a"))
        other = owners.select(F.col("fp").alias("b"), F.col("owner").alias("_b"))
        edges.append(found.join(named, "a").join(other, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    rooted = first_documents(nodes, components(reduce(DataFrame.union, edges)))
    return marked.join(rooted.select(*names, F.col("first.id").alias("component_id"), F.col("first.text_key").alias("first_key")), names)


def first_documents(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``nodes`` with ``first``, the least (id, text_key) of the component, beside its own ``least``."""
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rooted.join(rooted.groupBy("root").agg(F.min("least").alias("first")), "root")


def result(found: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id; a null id is shown as null."""
    return found.select(
        shown_id().alias("doc_id"), F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"),
        shown_id("component_id").alias("component_id"),
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component, that of the least id; all columns kept.

    Rows that share only this id are documents of their own: the least text key decides
    within a component, and repeated rows stay once.
    """
    found = near_duplicates(docs, id_col, text_col, **how)
    firsts = found.where("id = component_id AND text_key = first_key").select("id", "text_key").distinct()
    return only(docs, firsts, id_col, text_col)


def only(docs: DataFrame, firsts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` named by (id, text_key) in ``firsts``, each once, all columns kept."""
    rows = whole_rows(docs, id_col, text_col).drop("text").join(firsts, ["id", "text_key"]).dropDuplicates(["id", "text_key"])
    return rows.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])
