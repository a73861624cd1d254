"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

The SimHash operator links first: four five-word fingerprints of 32 bits a document (shorter
than its own 64, as at 0.8 about every seventh bit differs), covered by anchor points and
linked at 2 bits as in ``simhash``. Every link is confirmed on the exact sets, so none is wrong.

No fingerprint is sure to find a pair at 0.8, so the pairs between the components that are left
come exactly, by prefixes. In any one order of all shingles, two sets of a <= b shingles at 0.8,
which have 4 (a + b) / 9 of them in common, have their first common one among the first a / 9
of the smaller and the first b / 5 of the larger set, and enough must follow it in both. The order
is that of the hashes, but common shingles come last: those that over ``LIGHT`` sets have among
the first 3/10 of their hashes. A set whose first fifth holds none is plain, and its pairs with
others come from a join by shingle that meets at most ``LIGHT`` plain sets.

The few others, mostly made of common text, are joined with each other by rising frequency;
shingles of one component only come first, as they link nothing new. Text that many documents
share is never that early in sets that have much of their own.
Members of one component that agree in shingle, size and place are one row until that test is
passed. Pairs come from joins, and none within a component is formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .common import documents, pieces, raw_texts, stored
from .simhash import components, first_documents, only, shingles

SHINGLE_WORDS = 5
#: Least similarity, as a fraction.
PART, WHOLE = 4, 5
#: Seeds of the operator's fingerprints; each is taken as two of ``WIDTH`` bits.
SEEDS, WIDTH = (42, 43), 32
#: Shingles that more sets have among their early ones come last in the order.
LIGHT = 16


def shingle_set(raw: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; fewer words: the whole sequence; no word: empty."""
    words = raw.lower().split()
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles(words, size)), np.uint64))


def prints(raw: bytes) -> np.ndarray:
    """The text's fingerprints of ``WIDTH`` bits, each with its number above them."""
    halves = np.array(simhash.fingerprint(raw, SHINGLE_WORDS, SEEDS), np.uint64).view(np.uint32).astype(np.int64)
    return halves | np.arange(len(halves), dtype=np.int64) << WIDTH


def early(s: np.ndarray) -> np.ndarray:
    """The first shingles by hash: a fifth of them, and a tenth in place of common ones."""
    return s[: 3 * len(s) // 10 + 1]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return WHOLE * both >= PART * (len(a) + len(b) - both)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        sets = [shingle_set(t) for t in raw_texts(b.column(2))]
        digests = np.array([divmod(xxhash.xxh128_intdigest(s.tobytes()), 2**64) for s in sets], np.uint64).reshape(-1, 2)
        fps = [prints(t) for t in raw_texts(b.column(2))]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), *(pa.array(np.ascontiguousarray(digests[:, k]).view(np.int64)) for k in (0, 1)),
             pa.array([len(s) for s in sets], pa.int32()), pa.array(fps, pa.list_(pa.int64())),
             pa.array([early(s).view(np.int64) for s in sets], pa.list_(pa.int64()))],
            ["id", "text_key", "d0", "d1", "n", "fps", "early"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        sets = [shingle_set(t).tobytes() for t in raw_texts(b.column(1))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["node", "set"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        x, y = ([np.frombuffer(v, np.uint64) for v in b.column(k).to_pylist()] for k in (2, 3))
        yield b.select(["a", "b"]).filter(pa.array([similar(*p) for p in zip(x, y)], pa.bool_()))


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shingle of each set."""
    for b in pieces(batches, 64):
        sets = [np.frombuffer(v, np.int64) for v in b.column(3).to_pylist()]
        times = pa.array(np.repeat(np.arange(b.num_rows), [len(s) for s in sets]))
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([*(b.column(k).take(times) for k in range(3)), pa.array(flat)], ["node", "root", "n", "h"])


def prefixes(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(h, n, at, root, node, lead): the shingles of each member (node, root, n) by which a partner in
    another component can be found, ``at`` their place in the order of rising frequency; ``lead``:
    also as the smaller set."""
    held = members.join(sets, "node").select("node", "root", "n", "set")
    rows = stored(held.mapInArrow(_shingle_rows, "node long, root long, n int, h long"), "shingles")
    often = rows.groupBy("h").agg(F.count(F.lit(1)).alias("often"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    common = rows.join(often.select("h", "often"), "h")
    node = Window.partitionBy("node")
    # Before the common ones come those of this component alone.
    at = F.col("n") - F.count(F.lit(1)).over(node) + F.row_number().over(node.orderBy("often", "h")) - 1
    placed = common.select("h", "n", "root", "node", at.alias("at"))
    least = {name: F.ceil(F.col("n") * part / whole) for name, part, whole in (("probe", PART, WHOLE), ("lead", 2 * PART, WHOLE + PART))}
    return placed.where(F.col("at") <= F.col("n") - least["probe"]).withColumn("lead", F.col("at") <= F.col("n") - least["lead"])


def prefix_candidates(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): all pairs of members of different components that can reach the similarity."""
    found = stored(prefixes(members, sets), "prefixes")
    key = ["h", "n", "at", "root"]
    smaller = found.where("lead").select(*key).distinct()
    larger = found.select("h", F.col("n").alias("m"), F.col("at").alias("there"), F.col("root").alias("other"), F.col("node").alias("b"))
    need = f"ceil({PART} * (n + m) / {WHOLE + PART}D)"
    met = smaller.join(larger, "h").where("root <> other").where(f"n <= m AND {WHOLE} * n >= {PART} * m").where(f"least(n - at, m - there) >= {need}")
    pairs = met.select(*key, "b").join(found.where("lead").select(*key, F.col("node").alias("a")), key)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): candidates by the SimHash operator, at most two per node and fingerprint.

    Each distinct fingerprint has one owner, to which its other nodes are paired; of its links
    by anchors it keeps that with the least partner.
    """
    rows = nodes.where("n > 0").select(F.explode("fps").alias("fp"), F.struct("node", "n").alias("one"))
    owners = stored(rows.groupBy("fp").agg(F.min("one").alias("owner")), "owners")
    found = simhash.links(owners.select("fp"), width=WIDTH).groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("b"))
    near = found.join(owners, "fp").select(F.col("owner").alias("one"), F.col("b").alias("fp"))
    met = rows.union(near.select("fp", "one")).join(owners, "fp").where("one.node <> owner.node")
    # Sets whose sizes differ by more than the similarity are no candidates.
    met = met.where(f"{WHOLE} * least(one.n, owner.n) >= {PART} * greatest(one.n, owner.n)")
    return met.select(F.least("one.node", "owner.node").alias("a"), F.greatest("one.node", "owner.node").alias("b")).distinct()


def plain_pairs(plain: DataFrame, others: DataFrame) -> DataFrame:
    """(a, b): pairs of different components that can reach the similarity by a common early shingle;
    both frames: (h, n, at, node, root, short)."""
    x, y = plain.alias("x"), others.alias("y")
    met = x.join(y, F.col("x.h") == F.col("y.h")).where("x.root <> y.root AND (y.short OR x.node < y.node)")
    met = met.where(f"{WHOLE} * least(x.n, y.n) >= {PART} * greatest(x.n, y.n)")
    met = met.where(f"least(x.n - x.at, y.n - y.at) >= ceil({PART} * (x.n + y.n) / {WHOLE + PART}D)")
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): confirmed links between ``nodes`` (node, least, n, fps, early); ``docs`` has their texts."""

    def sets_of(some: DataFrame, name: str) -> DataFrame:
        held = stored(some.select("node").distinct().join(nodes.select("node", "least.*"), "node"), "held")
        texts = docs.join(held, ["id", "text_key"]).select("node", "text").mapInArrow(_sets, "node long, set binary")
        return stored(texts.groupBy("node").agg(F.first("set").alias("set")), name)

    def confirmed(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        x, y = sets.select(F.col("node").alias("a"), F.col("set").alias("x")), sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
        both = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        return stored(both.mapInArrow(_confirmed, "a long, b long"), name)

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))

    rows = nodes.select("node", "n", F.posexplode("early").alias("place", "h"))
    often = stored(rows.groupBy("h").agg(F.count(F.lit(1)).alias("many")).where("many > 1"), "often")
    common = often.where(F.col("many") > LIGHT).select("h")
    own = Window.partitionBy("node")
    held_back = (F.col("many") > LIGHT).cast("int")
    shared = rows.join(often, "h").withColumn("late", F.sum(held_back).over(own))
    shared = shared.withColumn("at", F.col("place") - F.sum(held_back).over(own.orderBy("place")))
    probe = f"n - ceil({PART} * n / {WHOLE}D)"
    # Short: what is not common among the early ones does not fill the first fifth.
    shared = stored(shared.withColumn("short", F.expr(f"3 * n div 10 + 1 - late <= {probe}")), "shared")
    short = shared.where("short").select("node", "n").distinct()

    printed = stored(fingerprint_pairs(nodes), "printed")
    sets = sets_of(ends(printed).union(short.select("node")), "sets")
    first = confirmed(printed, sets, "linked")
    roots = stored(components(first), "roots")

    def rooted(some: DataFrame) -> DataFrame:
        return some.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    left = stored(rooted(short), "short")
    # The first shingles of the short ones that are not common, from their whole sets.
    held = left.join(sets, "node").select("node", "root", "n", "set").mapInArrow(_shingle_rows, "node long, root long, n int, h long")
    at = F.row_number().over(own.orderBy("h")) - 1
    other = stored(held.join(common, "h", "left_anti").withColumn("at", at).where(f"at <= {probe}").withColumn("short", F.lit(True)), "firsts")
    plain = rooted(shared.where(F.col("many") <= LIGHT).where(f"NOT short AND at <= {probe}").drop("late", "many", "place"))
    # What a plain set shares with the later hashes of a short one only; its place is not known, so no bound.
    late = rows.join(other.select("h").distinct(), "h").join(left.select("node"), "node", "left_anti").join(often, "h", "left_anti")
    late = rooted(late.select("node", "n", "h", F.lit(0).alias("at"), F.lit(False).alias("short")))
    columns = ["h", "n", "at", "node", "root", "short"]
    plain = stored(plain.select(columns).union(late.select(columns)), "plain")
    pairs = plain_pairs(plain, plain.union(other.select(columns))).union(prefix_candidates(left, sets))
    pairs = stored(pairs.distinct(), "pairs")
    more = sets_of(ends(pairs).join(sets, "node", "left_anti"), "more")
    return first.union(confirmed(pairs, sets.union(more), "crossed"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of near copies, that of the least (id, text key).

    Case and white space do not count; texts without a word are copies of each other; a null
    id counts as the smallest; rows that share only the id are documents of their own.
    """
    texts = documents(docs, id_col, text_col)
    sketches = texts.mapInArrow(_sketches, "id long, text_key long, d0 long, d1 long, n int, fps array<long>, early array<long>")
    least = F.struct("id", "text_key")
    nodes = sketches.groupBy("d0", "d1").agg(F.min(least).alias("least"), F.first("n").alias("n"), F.min_by("fps", least).alias("fps"), F.first("early").alias("early"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    rooted = first_documents(nodes.select("node", "least"), components(links(nodes, texts)))
    return only(docs, rooted.select("first.id", "first.text_key").distinct(), id_col, text_col)
