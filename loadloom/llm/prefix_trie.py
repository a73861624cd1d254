"""The prefix trie of conversations, built as double-array tries over shards.

Equal conversations are first reduced to one sequence with a count, so groups of copies of any
size are one row. The distinct sequences are dealt into shards by ranges of their order, not
by a prefix: no first turn, however common, makes a large shard, and two neighbouring shards
share exactly the nodes on the common prefix of the last and the first sequence at their border.

Each shard packs one double array: dense turn ids are codes, a child of the node in slot s by
code c is in slot ``BASE[s] + c``, and ``CHECK`` there is s. Sequences are walked through it to
count members, and the nodes are summed up level by level. Only what is new in a shard counts
towards the sums over its nodes (a border node's turn, its edge from its parent, whether it is
childless), so the partial aggregates of border nodes can simply be added across shards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, pick, stored

#: Every conversation starts as the nearest one before it whose id is a multiple of this, for
#: fewer than so many turns.
FAMILY, SHARED_TURNS = 20, 4
#: Turns of distinct sequences in one shard, about.
SHARD_TURNS = 200_000
#: Ids are joined in blocks of this many consecutive ones before they are hashed.
_BLOCK_BITS = 10
#: Free slots that are tried for a node with several children before it goes to the end.
_TRIES = 64
_NO_END = sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turns): each conversation's (h0, h1, words) in order of turn, null first; equal
    turn numbers in order of their hashes."""
    rows = pick(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    words = F.regexp_count(text, F.lit(SPACE_CLASS.replace("[", "[^") + "+")).alias("words")
    kept = rows.select(F.col("conv").cast("long").alias("conv"), F.struct("turn", F.xxhash64(role, text).alias("h0"), F.xxhash64(F.lit(1), role, text).alias("h1"), words).alias("t"))
    return kept.groupBy("conv").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t.h0.alias("h0"), t.h1.alias("h1"), t.words.alias("words"))).alias("turns"))


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes over: the CRC-32 of its decimal id, modulo ``SHARED_TURNS``."""
    return (F.crc32(conv.cast("string").cast("binary")) % SHARED_TURNS).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, keys, words): the rebuilt conversations; ``keys`` has two hashes for each turn."""
    heads = turns.where(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("family"), F.slice("turns", 1, SHARED_TURNS - 1).alias("head"))
    own = turns.select("conv", "turns", shared_turns(F.col("conv")).alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("family"))
    both = own.join(heads, "family", "left")
    none = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    both = both.select("conv", F.concat(head, rest).alias("turns"))
    return both.select("conv", F.flatten(F.transform("turns", lambda t: F.array(t.h0, t.h1))).alias("keys"), F.transform("turns", lambda t: t.words).alias("words"))


class DoubleArray:
    """BASE and CHECK over dense codes from 1; slot 0 is the root; a free slot's CHECK is -1."""

    def __init__(self, nodes: int, codes: int):
        size = nodes + 2 * codes + 2
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.check[0], self.end, self.low = 0, 1, 1

    def _reach(self, last: int) -> None:
        if last >= len(self.check):
            more = max(last + 1, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))

    def _free(self, n: int) -> np.ndarray:
        """The first n free slots."""
        self._reach(self.end + n)
        found = self.low + np.flatnonzero(self.check[self.low : self.end + n] < 0)[:n]
        return found

    def _take(self, slots: np.ndarray, parent) -> None:
        self.check[slots] = parent
        self.end = max(self.end, int(slots.max()) + 1)
        while self.low < self.end and self.check[self.low] >= 0:
            self.low += 1

    def add_level(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Slots of new children: one (parent slot, code) each, grouped by parent, codes distinct within."""
        first = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        count = np.diff(np.append(first, len(parents)))
        slots = np.empty(len(parents), np.int64)
        for a, n in zip(first[count > 1].tolist(), count[count > 1].tolist()):
            c = codes[a : a + n]
            low, span = int(c.min()), int(c.max() - c.min())
            tries = self._free(_TRIES)
            self._reach(max(int(tries[-1]), self.end) + span)
            fits = (self.check[tries[:, None] + (c - low)] < 0).all(axis=1)
            at = int(tries[fits.argmax()]) if fits.any() else self.end
            self.base[parents[a]] = at - low
            slots[a : a + n] = at - low + c
            self._take(slots[a : a + n], parents[a])
        alone = first[count == 1]
        if len(alone):  # any free slot will do: the base is set so that the code leads there
            free = self._free(len(alone))
            self.base[parents[alone]] = free - codes[alone]
            slots[alone] = free
            self._take(free, parents[alone])
        return slots

    def step(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Where the codes lead from the slots; every edge must exist."""
        to = self.base[slots] + codes
        if not (self.check[to] == slots).all():
            raise AssertionError("a turn leads out of the trie")
        return to


def dense_codes(keys: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Codes from 1 for (h0, h1) rows, in order of the first level and place where each occurs,
    so that siblings lie close together."""
    _, at, code = np.unique(np.ascontiguousarray(keys).view("i8,i8").ravel(), return_index=True, return_inverse=True)
    least = np.full(len(at), np.iinfo(np.int64).max)
    np.minimum.at(least, code, depth)
    rank = np.empty(len(at), np.int64)
    rank[np.lexsort((at, least))] = np.arange(1, len(at) + 1)
    return rank[code]


def path_keys(keys: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """128-bit digests of the first 0, 1, ..., ``depth`` turns, as pairs of signed numbers."""
    h = xxhash.xxh3_128()
    out = [h.digest()]
    for k in range(depth):
        h.update(keys[k].tobytes())
        out.append(h.digest())
    return [tuple(np.frombuffer(d, np.int64).tolist()) for d in out]


def shard_nodes(sequences: list[list[int]], words: list[list[int]], count: list[int], conv: list[int], before: int, after: int) -> dict[str, list]:
    """The nodes of one shard's distinct sequences, partial where they are shared.

    ``before`` and ``after``: turns that the first (last) sequence has in common with the last
    (first) one of the neighbouring shard, -1 without a neighbour.
    """
    order = sorted(range(len(sequences)), key=sequences.__getitem__)
    size = np.array([len(sequences[i]) // 2 for i in order])
    starts = np.append(0, np.cumsum(size))
    keys = np.array([k for i in order for k in sequences[i]], np.int64).reshape(-1, 2)
    word = np.array([w for i in order for w in words[i]], np.int64)
    n_of, conv_of = np.array([count[i] for i in order], np.int64), np.array([conv[i] for i in order], np.int64)
    depth_of_turn = np.arange(len(keys)) - np.repeat(starts[:-1], size)
    codes = dense_codes(keys, depth_of_turn) if len(keys) else np.zeros(0, np.int64)
    trie = DoubleArray(len(keys) + 1, int(codes.max(initial=0)))
    # Build level by level: sorted sequences have the members of a node next to each other.
    at, levels = np.zeros(len(order), np.int64), [np.zeros(1, np.int64)]
    for d in range(int(size.max(initial=0))):
        some = np.flatnonzero(size > d)
        parent, code = at[some], codes[starts[some] + d]
        new = np.append(True, (parent[1:] != parent[:-1]) | (code[1:] != code[:-1]))
        slots = trie.add_level(parent[new], code[new])
        at[some] = slots[np.cumsum(new) - 1]
        levels.append(slots)
    # Walk every sequence and count its members into each node that it passes.
    cells = len(trie.check)
    n, least, turn_words, ends = np.zeros(cells, np.int64), np.full(cells, np.iinfo(np.int64).max), np.zeros(cells, np.int64), {}
    at = np.zeros(len(order), np.int64)
    for d in range(len(levels)):
        some = np.flatnonzero(size >= d)
        if d:
            turns = starts[some] + d - 1
            at[some] = trie.step(at[some], codes[turns])
            turn_words[at[some]] = word[turns]
        np.add.at(n, at[some], n_of[some])
        np.minimum.at(least, at[some], conv_of[some])
        ends |= {int(at[i]): int(conv_of[i]) for i in some[size[some] == d]}
    # The border paths: what is not new here, and what the next shard goes on with.
    def path(i: int, depth: int) -> list[int]:
        slots = [0]
        for d in range(depth):
            slots.append(int(trie.step(np.array(slots[-1:]), codes[starts[i] + d : starts[i] + d + 1])[0]))
        return slots

    old, shared = (path(0, before) if before >= 0 else []), {}
    for i, depth in ((0, before), (len(order) - 1, after)):
        if depth >= 0:
            shared |= dict(zip(path(i, depth), path_keys(keys[starts[i] :], depth)))
    is_old = np.zeros(cells, bool)
    is_old[old] = True
    children, leaves, saved = (np.zeros(cells, np.int64) for _ in range(3))
    every = np.concatenate(levels)
    np.add.at(children, trie.check[every[1:]], 1)
    leaves[every] = children[every] == 0
    if after >= 0 and after == size[-1]:  # the next shard begins with an extension of this sequence
        leaves[path(len(order) - 1, after)[-1]] = 0
    for s in old[1:]:
        children[trie.check[s]] -= 1
    saved[every] = (n[every] - ~is_old[every]) * turn_words[every]
    for slots in levels[:0:-1]:
        np.add.at(leaves, trie.check[slots], leaves[slots])
        np.add.at(saved, trie.check[slots], saved[slots])
    depth = np.repeat(np.arange(len(levels)), [len(x) for x in levels])
    up = trie.check[every]
    own_key = [shared.get(s, (None, None)) for s in every.tolist()]
    up_key = [shared.get(p, (None, None)) if d else (None, None) for p, d in zip(up.tolist(), depth.tolist())]
    return {
        "conv_id": least[every], "depth": depth, "parent_conv_id": [None if not d else int(least[p]) for p, d in zip(up.tolist(), depth.tolist())],
        "n_convs": n[every], "n_children": children[every], "n_leaves": leaves[every], "saved_tokens": saved[every],
        "ends": [ends.get(s) for s in every.tolist()],
        "k0": [k[0] for k in own_key], "k1": [k[1] for k in own_key], "p0": [k[0] for k in up_key], "p1": [k[1] for k in up_key],
    }


_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "k0", "k1", "p0", "p1"]


def _shard(table: pa.Table) -> pa.Table:
    cols = {c: table.column(c).to_pylist() for c in ("keys", "words", "n", "conv")}
    found = shard_nodes(cols["keys"], cols["words"], cols["n"], cols["conv"], table.column("before")[0].as_py(), table.column("after")[0].as_py())
    return pa.table([pa.array(found[c], pa.int64()) for c in _NODE], _NODE)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ends, ends_sha256) of sorted blocks of ids: one running digest for each sequence."""
    now, first, digest = None, None, None
    for b in batches:
        rows = []
        for k0, k1, low, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            if (k0, k1) != now:
                if now is not None:
                    rows.append((first, digest.hexdigest()))
                now, first, digest = (k0, k1), low, sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        yield _end_rows(rows)
    if now is not None:
        yield _end_rows([(first, digest.hexdigest())])


def _end_rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.string())], ["ends", "ends_sha256"])


def _borders(shards: DataFrame) -> DataFrame:
    """(shard, before, after): turns in common across the borders with the neighbouring shards; one row a shard."""
    edge = shards.groupBy("shard").agg(F.min("keys").alias("first"), F.max("keys").alias("last"))
    order = Window.orderBy("shard")
    near = edge.select("shard", "first", "last", F.lag("last").over(order).alias("left"), F.lead("first").over(order).alias("right"))

    def common(a: str, b: str) -> Column:
        n = F.least(F.size(a), F.size(b))
        differs = F.array_position(F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x != y), True)
        same = F.when(differs == 0, n).otherwise(differs - 1)
        return F.when(F.col(a).isNull() | F.col(b).isNull(), -1).otherwise(F.floor(same / 2)).cast("int")

    return near.select("shard", common("left", "first").alias("before"), common("last", "right").alias("after"))


def nodes(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null role and text are empty; rows without a conversation id belong to none and are left
    out; a null turn comes first; equal turn numbers go in order of their content's hash, and
    repeated rows are turns of their own. An empty table has no node, not even a root. A
    conversation is one row of 24 bytes a turn.
    """
    every = rebuilt(turn_lists(conversations, conv_col, turn_col, role_col, text_col))
    every = stored(every.select("*", F.xxhash64("keys").alias("k0"), F.xxhash64(F.lit(1), "keys").alias("k1")), "rebuilt")
    # Equal conversations are one sequence, named by the least of them.
    groups = every.groupBy("k0", "k1").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"))
    distinct = stored(every.join(groups.select("conv", "n"), "conv").select("conv", "n", "keys", "words"), "sequences")
    turns = distinct.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, math.ceil(turns / shard_turns))
    shards = stored(distinct.repartitionByRange(n, "keys").withColumn("shard", F.spark_partition_id()), "shards")
    # 12 bytes for each ``shard_turns`` turns of the corpus.
    bordered = shards.join(F.broadcast(_borders(shards)) if n <= 1_000_000 else _borders(shards), "shard")
    kinds = ", ".join(f"{c} long" for c in _NODE)
    found = stored(bordered.groupBy("shard").applyInArrow(_shard, kinds), "nodes")
    # Border nodes: partial aggregates are added.
    merged = found.where("k0 IS NOT NULL").groupBy("k0", "k1", "p0", "p1", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in _NODE[3:7]], F.max("ends").alias("ends")
    )
    merged = stored(merged, "borders")
    rest = ["conv_id", "depth", *_NODE[3:8]]
    inner = found.where("k0 IS NULL AND p0 IS NULL").select(*rest, "parent_conv_id")
    below = found.where("k0 IS NULL AND p0 IS NOT NULL").select(*rest, "p0", "p1").union(merged.where("depth > 0").select(*rest, "p0", "p1"))
    parents = merged.select(F.col("k0").alias("p0"), F.col("k1").alias("p1"), F.col("conv_id").alias("parent_conv_id"))
    top = merged.where("depth = 0").select(*rest, F.lit(None).cast("long").alias("parent_conv_id"))
    whole = inner.union(below.join(parents, ["p0", "p1"]).select(*rest, "parent_conv_id")).union(top)
    # Members that end at a node, in ascending order: blocks of consecutive ids first.
    blocks = every.groupBy("k0", "k1", F.shiftright("conv", _BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    blocks = blocks.select("k0", "k1", "block", F.col("ids")[0].alias("low"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("text"))
    dealt = blocks.repartition("k0", "k1").sortWithinPartitions("k0", "k1", "block").select("k0", "k1", "low", "text")
    digests = dealt.mapInArrow(_ends, "ends long, ends_sha256 string")
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    with_ends = whole.where("ends IS NOT NULL").join(digests, "ends").select(*shown)
    return with_ends.union(whole.where("ends IS NULL").withColumn("ends_sha256", F.lit(_NO_END)).select(*shown))
