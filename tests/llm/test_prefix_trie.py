"""The prefix trie against a plain one, the query's SQL, and the double array by itself."""

import hashlib
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from checks import compare
from loadloom.llm import prefix_trie, queries

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Rows of (conv, turn, role, text) to node rows; turns of one conversation have distinct numbers here."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c in own:
        h = crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, s in sorted(seqs.items()):
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words
            leaves[p[:d]] += not children[p]
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in m if len(seqs[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items()
    )


def frame(spark, rows):
    rows = [(*r, 1, "k") for r in rows]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int, keys string")


def found(df):
    return sorted((tuple(r[c] for c in NAMES) for r in df.collect()))


def random_rows(rng, n, common):
    rows = []
    for c in range(n):
        size = int(rng.integers(1, 7))
        if rng.random() < common:  # copies of one conversation, some longer
            rows += [(c, t, "user", f"very common {t}") for t in range(3 + int(rng.integers(0, 3)))]
        else:
            rows += [(c, t, str(rng.integers(0, 2)), " ".join("w" * int(rng.integers(1, 3)) for _ in range(int(rng.integers(0, 3))))) for t in range(size)]
    return rows


@pytest.mark.parametrize("turns, common", [(3, 0.5), (40, 0.0), (10**6, 0.5)])
def test_nodes_equal_a_plain_trie_at_any_shard_size(spark, turns, common):
    rows = random_rows(np.random.default_rng(8), 260, common)
    assert found(prefix_trie.nodes(frame(spark, rows), shard_turns=turns)) == plain(rows)


def test_query_equals_its_sql(spark, small):
    want = compare.connect(small).execute(f"SELECT {', '.join(NAMES)} FROM ({queries.ORACLES['op13_prefix_trie']})").fetchall()
    assert found(queries.op13_prefix_trie(spark, small)) == sorted(want)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "belongs to none"), (20, None, None, None), (20, 0, "user", "a b"), (20, 1, "user", " \t"), (21, 5, "user", "x"),
        (21, None, "", ""), (40, 0, None, "a b"), (41, 0, "user", "short"), (62, 3, "user", "no family"), (2**62, 1, "user", "w " * 50_000),
    ]
    assert found(prefix_trie.nodes(frame(spark, rows), shard_turns=2)) == plain(rows)
    assert prefix_trie.nodes(frame(spark, [])).count() == 0 and prefix_trie.nodes(frame(spark, rows[:1])).count() == 0
    # Repeated rows are turns of their own, equal turn numbers have one fixed order.
    twice = [(0, 1, "user", "a"), (0, 1, "user", "a"), (0, 2, "user", "p"), (0, 2, "user", "q")]
    a, b = (found(prefix_trie.nodes(frame(spark, r))) for r in (twice, twice[::-1]))
    assert a == b and max(r[1] for r in a) == 4


def test_members_over_many_blocks_of_ids(spark):
    rows = [(20 * c, 0, "user", "one") for c in range(400)]
    got = found(prefix_trie.nodes(frame(spark, rows)))
    assert got == plain(rows) and got[1][3] == 400


def test_turnless_conversations_belong_to_the_root(spark):
    c = next(i for i in range(101, 119) if crc32(str(i).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone"), (c, 1, "user", "gone too"), (7, 0, "user", "x")]
    got = found(prefix_trie.nodes(frame(spark, rows)))
    assert got == plain(rows) and [r for r in got if r[1] == 0][0][3] == 2


def test_double_array_leads_to_every_child_and_no_other():
    rng = np.random.default_rng(9)
    trie, edges, level = prefix_trie.DoubleArray(10, 300), {}, np.zeros(1, np.int64)
    for _ in range(6):
        parents, codes = [], []
        for s in level.tolist():
            some = rng.choice(300, int(rng.choice([1, 1, 1, 2, 5, 30])), replace=False) + 1
            parents += [s] * len(some)
            codes += some.tolist()
        slots = trie.add_level(np.array(parents), np.array(codes))
        for s, c, to in zip(parents, codes, slots.tolist()):
            assert (s, c) not in edges and to not in edges.values()
            edges[s, c] = to
        level = slots[:: max(1, len(slots) // 60)]
    for (s, c), to in edges.items():
        assert trie.step(np.array([s]), np.array([c]))[0] == to
    used = {s for s, _ in edges}
    for s in used:
        for c in range(1, 301):
            t = int(trie.base[s]) + c
            inside = 0 <= t < len(trie.check) and trie.check[t] == s and t != 0
            assert inside == ((s, c) in edges)
