"""Operators against brute force, on the small tables and on awkward rows."""

import hashlib
import tracemalloc
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from checks import compare
from loadloom.llm import bpe, decontam, line_dedup, quality_rules, queries, simhash, substring_dedup, url_filter
from loadloom.llm.common import NO_ID

from .conftest import ODD


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def table(spark, sf, name="documents"):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pairs(spark, sf):
    return [(r.doc_id, r.text) for r in table(spark, sf).collect()]


# op1


def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(keyed, threshold):
    """Least id by (id, fingerprint) row, over all pairs."""
    fps = np.array([f for _, f in keyed], np.uint64)
    root = list(range(len(keyed)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keyed)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= threshold):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(keyed):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return [(d, f, least[find(i)]) for i, (d, f) in enumerate(keyed)]


@pytest.mark.parametrize("which", ["tables", "odd"])
def test_simhash_groups(spark, docs, small, which):
    data = pairs(spark, small) if which == "tables" else ODD
    keyed = [(NO_ID if d is None else d, brute_fingerprint(t)) for d, t in data]
    want = sorted((d, f, c) for d, f, c in brute_components(keyed, 2))
    got = simhash.near_duplicates(docs(data) if which == "odd" else table(spark, small))
    assert sorted((r.id, r.fp0 % 2**64, r.component_id) for r in got.collect()) == want


def test_simhash_groups_of_several_seeds(spark, small):
    data, seeds = pairs(spark, small), (42, 7, 8)
    parent = {d: d for d, _ in data}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    prints = {d: simhash.fingerprint((t or "").encode(), 3, seeds) for d, t in data}
    for k in range(len(seeds)):
        fps = np.array([prints[d][k] for d, _ in data], np.uint64)
        for i, (d, _) in enumerate(data):
            for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2):
                a, b = find(d), find(data[j][0])
                parent[max(a, b)] = min(a, b)
    got = simhash.near_duplicates(table(spark, small), seeds=seeds)
    assert {r.id: r.component_id for r in got.collect()} == {d: find(d) for d, _ in data}


def test_changed_words_are_found_by_more_seeds(docs):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for i in range(40):
        text = list(rng.choice(words, 400))
        rows.append((2 * i, " ".join(text)))
        text[int(rng.integers(0, 400))] = "changed"
        rows.append((2 * i + 1, " ".join(text)))
    kept = {r.doc_id for r in simhash.first_of_each(docs(rows), seeds=(42, 43, 44, 45, 46, 47)).collect()}
    assert {2 * i for i in range(40)} <= kept and len(kept) <= 42


def test_simhash_links_of_crowded_and_scattered_fingerprints(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 12, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(i) for i in rng.integers(0, 64, n)) for b in base for n in rng.integers(0, 6, 25)]
    fps = sorted({*near, 0, 1, 2**64 - 1, *(1 << i for i in range(64))})
    want = {(f, c) for _, f, c in brute_components([(f, f) for f in fps], 2) if f != c}
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    for reach in (None, 3):  # the sharp replication radius and the covering radius plus the full threshold
        found = simhash.links(frame, 2, reach).collect()
        assert all(bin((r.a ^ r.b) % 2**64).count("1") for r in found)
        parent = {f: f for f in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in found:
            a, b = find(r.a % 2**64), find(r.b % 2**64)
            parent[max(a, b)] = min(a, b)
        assert {(f, find(f)) for f in fps if f != find(f)} == want


def test_every_fingerprint_has_an_anchor_and_groups_are_bounded():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**64, 500, dtype=np.uint64)
    a, f = simhash.anchors(fps, 1)
    assert set(f.tolist()) == set(fps.tolist())
    a, f = simhash.anchors(fps, 2)
    assert (np.bitwise_count(a ^ f) <= 2).all() and Counter(f.tolist()).most_common(1)[0][1] <= 33
    assert (simhash.syndromes(a) == 0).all()


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 40)]
    found = simhash.components(spark.createDataFrame(chain + star, "a long, b long"))
    assert {(r.node, r.root) for r in found.collect()} == {(i, 0) for i in range(1, 61)} | {(1000 + i, 1000) for i in range(1, 40)}


def test_one_document_of_each_group_stays(spark, docs):
    frame = docs([(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, "quite another text here"), (None, None), (7, "")])
    kept = simhash.first_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == [(False, 0), (True, 3), (True, 9)]


def test_rows_that_share_only_the_id_stay_apart(docs):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{w}" for w in rng.integers(0, 3000, 80)) for _ in range(7)]
    frame = docs([*((None, t) for t in texts[:3]), *((4, t) for t in texts[3:6]), (9, texts[1]), (8, texts[6]), (5, texts[4])])
    kept = simhash.first_of_each(frame).collect()
    assert sorted(r.text for r in kept) == sorted(texts)
    assert {r.text: r.doc_id for r in kept} == dict(zip(texts, [None] * 3 + [4] * 3 + [8]))
    found = {(r.id, r.component_id) for r in simhash.near_duplicates(frame).collect()}
    assert found == {(NO_ID, NO_ID), (4, 4), (9, NO_ID), (8, 8), (5, 4)}


# op3


@pytest.fixture(scope="module")
def tokens(spark):
    path = public_tokenizers.path(queries.BPE_FILE)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    return own, bpe.Tokenizer(spark, path, public_tokenizers.PATTERN)


def test_bpe_equals_the_library_and_round_trips(spark, docs, small, tokens):
    own, mine = tokens
    data = [*pairs(spark, small), *ODD, (99, "aab" * 5000 + "it's I'll\r\n\r\n  x   <|endoftext|>"), (98, "aaaaaaaaaaaaaaaa" * 9)]
    got = mine.decode(mine.encode(docs(data)))
    want = sorted(((d, own.encode_ordinary(t or ""), (t or "").encode()) for d, t in data), key=repr)
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in got.collect()), key=repr) == want
    checked = mine.encode(docs(ODD), check_col="h1")
    assert checked.where("NOT h1").count() == 0 and checked.count() == len(ODD)
    ids = spark.createDataFrame([(1, [36, 1459]), (2, None), (3, []), (4, [36])], "k int, ids array<int>")
    table = [t for t in mine.shared.value.tokens]
    assert {r.k: r.decoded for r in mine.decode(ids).collect()} == {1: table[36] + table[1459], 2: None, 3: b"", 4: table[36]}
    digests = {r.doc_id: r for r in bpe.digests(docs(data[:5]), mine).collect()}
    for d, t in data[:5]:
        ids = own.encode_ordinary(t or "")
        assert digests[d].n_tokens == len(ids)
        assert digests[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[d].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_random_strings_equal_the_library(tokens):
    own, mine = tokens
    coder, rng = bpe.Coder(mine.shared.value), np.random.default_rng(5)
    parts = ["a", "aa", "b", "the", "ing", " ", "  ", "\n", "é", "你", "😀", "1", "'s", "'ll", "ß", "!!", "\x1c", "\u00a0", "0"]
    for _ in range(3000):
        s = "".join(rng.choice(parts, rng.integers(0, 15)))
        assert coder.encode(s).tolist() == own.encode_ordinary(s)


# op5


def brute_counts(text):
    text = text or ""
    raw = text.encode()
    w = raw.split()
    lines = [x for x in raw.split(b"\n") if x.split()]
    runs = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(3)}
    n = len(w)
    return (
        n, sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(covered), n < 50 or 100 * len(covered) > 50 * n,
    )


@pytest.mark.parametrize("which", ["tables", "odd"])
def test_quality_counts(spark, docs, small, which):
    data = pairs(spark, small) if which == "tables" else [*ODD, (20, "a b c a b c"), (21, "a a a a"), (22, "a a a"), (23, "p q r s p q r")]
    got = quality_rules.judged(docs(data)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(got) == sorted(((d, *brute_counts(t)) for d, t in data), key=repr)


def test_quality_verdicts_name_their_rules(docs):
    clean = " ".join(f"the{i} word of{i} line and the" if i % 9 == 0 else f"w{i}th piece{i}" for i in range(60))
    got = {r.doc_id: r for r in quality_rules.judged(docs([(1, clean), (2, clean.replace(" ", "*** ")), (3, clean.upper()), (4, "short")])).collect()}
    assert got[1].kept and got[1].failed == []
    assert "few_symbols" in got[2].failed and not got[2].kept and not got[2].base_failed
    assert "few_capitals" in got[3].failed and got[4].base_failed


# op6


def edits_within(p, t):
    """Least edits between p and any stretch of t."""
    row = np.zeros(len(t) + 1, int)
    ramp = np.arange(len(t) + 1)
    for c in p:
        new = np.empty_like(row)
        new[0] = row[0] + 1
        new[1:] = np.minimum(row[:-1] + (t != c), row[1:] + 1)
        row = np.minimum.accumulate(new - ramp) + ramp
    return int(row.min())


def test_leaks_equal_brute_force(spark, docs, small):
    items = [(r.item_id, r.text) for r in table(spark, small, "benchmark").collect()][:12]
    rng = np.random.default_rng(4)
    filler = " ".join(t for _, t in pairs(spark, small)[:6] if t)[:4000]
    data = [(0, filler), (1, None), (2, "")]
    for n, (_, text) in enumerate(items):
        for share in (0.0, 0.04, 0.09, 0.14):
            cut = list(text)
            for at in rng.integers(0, len(cut), int(share * len(cut))):
                cut[at] = rng.choice(["", "x", cut[at] + "y"])
            at = int(rng.integers(0, 3000))
            data.append((100 + len(data), f"{filler[:at]} {''.join(cut).upper() if n % 2 else ''.join(cut)} {filler[at:at + 500]}"))
    benchmark = spark.createDataFrame([*items, (77, None), (78, "too short"), (None, items[0][1] + " other end of it")], "item_id long, text string")
    want = set()
    for d, t in data:
        tc = decontam.normalised(t or "")[0]
        for item, p in [*items, (None, items[0][1] + " other end of it")]:
            pc = decontam.normalised(p)[0]
            k = min(int(len(pc) * decontam.EDIT_SHARE), (len(pc) - decontam.Q) // decontam.Q)
            if (e := edits_within(pc, tc)) <= k:
                want.add((d, item, e))
    got = decontam.leaks(docs(data), benchmark).collect()
    assert {(r.doc_id, r.item_id, r.n_edits) for r in got} == want and len(want) > 20
    text = dict(data)
    for r in got:
        if r.n_edits == 0:
            assert text[r.doc_id][r.start : r.end].lower().split() == (dict(items) | {None: items[0][1] + " other end of it"})[r.item_id].lower().split()
    left = decontam.without_leaks(docs(data), benchmark)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in data} - {d for d, _, _ in want}


def test_leaks_of_odd_rows_long_items_and_empty_tables(spark, docs):
    words = [f"w{i * 7919 % 1000}x{i}" for i in range(600)]
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id int, text string")
    got = decontam.leaks(docs([*ODD, (50, " ".join(words[100:400]))]), benchmark).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(50, 1)]
    assert decontam.leaks(docs(ODD), benchmark.limit(0)).count() == 0
    assert decontam.leaks(docs([]), benchmark).count() == 0
    assert decontam.without_leaks(docs(ODD), benchmark).count() == len(ODD)


def test_quotes_of_part_of_an_item_are_found(spark, docs):
    rng = np.random.default_rng(14)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrst"), rng.integers(3, 9))) for _ in range(4000)]
    text = lambda n: " ".join(rng.choice(words, n // 4))[:n].strip()
    items = {1: text(394), 2: text(2000), 3: text(150), 4: text(90)}
    filler = text(1500)
    quotes = [
        (1, items[1][: int(0.85 * 394)]), (1, items[1][60:]), (1, items[1][120:275]), (2, items[2][100:600]), (2, items[2][1733:1885]),
        (2, items[2][-100:]), (3, items[3][:-45]), (3, items[3][20:]), (4, items[4]),
    ]
    slips = [(i, q[:30] + "#" + q[31:70] + q[71:]) for i, q in quotes if len(q) >= 149]
    data = [(n, f"{filler[: 40 * n]} {q.upper() if n % 2 else q} {filler[900:]}") for n, (_, q) in enumerate(quotes + slips)]
    # Too little of an item is no leak.
    data += [(100, filler), (101, filler + items[1][40:120] + filler), (102, filler + items[4][:60] + filler)]
    benchmark = spark.createDataFrame(list(items.items()), "item_id int, text string")
    got = decontam.leaks(docs(data), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(n, i) for n, (i, _) in enumerate(quotes + slips)}
    for r in got:
        if r.n_edits == 0:
            assert " ".join(dict(data)[r.doc_id][r.start : r.end].lower().split()) in items[r.item_id]
    assert {r.doc_id for r in decontam.without_leaks(docs(data), benchmark).collect()} == {100, 101, 102}


def repetitive(rng, n):
    """A text with long runs of short periods between words."""
    parts = []
    while sum(map(len, parts)) < n:
        unit = "".join(rng.choice(list("_-=. ab"), int(rng.integers(1, 9))))
        parts += [unit * int(rng.integers(1, 900)), " ".join(f"w{w}" for w in rng.integers(0, 50, 6))]
    return " ".join(parts)


def test_shortened_texts_hold_the_same_stretches():
    rng = np.random.default_rng(17)
    for _ in range(12):
        codes, at = decontam.normalised(repetitive(rng, 12_000))
        short, where = decontam.shortened(codes, at)
        grams = lambda c: {c[i : i + decontam._REACH].tobytes() for i in range(len(c) - decontam._REACH + 1)}
        assert grams(codes) == grams(short) and len(short) == len(where) <= len(codes)
        assert (codes[np.searchsorted(at, where)] == short).all()


def test_repetitive_texts_take_little_memory():
    item = "Name: " + "_" * 120 + " Date: " + "-=" * 60 + " Answer in one line"
    index = decontam.build([("blank", c, x) for c, x in decontam.cut(item)])
    texts = ["_" * 10_000_000, "-=" * 3_000_000, "_ " * 500_000 + item, "x" * 300_000 + item.replace("Date", "Data") + "_" * 300_000]
    tracemalloc.start()
    found = {i: (c, s, e) for i, _, c, s, e in decontam.matches(texts, index)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10**9 and {2, 3} <= set(found)
    c, s, e = found[3]
    assert c == 1 and 300_000 <= s < 300_020 and abs(e - s - len(item)) < 20


@pytest.mark.parametrize("size", [2_000_000, 900])
def test_leaks_do_not_depend_on_blocks_steps_and_stretches(spark, docs, small, monkeypatch, size):
    words = [f"w{i}" for i in range(3000)]
    rng = np.random.default_rng(18)
    items = [(i, " ".join(rng.choice(words, int(rng.integers(8, 400))))) for i in range(12)]
    data = [(i, " ".join(rng.choice(words, 300)) + " " + items[i % 12][1][: 700 if i % 2 else None]) for i in range(24)] + [(3, None), (4, "")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    want = sorted(map(tuple, decontam.leaks(docs(data), benchmark).collect()))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", size)
    monkeypatch.setattr(decontam, "STEP_HITS", 50)
    monkeypatch.setattr(decontam, "STRETCH", 256)
    got = sorted(map(tuple, decontam.leaks(docs(data), benchmark).collect()))
    assert got == want and len(want) >= 24
    clean = decontam.without_leaks(docs(data), benchmark)
    assert clean.count() == 2


# op7


def brute_substrings(data, window):
    docs_in_order = sorted({(NO_ID if d is None else d, t or "") for d, t in data}, key=lambda x: (x[0], x[1]))
    seen, out = {}, {}
    for d, t in docs_in_order:
        w = t.encode().split()
        gone = set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if seen.setdefault(key, (d, t, s)) != (d, t, s):
                gone.update(range(s, s + window))
        out[d, t] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


@pytest.mark.parametrize("window", [20, 8, 3, 1])
def test_substring_dedup(spark, docs, small, window):
    rng = np.random.default_rng(window)
    shared = [f"s{i}" for i in range(90)]
    data = [(d, t) for d, t in ODD if d != 13]
    for d in range(100, 160):  # overlapping stretches of one passage at all alignments, some repeated inside
        a, n = rng.integers(0, 60), rng.integers(10, 40)
        words = [f"u{d}.{i}" for i in range(rng.integers(0, 30))]
        data.append((int(rng.integers(0, 10**6)), " ".join([*words, *shared[a : a + n], *words[:5], *shared[a : a + n], "end"])))
    want = brute_substrings(data, window)
    got = substring_dedup.dedup_substrings(docs(data), window=window)
    texts = Counter(((NO_ID if d is None else d), *want[NO_ID if d is None else d, t or ""]) for d, t in data)
    assert Counter((r.id, r.n_words, r.n_removed, r.kept) for r in got.collect()) == texts


def test_substring_dedup_of_small_chunks(spark, docs, small, monkeypatch):
    """The same when tasks reduce a few documents at a time, so that equals meet in the shuffle."""
    data = pairs(spark, small)
    want = brute_substrings(data, 20)
    frame = docs(data).repartition(7)
    got = substring_dedup.dedup_substrings(frame)
    assert sorted((r.id, r.n_words, r.n_removed, r.kept) for r in got.collect()) == sorted((d, *want[d, t or ""]) for d, t in data)


def test_difference_covers():
    for v, cover in substring_dedup.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


# op8


def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


def test_url_filter_equals_brute_force(spark):
    urls = [
        None, "", "no scheme", "http://", "http:///x", "https://EXAMPLE.net/en/1", "http://a.b.example.net/en/x?y", "http://example.net", "x://net/",
        "http://notexample.net/en/", "http://example.net/enx", "ftp://a.org/fr/#f", "http://a.org?x=/fr/", "http://org/fr/", "http://É.net/de/7",
        "http://a..net/x", "http://.net/", "http://a.net:80/x", "http://u@example.com/de/://z/", "http://example.com/de/", "http://example.com/de/1/2",
    ] * 2
    rules = [*queries.URL_RULES, ("example.com", "/de/1", "allow"), ("a.net", "", "allow"), ("a.org", "/fr/", "block"), ("org", "/fr/", "allow")]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("x", None, "block")], "host string, path string, verdict string")
    got = url_filter.judged(frame, table).collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got)) == [(i, *brute_url(u, rules)) for i, u in enumerate(urls)]
    assert url_filter.judged(frame, table.limit(0)).where("verdict <> 'allow' OR rule IS NOT NULL").count() == 0
    assert url_filter.judged(frame.limit(0), table).count() == 0


# op9


def brute_lines(data):
    def key(line):
        return line.encode().strip(b" \t\n\x0b\x0c\r").lower().decode()

    held = defaultdict(set)
    for d, t in data:
        for line in (t or "").split("\n"):
            held[key(line)].add(NO_ID if d is None else d)
    out = []
    for d, t in data:
        d = NO_ID if d is None else d
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(held[key(x)]) > 1 and min(held[key(x)]) != d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("which", ["tables", "odd"])
def test_line_dedup(spark, docs, small, which):
    data = pairs(spark, small) if which == "tables" else [*ODD, (30, "É LINE OF TEN"), (31, "é line of ten\nÉ LINE of ten "), (32, "É line of ten\nx\n\n")]
    got = line_dedup.dedup_lines(docs(data))
    assert sorted((r.id, r.n_lines, r.n_dropped, r.text) for r in got.collect()) == brute_lines(data)
    whole = line_dedup.deduplicated(docs(data), chars_col="h1")
    assert whole.columns == docs(data).columns and whole.where("h1 <> char_length(text)").count() == 0


@pytest.mark.parametrize("name", ["op5_quality_rules", "op7_substring_dedup", "op8_url_filter", "op9_line_dedup"])
def test_queries_equal_their_sql(spark, small, name):
    assert compare.differences(queries.QUERIES[name](spark, small).toPandas(), compare.connect(small).execute(queries.ORACLES[name]).df()) is None
    assert duckdb.__version__
