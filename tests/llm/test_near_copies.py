"""The near-duplicate stage against brute force at five words and Jaccard 0.8."""

import numpy as np

import corpus_pipeline
from loadloom.llm import near_copies


def five(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else {()})


def jaccard(a, b):
    return len(a & b) / len(a | b)


def changed(rng, words, n):
    words = list(words)
    for at in rng.choice(len(words), n, replace=False):
        words[at] = f"c{rng.integers(10**9)}"
    return words


def kept_by_brute_force(rows):
    """Least of each component over all pairs at 0.8; ids are distinct here."""
    sets, root = [five(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and jaccard(sets[i], sets[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {rows[i][0] for i in range(len(rows)) if find(i) == i}


def stage(spark, frame):
    return {r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame, "").collect()}


def test_stage_equals_brute_force_at_similarity_08(spark, docs):
    rng, rows = np.random.default_rng(11), []
    for _ in range(150):
        n = int(rng.integers(60, 500))
        words = [f"w{w}" for w in rng.integers(0, 4000, n)]
        rows.append((len(rows), " ".join(words)))
        # About 5 shingles go for each word changed: similarities on both sides of 0.8.
        rows.append((len(rows), " ".join(changed(rng, words, int(rng.integers(1, max(2, n // 30)))))))
    rows += [(1000, "A b  c"), (1001, "a B c"), (1002, ""), (1003, None), (1004, " \n"), (1005, "a b")]
    want = kept_by_brute_force(rows)
    sims = [jaccard(five(rows[i][1]), five(rows[i + 1][1])) for i in range(0, 300, 2)]
    assert sum(0.8 <= x < 0.85 for x in sims) > 20 and sum(x < 0.8 for x in sims) > 20
    assert stage(spark, docs(rows)) == want


def test_crowded_buckets_lose_no_link(spark, docs):
    """Three hundred texts of one form, most below 0.8 of each other, and near copies of some."""
    rng, rows = np.random.default_rng(12), []
    form = [f"f{i}" for i in range(240)]
    for i in range(300):
        rows.append((i, " ".join(form + [f"u{i}.{k}" for k in range(70)])))
    for i in range(0, 300, 10):
        rows.append((1000 + i, " ".join(changed(rng, rows[i][1].split(), 5))))
    assert stage(spark, docs(rows)) == kept_by_brute_force(rows) == set(range(300))


def test_copies_around_one_text_are_one_group(spark, docs):
    rng = np.random.default_rng(13)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(changed(rng, base, 3))) for i in range(1, 200)] + [(500, " ".join(base))]
    assert stage(spark, docs(rows)) == {1}


def test_shingles_of_words_without_a_text():
    assert len(near_copies.shingle_set(b"")) == 0 and len(near_copies.shingle_set(b"a b")) == 1


def test_four_thousand_texts_of_one_form_and_their_copies(spark, docs):
    """Pages of one site: much in common, each with words of its own. No pair of two pages is formed."""
    rng, rows = np.random.default_rng(14), []
    form = [f"f{i}" for i in range(240)]
    for i in range(4000):
        rows.append((i, " ".join(form + [f"u{i}.{k}" for k in range(70)])))
    for i in range(0, 4000, 10):
        rows.append((10_000 + i, " ".join(changed(rng, rows[i][1].split(), 5))))
    rng.shuffle(rows)
    assert stage(spark, docs([(int(i), t) for i, t in rows])) == set(range(4000))


def test_crowd_of_copies_on_both_sides_of_the_threshold(spark, docs):
    """Copies of one text with up to a tenth of its words changed: many pairs link, many do not."""
    rng = np.random.default_rng(15)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(changed(rng, base, int(rng.integers(1, 15))))) for i in range(500)]
    assert stage(spark, docs(rows)) == kept_by_brute_force(rows)


def test_prefix_candidates_lose_no_pair(spark):
    """Every pair at the similarity is a candidate, if its members are of different components."""
    rng, sets = np.random.default_rng(16), []
    for g in range(12):
        pool = rng.integers(0, 2**62, 60)
        for _ in range(20):
            keep = pool[rng.random(60) < rng.uniform(0.7, 1.0)]
            sets.append(np.unique(np.append(keep, rng.integers(0, 2**62, int(rng.integers(0, 12))))).astype(np.uint64))
    root = [int(rng.integers(0, i + 1)) if rng.random() < 0.3 else i for i in range(len(sets))]
    members = spark.createDataFrame([(i, root[i], len(s)) for i, s in enumerate(sets)], "node long, root long, n int")
    frame = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "node long, set binary")
    found = {(r.a, r.b) for r in near_copies.prefix_candidates(members, frame).collect()}
    want = {(i, j) for j in range(len(sets)) for i in range(j) if root[i] != root[j] and near_copies.similar(sets[i], sets[j])}
    assert want <= found and len(want) > 100 and not any(root[a] == root[b] for a, b in found)


def test_stage_on_nulls_repeated_rows_and_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(None, text, 1, "x"), (None, "another text without an id", 2, "y"), (3, text, 3, "z"), (3, text, 3, "z"), (4, "one id on", 4, "a"),
            (4, "two texts here", 5, "b"), (4, None, 6, "c"), (5, "", 7, "d"), (6, text + " more", 8, "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, id int, TEXT_KEY string")
    kept = near_copies.first_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r[0] is not None, r[0] or 0, r[1] or "") for r in kept.collect()) == [
        (False, 0, "another text without an id"), (False, 0, text), (True, 4, ""), (True, 4, "one id on"), (True, 4, "two texts here"),
    ]
    assert near_copies.first_of_each(frame.limit(0)).count() == 0


def test_first_links_come_from_the_simhash_operator(spark, docs, monkeypatch):
    """Fingerprints under anchor points give the first candidates, and nearly all links above 0.95."""
    calls, given, rng, rows = [], near_copies.simhash.links, np.random.default_rng(17), []
    monkeypatch.setattr(near_copies.simhash, "links", lambda *a, **k: calls.append(k) or given(*a, **k))
    for i in range(0, 200, 2):
        words = [f"w{w}" for w in rng.integers(0, 4000, 300)]
        rows += [(i, " ".join(words)), (i + 1, " ".join(changed(rng, words, 1)))]
    assert stage(spark, docs(rows)) == kept_by_brute_force(rows) == set(range(0, 200, 2))
    assert calls == [{"width": near_copies.WIDTH}]
    nodes = spark.createDataFrame([(i, 296, near_copies.prints(t.encode()).tolist()) for i, t in rows], "node long, n int, fps array<long>")
    pairs = {(r.a, r.b) for r in near_copies.fingerprint_pairs(nodes).collect()}
    assert len(pairs & {(i, i + 1) for i in range(0, 200, 2)}) >= 95 and len(pairs) < 110


def test_short_fingerprints_link_within_two_bits_and_one_number(spark):
    """Components by anchors of 32 bits are those of brute force, and numbers above the bits never meet."""
    rng, fps = np.random.default_rng(18), set()
    for base in rng.integers(0, 2**32, 60):
        for _ in range(6):
            flips = sum(1 << int(i) for i in rng.choice(32, int(rng.integers(0, 4)), replace=False))
            fps.add(int(rng.integers(0, 2)) << 32 | int(base) ^ flips)
    fps, root = sorted(fps), {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    def joined(edges):
        root.clear()
        for a, b in edges:
            low, high = sorted((find(a), find(b)))
            root[high] = low
        return {f: find(f) for f in fps}

    want = joined([(a, b) for a in fps for b in fps if a < b and a >> 32 == b >> 32 and (a ^ b).bit_count() <= 2])
    found = near_copies.simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), width=32)
    assert joined([(r.a, r.b) for r in found.collect()]) == want and len(set(want.values())) < len(fps) - 50


def test_texts_of_common_shingles_keep_their_links(spark, docs, monkeypatch):
    """With no link from fingerprints, all pairs come from prefixes, also of texts made of common ones."""
    monkeypatch.setattr(near_copies, "fingerprint_pairs", lambda nodes: nodes.selectExpr("node AS a", "node AS b").limit(0))
    rng, rows = np.random.default_rng(19), []
    form = [f"f{i}" for i in range(150)]
    for i in range(120):
        rows.append((i, " ".join(form[: int(rng.integers(60, 150))] + [f"u{i}.{k}" for k in range(int(rng.integers(0, 60)))])))
    for i in range(40):
        rows.append((1000 + i, " ".join(changed(rng, rows[3 * i][1].split(), int(rng.integers(1, 4))))))
    assert stage(spark, docs(rows)) == kept_by_brute_force(rows)
