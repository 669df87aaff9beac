import random
import re

import numpy as np
import xxhash

from gleaner.llm import simhash
from gleaner.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprint():
    for text in ("", None, "One", "One  two", "É Été a\nB c d\x1ce f", "a b c " * 50, "x " * 70000):
        assert simhash.fingerprint((text or "").encode()) & (1 << 64) - 1 == brute_fingerprint(text)


def test_leaves_hold_every_pair():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 300, dtype=np.int64)
    near = base.copy()
    for k in range(3):
        near ^= np.int64(1) << r.integers(0, 63, 300)
    fps = np.concatenate([base, near])
    leaf, at = simhash.leaves(fps, 6)
    where = [set() for _ in fps]
    for a, b in zip(leaf, at):
        where[b].add(a)
    assert all(where[i] & where[i + 300] for i in range(300))


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = {r.u: r.v for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    want = union(pairs, {x for p in pairs for x in p})
    assert got == {k: v for k, v in want.items() if k != v}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 5, 200, 400]))]
        rows.append((len(rows) * 3, " ".join(text), 0))
        for _ in range(rng.choice([0, 0, 1, 3])):
            text[rng.randrange(len(text))] = "changed"
            rows.append((len(rows) * 3, " ".join(text), 0))
    rows += [(10_000, None, 0), (10_001, "", 0), (10_002, " \n", 0), (None, "alone here now", 0), (10_003, rows[0][1], 0), (10_003, rows[0][1], 0), (10_004, "twice the same", 0), (10_004, "twice the same", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    fp = [brute_fingerprint(t) for _, t, _ in rows]
    root = union([(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 3], range(len(rows)))
    least = {}
    for i, (d, _, _) in enumerate(rows):
        least[root[i]] = min((x for x in (least.get(root[i]), d) if x is not None), default=None)
    want = sorted(str((d, f"{fp[i]:016x}", least[root[i]])) for i, (d, _, _) in enumerate(rows))
    for leaf_rows, most in ((4096, 1 << 16), (10, 20)):
        groups = simhash.links
        try:
            simhash.links = lambda d, r: groups(d, r, leaf_rows, most)
            out = simhash.near_duplicates(docs).collect()
        finally:
            simhash.links = groups
        assert sorted(str((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id)) for r in out) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == {x for x in least.values()} | {None} and len(ids) == len(set(ids))
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copies(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(3000)]
    rows, group = [], []
    for i in range(120):
        text = [rng.choice(words) for _ in range(rng.choice([60, 150, 400]))]
        for k in range(rng.choice([1, 1, 2, 4])):
            copy = list(text)
            for _ in range(k * len(text) // 100):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy), 0))
            group.append(i)
    rows += [(900, rows[0][1].upper(), 0), (901, None, 0), (902, " ", 0), (None, rows[5][1], 0), (1, rows[1][1], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    sets = [shingles(t or "") for _, t, _ in rows]
    jaccard = lambda a, b: len(a & b) / max(1, len(a | b))
    close = [(i, j) for i in range(len(group)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.85]
    found = simhash.near_copies(docs, leaf_rows=30, most_rows=20).collect()
    root = {r.doc_id: r.component_id for r in found if r.doc_id is not None}
    assert len(found) == len(rows) and len(close) > 30
    assert all(root[i] == root[j] for i, j in close)
    near = union([(i, j) for i in range(len(group)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.65], range(len(group)))
    assert all(near[i] == near[root[i]] for i in range(len(group)))
    assert root[900] == root[0] and root[902] == 901
    kept = [r.doc_id for r in simhash.keep_one(docs, 0.8, shingle=5).collect()]
    assert len(kept) == len(set(kept)) and set(kept) - {None} == {r for r in root.values()}
    assert simhash.near_copies(docs.where("false")).count() == 0


def test_near_copies_of_templates(spark):
    """Texts of one template that are alike in pairs only, at all sizes of groups, against brute force."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    template, rows = [rng.choice(words) for _ in range(400)], []
    for i in range(40):
        text = list(template)
        for _ in range(rng.choice([8, 12, 16])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((len(rows), " ".join(text)))
        for k in range(rng.choice([1, 2])):
            for _ in range(rng.choice([2, 6, 8])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [shingles(t) for _, t in rows]
    want = union([(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])], range(len(rows)))
    assert 5 < len(set(want.values())) < len(rows) - 20
    for leaf_rows, most_rows in ((1, 1 << 16), (2, 20), (1000, 1 << 16)):
        got = {r.doc_id: r.component_id for r in simhash.near_copies(docs, leaf_rows=leaf_rows, most_rows=most_rows).collect()}
        assert got == want


def test_near_copies_at_the_threshold(spark):
    """Pairs of similarity 0.8 to 0.82 all link; pairs of 0.74 to 0.8 never do."""
    rng = random.Random(6)
    rows, want = [], {}
    while len(rows) < 240:
        text = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([60, 150, 400]))]
        copy = list(text)
        while (j := len(shingles(" ".join(text)) & (b := shingles(" ".join(copy)))) / len(shingles(" ".join(text)) | b)) > 0.82:
            copy[rng.randrange(len(copy))] = "edit"
        if len(rows) % 4 and j >= 0.8:
            while (j := len(shingles(" ".join(text)) & (b := shingles(" ".join(copy)))) / len(shingles(" ".join(text)) | b)) >= 0.8:
                copy[rng.randrange(len(copy))] = "edit"
        if j < 0.74:
            continue
        want |= {len(rows): len(rows), len(rows) + 1: len(rows) + (j < 0.8)}
        rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(copy))]
    assert 20 < sum(k != v for k, v in want.items()) < 100
    got = simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_rows_of_one_id_are_judged_apart(spark):
    say = lambda c: " ".join(f"{c}{i}" for i in range(40))
    rows = [(1, say("a")), (1, say("b")), (2, say("a")), (2, say("c")), (None, say("d")), (None, say("e")), (3, say("f")), (3, say("f"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, [rows[0], rows[1], *rows[3:7]]))
    for similarity in (None, 0.8):
        assert sorted(str(tuple(r)) for r in simhash.keep_one(docs, similarity).collect()) == want


def test_alike_meets_every_pair(spark):
    """Texts with two bits or fewer apart in a half of a fingerprint are connected, and only they, at all depths."""
    r = np.random.default_rng(9)
    fps = r.integers(0, 1 << 63, (160, len(simhash.FOLDS)), dtype=np.int64)
    near = r.integers(0, 1 << 63, (160, len(simhash.FOLDS)), dtype=np.int64)
    for i in range(160):
        k, flips = r.integers(0, len(simhash.FOLDS)), r.choice(63, 3, replace=False)
        near[i, k] = fps[i, k] ^ sum(1 << int(x) for x in flips)
    fps = np.concatenate([fps, near, fps[:3]])
    halves = np.stack([fps.view(np.uint64) & np.uint64(0xFFFFFFFF), fps.view(np.uint64) >> np.uint64(32)], 2).reshape(len(fps), -1)
    close = {(j, i) for i in range(len(fps)) for j in range(i) if (np.bitwise_count(halves[i] ^ halves[j]) <= 2).any()}
    want = union(close, range(len(fps)))
    assert len(close) > 150
    texts = spark.createDataFrame([(i, *x) for i, x in enumerate(fps.tolist())], ["uid", *simhash.FOLDS])
    for leaf_rows, most_rows in ((8192, 1 << 16), (40, 1 << 16), (40, 30)):
        got = [tuple(x) for x in simhash.alike(texts, leaf_rows=leaf_rows, most_rows=most_rows).collect()]
        assert set(got) <= close and union(got, range(len(fps))) == want


def test_near_copies_come_through_the_fingerprints(spark, monkeypatch):
    """The trees find most links, and the join of sets compares no pair that they connect."""
    rng, rows = random.Random(14), []
    for i in range(60):
        text = [f"w{rng.randrange(10**5)}" for _ in range(300)]
        rows.append((2 * i, " ".join(text)))
        for at in rng.sample(range(300), 2):
            text[at] = "edit"
        rows.append((2 * i + 1, " ".join(text)))
    tables, real = {}, simhash.staged

    def staged(df, name):
        tables.setdefault(name, []).append(out := real(df, name))
        return out

    monkeypatch.setattr(simhash, "staged", staged)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    assert got == {d: d - d % 2 for d, _ in rows}
    first = {tuple(sorted(x)) for x in tables["linked"][0].collect()}
    assert len(first) >= 57
    assert not first & {(min(r.u, r.v), max(r.u, r.v)) for r in tables["candidates"][0].collect()}


def test_pairs_go_in_small_batches():
    """Pairs found in a task, repeats left out, reach the executor in batches that are small beside its memory."""
    u, v = np.arange(50_000), np.arange(50_000) + 7
    found = list(simhash._pair_batches([u, v], [v, u]))
    assert max(b.num_rows for b in found) <= 20_000
    assert sorted(x for b in found for x in b.column("u").to_pylist()) == u.tolist()


def seen_tables(monkeypatch):
    """Staged tables by name, as they are written."""
    tables, real = {}, simhash.staged

    def staged(df, name):
        tables.setdefault(name, []).append(out := real(df, name))
        return out

    monkeypatch.setattr(simhash, "staged", staged)
    return tables


def test_rows_of_groups_grow_with_their_texts(spark, monkeypatch):
    """Groups of a shingle report texts, not pairs: four times as many in a group make about four times the rows."""
    monkeypatch.setattr(simhash, "_frequent", lambda *_: (np.zeros(0, np.int64), np.zeros(0, np.int64)))  # no sample knows them
    rng, made = random.Random(21), []
    for texts in (4, 16):
        rows = []
        for group in range(8):
            shared = [f"s{rng.randrange(10**6)}" for _ in range(60)]
            rows += [(len(rows) + k, " ".join([f"w{rng.randrange(10**6)}" for _ in range(140)] + shared)) for k in range(texts)]
        tables = seen_tables(monkeypatch)
        got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {d: d for d, _ in rows}
        made.append(tables["met"][0].count())
        assert tables["candidates"][0].count() == 0
    assert made[0] > 0 and made[1] <= 6 * made[0]


def test_the_join_alone_finds_every_link(spark, monkeypatch):
    """Without the trees, at all lengths of bitmaps and sizes of groups, against brute force."""
    monkeypatch.setattr(simhash, "alike", lambda texts, *_: texts.select(texts.uid.alias("u"), texts.uid.alias("v")).where("false"))
    rng, rows = random.Random(22), []
    for n in (60, 150, 900, 1100, 1900, 3800) * 3:
        base = [f"w{rng.randrange(10**5)}" for _ in range(n)]
        for _ in range(4):
            text = list(base)
            for _ in range(max(1, int(n * rng.choice([0.005, 0.01, 0.02, 0.025])))):
                text[rng.randrange(len(text))] = f"w{rng.randrange(10**5)}"
            rows.append((len(rows), " ".join(text[: len(text) - rng.randrange(1 + n // 12)])))
    sets = [shingles(t) for _, t in rows]
    want = union([(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])], range(len(rows)))
    assert 20 < len(set(want.values())) < len(rows) - 15
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for known in (True, False):
        if not known:
            monkeypatch.setattr(simhash, "_frequent", lambda *_: (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        for leaf_rows in (1, 16):
            assert {r.doc_id: r.component_id for r in simhash.near_copies(docs, leaf_rows=leaf_rows).collect()} == want


def test_groups_with_farther_partners_report_all_texts():
    leaf, size, root = np.array([-5, -5, -5, -5, 3, 3, 3, 9]), np.array([80, 81, 82, 100, 10, 50, 90, 7]), np.arange(8)
    assert simhash._wide_groups(leaf, size, root, 2, 0.8).tolist() == [True] * 4 + [False] * 4
    assert not simhash._wide_groups(leaf, size, np.zeros(8, int), 2, 0.8).any()
    assert not simhash._wide_groups(leaf, size, root, 9, 0.8).any()


def test_own_bitmaps_bound_differences():
    """Bitmaps of different lengths, made one length, never differ in more bits than the sets in members."""
    r = np.random.default_rng(23)
    for n, m in ((1001, 1250), (1861, 1862), (3700, 4400), (14_000, 60_000)):
        a = np.unique(r.integers(-(1 << 63), (1 << 63) - 1, n))
        for b in (np.unique(np.concatenate([a[n // 10 :], r.integers(0, 1 << 62, m - n)])), np.unique(r.integers(0, 1 << 62, m))):
            bits = [simhash.bitmap(x, simhash.own_bits(len(x))) for x in (a, b)]
            length = np.array([len(x) for x in bits])
            words, w = np.concatenate(bits).view(np.uint64), int(length.min())
            x, y = (simhash.shortened(words, np.array([s]), length[k : k + 1], w) for k, s in enumerate([0, length[0]]))
            assert (x[0] == simhash.bitmap(a, 64 * w).view(np.uint64)).all() and (y[0] == simhash.bitmap(b, 64 * w).view(np.uint64)).all()
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
