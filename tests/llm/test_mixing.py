import hashlib
import random
import re
from collections import defaultdict

import pytest

from gleaner.llm import mixing


def brute_targets(sizes, repeats=3):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, out = sum(sizes.values()), set(order), {}
    while free:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > repeats * sizes[s]}
        if not over:
            return out | {s: rate * weight[s] for s in free}
        for s in over:
            out[s] = repeats * sizes[s]
            left -= out[s]
        free -= over
    return out


def rows_of(seed, sources, n):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 7, 50, 300])), rng.choice(sources), 0) for i in range(n)]
    return rows + [(n, None, sources[0], 0), (n + 1, "x\ty\x1cz", None, 0), (5, rows[5][1], rows[5][2], 0)]


def brute_slots(sizes, want, block, repeats=3):
    """Source -> schedule positions of its slots, from the golden-ratio points one by one."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    blocks = {s: -(-sizes[s] // block) for s in order}
    goals = {s: min(int(want[s] + 0.5), repeats * sizes[s]) for s in order}
    quota = {s: max(1, int(goals[s] / sizes[s] * blocks[s] + 0.5)) if goals[s] else 0 for s in order}
    total, edges, cum = sum(quota.values()), [], 0
    for s in order:
        edges.append((cum * 2**32 // total, (cum + quota[s]) * 2**32 // total, s))
        cum += quota[s]
    slots = defaultdict(list)
    for k in range(total):
        x = k * mixing._GOLDEN % 2**32
        s = next(s for low, high, s in edges if low <= x < high)
        if len(slots[s]) < repeats * blocks[s]:
            slots[s].append(k)
    return slots, blocks, quota


def brute_mix(rows, block):
    """Per row (source, size, taken, first_slot), and the order of the copies, word by word from the slots."""
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, streams = defaultdict(int), defaultdict(list)
    for i, (d, t, s, *_) in enumerate(rows):
        sizes[s] += count(t)
        streams[s].append((hashlib.md5(f"11|{d}".encode()).hexdigest(), count(t), i))
    want = brute_targets(sizes)
    slots, blocks, quota = brute_slots(sizes, want, block)
    out, order = {}, []
    for s, docs in streams.items():
        start = 0
        for _, n, i in sorted(docs):
            taken = 0
            for j in range(len(slots[s])):
                at = j % blocks[s] * block
                taken += max(0, min(at + block, start + n) - max(at, start))
            first = slots[s][start // block] if taken else None
            out[i] = (s, n, taken, first)
            for again in range(int(taken / n + 0.5) if n else 0):
                j = start // block + again * blocks[s]
                k = slots[s][j] if j < len(slots[s]) else j + sum(quota.values())
                order.append((k, start, i))
            start += n
    return out, [i for *_, i in sorted(order)], want, sizes


@pytest.mark.parametrize("seed,sources,block", [(1, ["a", "b", "c", "é", "Z"], 16), (2, ["a"] * 30 + ["b", None, "c"], 8)])
def test_mix(spark, seed, sources, block):
    rows = [(*r[:3], 7, 8, 9) for r in rows_of(seed, sources, 200)[:-1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _id int, _again int, k int")
    want, order, targets, sizes = brute_mix(rows, block)
    got = {r.doc_id: r for r in mixing.mixed(docs, block, least_slots=1).collect()}
    assert len(got) == len(rows)
    for i, (d, *_) in enumerate(rows):
        r = got[d]
        assert (r.source, r.size, r.taken, r.first_slot) == want[i]
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source]) and r.taken <= 3 * r.size
    again = mixing.mixed(docs.repartition(5), block, least_slots=1).collect()
    assert sorted(map(str, got.values())) == sorted(map(str, again))
    made = mixing.mix(docs, block, least_slots=1)
    assert made.columns == docs.columns and [r.doc_id for r in made.collect()] == [rows[i][0] for i in order]
    unordered = mixing.mix(docs, block, least_slots=1, ordered=False).collect()
    assert sorted(r.doc_id for r in unordered) == sorted(rows[i][0] for i in order)


def test_targets_are_met_and_the_sequence_decides(spark, monkeypatch):
    rows = [(i, " ".join(["w"] * (i % 90)), "abcdef"[i % 7 % 6]) for i in range(3000)]
    docs = spark.createDataFrame([*rows, (9999, "w " * 50_000, "long")], "doc_id long, text string, source string")
    got = mixing.mixed(docs).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 10 for s in target)  # blocks of one word here
    monkeypatch.setattr(mixing, "_GOLDEN", 3)
    other = mixing.mixed(docs).collect()
    assert sorted((r.doc_id, r.taken, r.first_slot or 0) for r in got) != sorted((r.doc_id, r.taken, r.first_slot or 0) for r in other)


def test_repeated_rows(spark):
    rows = [(5, "a b c", "x")] * 3 + [(5, "other words", "x"), (None, "no id", "y"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs).collect()
    assert len(got) == 6 and sum(r.taken for r in got) > 0
    assert {tuple(r) for r in mixing.mix(docs).collect()} <= set(rows)


def test_empty(spark):
    docs = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mixed(docs).collect()] == [(0.0, 0), (0.0, 0)]
    assert mixing.mixed(docs.where("false")).count() == 0
    assert mixing.mix(docs).count() == 0
