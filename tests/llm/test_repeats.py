import hashlib
import random
from collections import Counter

import numpy as np

from gleaner.llm import repeats
from gleaner.llm.suffixes import deep_shallow


def brute(texts, length=200):
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_deep_shallow_orders_suffixes():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[500:900] = data[1500:1900]
    data[2000:2400] = 97
    pos = rng.permutation(2900)
    primary = rng.integers(0, 3, 2900)
    order, equal = deep_shallow(data, pos, primary, 100, shallow=16)
    keys = [(primary[i], data[pos[i] : pos[i] + 100].tobytes()) for i in order]
    assert keys == sorted(keys)
    assert equal.tolist() == [False] + [a == b for a, b in zip(keys, keys[1:])]
    assert equal.sum() > 300


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(4)
    same = rng.integers(0, 256, 400).astype(np.uint8)
    same[100:300] = 7
    a, b = (np.concatenate([rng.integers(0, 256, n).astype(np.uint8), same, rng.integers(0, 256, 50).astype(np.uint8)]) for n in (10, 333))

    def owners(data):
        out = {}
        for h, first, windows, offset in zip(*repeats.anchors(data, 200, 32)):
            for t in range(windows):
                out[first + t] = (h, offset - t)
        return out

    x, y = owners(a), owners(b)
    assert len(x) == len(a) - 199
    assert all(x[10 + i] == y[333 + i] for i in range(201))


def corpus():
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [noise(n) for n in (199, 200, 201, 260, 700)]
    rows = []
    for i in range(150):
        parts = [noise(rng.choice([0, 5, 150, 600]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(passages)
            cut = rng.randrange(0, 40)
            parts += [p[cut:], noise(rng.choice([0, 1, 100]))]
        rows.append("".join(parts))
    near = noise(1500)
    for _ in range(20):
        k = rng.randrange(1500)
        rows.append(near[:k] + "#" + near[k + 1 :])
    rows += [near, near, near[:199], near[:199], "z" * 1000, "xy" * 300, "é" * 200, noise(300) * 2, None, None, "", "short", noise(50)]
    return rows


def test_removed(spark, monkeypatch):
    texts = corpus()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(7, texts[7], "x"), (None, texts[60], "x"), (None, "q" * 10 + texts[170][:900], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string")
    want = [(d, *x) for (d, _, _), x in zip(rows, brute([(t or "").encode() for _, t, _ in rows]))]
    assert sum(w[2] > 0 for w in want) > 60
    for parts in (1, 4):
        got = [tuple(r) for r in repeats.removed(docs.repartition(parts)).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
    got = [tuple(r) for r in repeats.removed(docs, hot_places=1).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    once = repeats._repeated_runs
    monkeypatch.setattr(repeats, "_repeated_runs", lambda kinds, length: once(kinds, length, most_windows=100))
    monkeypatch.setattr(repeats, "_SEGMENT", 300)
    got = [tuple(r) for r in repeats.removed(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert repeats.removed(docs.where("false")).count() == 0
