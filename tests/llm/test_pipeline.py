import random
import zlib
from collections import Counter, defaultdict
from hashlib import md5

import numpy as np
import pytest
from test_decontam import brute as leaks
from test_mixing import brute_targets
from test_quality import brute as measures
from test_simhash import shingles, union
from test_tokens import whole

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def expected(rows, items):
    """The pipeline's rows by brute force; hosts are assumed to pass."""
    def good(t):
        m = measures(t)
        return m[0] >= 50 and 100 * m[4] <= 50 * m[0]

    rows = [r for r in rows if good(r[1])]
    sets = [shingles(r[1]) for r in rows]
    root = union([(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])], range(len(rows)))
    least = {}
    for i, r in enumerate(rows):
        least[root[i]] = min(r[0], least.get(root[i], r[0]))
    rows = [r for i, r in enumerate(rows) if r[0] == least[root[i]]]
    bad = {d for d, _ in leaks([(d, t, s) for d, t, s in rows], items)}
    rows = [r for r in rows if r[0] not in bad]
    sizes, streams = defaultdict(int), defaultdict(list)
    for d, t, s in rows:
        sizes[s] += measures(t)[0]
        streams[s].append((md5(f"11|{d}".encode()).hexdigest(), measures(t)[0], d, t))
    target, out = brute_targets(sizes), []
    for s, docs in streams.items():
        full, rest = divmod(min(int(target[s] + 0.5), 3 * sizes[s]), sizes[s])
        at = 0
        for _, n, d, t in sorted(docs):
            out += [(d, t)] * int((full * n + max(0, min(n, rest - at))) / n + 0.5)
            at += n
    return sorted(out)


def test_run(spark, tmp_path):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(say(25))) for i in range(5)]
    rows = []
    for i in range(90):
        text = say(rng.choice([120, 200, 300]))
        if i % 6 == 0:
            text = say(20) if i % 12 else ["same", "old", "line"] * 40
        if i % 7 == 0:
            text[60:60] = items[i % 5][1].split()
        rows.append((i, " ".join(text), f"src{i % 4}"))
        if i % 5 == 0:
            rows.append((1000 + i, rows[-1][1], "src0"))
        if i % 8 == 0:
            rows.append((2000 + i, rows[-1][1].replace(" ", " new ", 1), "src1"))
    docs = [(d, t, "en", s, len(t)) for d, t, s in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = expected(rows, items)
    ids = whole([t for _, t in want])
    ends = np.cumsum([len(x) for x in ids]).tolist()
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == sorted((d, e - len(x), len(x), zlib.crc32(x.tobytes())) for (d, _), x, e in zip(want, ids, ends))
    assert 0 < len(Counter(d for d, _ in want)) < len(rows)


def test_stages_keep_columns(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0
