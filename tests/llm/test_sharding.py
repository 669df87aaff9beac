import struct
import zlib
from math import isqrt

import xxhash
from pyspark.sql import functions as F

from gleaner.llm import sharding


def test_shards_are_a_gapless_permutation(spark):
    rows = [(i * 7 % 500, f"text {i}é", 1) for i in range(500)] + [(None, None, 2), (3, "", 0), (3, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    out = sharding.sharded(docs, 24).collect()
    assert len(out) == 503 and sorted(r.position for r in out) == list(range(503))
    sizes = {}
    for r in out:
        sizes.setdefault(r.shard, []).append(r.slot)
    assert len(sizes) == 24 and all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    texts = {(i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t, _ in rows}
    assert {(r.doc_id, r.text_crc32, r.size) for r in out} == texts
    again = sharding.sharded(docs.repartition(3), 24).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    order = [r.doc_id for r in sorted(out, key=lambda r: r.row_number)]
    assert order == sorted(order, key=lambda x: -1 if x is None else x)
    assert [r.position for r in sorted(out, key=lambda r: r.row_number)] != list(range(503))


def test_small_and_empty(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [(r.shard, r.slot) for r in sharding.sharded(docs, 24).collect()] == [(0, 0)]
    assert sharding.sharded(docs.where("false"), 24).count() == 0
    for n in (2, 3, 7, 64, 1000):
        got = [r.p for r in spark.range(n).select(sharding.permuted(F.col("id"), n).alias("p")).collect()]
        assert sorted(got) == list(range(n))


def brute_place(x, n, seed=7, rounds=6):
    """The permutation in plain Python, with a walk of any length."""

    def mixed(value, i):
        h = 42
        for raw in (struct.pack("<q", value), struct.pack("<i", i), struct.pack("<i", seed)):
            h = xxhash.xxh64_intdigest(raw, h)
        return h - (1 << 64) if h >> 63 else h

    a = isqrt(n - 1) + 1
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for i in range(rounds):
            if i % 2 == 0:
                left = (left + int(mixed(right, i)) % a) % a
            else:
                right = (right + int(mixed(left, i)) % b) % b
        x = left * b + right
        if x < n:
            return x


def test_places_match_an_independent_permutation(spark):
    for n in (1, 2, 3, 5, 17, 90, 401, 1000, 10_007):
        got = {r.id: r.p for r in spark.range(n).select("id", sharding.permuted(F.col("id"), n).alias("p")).collect()}
        assert got == {x: brute_place(x, n) for x in range(n)}
    n = 10**12 + 39
    ids = [0, 1, n // 3, n - 1]
    got = [r.p for r in spark.createDataFrame([(i,) for i in ids], "id long").select(sharding.permuted(F.col("id"), n).alias("p")).collect()]
    assert got == [brute_place(x, n) for x in ids]


def test_shard_and_slot_follow_from_the_row_number(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(300)], "doc_id long, text string")
    for r in sharding.sharded(docs, 24).collect():
        place = brute_place(r.row_number, 300)
        assert r.row_number == r.doc_id and (r.position, r.shard, r.slot) == (place, place % 24, place // 24)
