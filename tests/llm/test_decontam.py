import random
from collections import Counter

from gleaner.llm import decontam


def brute(rows, items, least=0.8):
    found = {}
    for d, text, _ in rows:
        words = decontam.words_of(text or "")
        for t, item in items:
            want = decontam.words_of(item or "")
            m, k = len(want), min(5, len(want))
            if not m:
                continue
            grams = lambda x, k=k: Counter(" ".join(x[i : i + k]) for i in range(len(x) - k + 1))
            there = grams(want)
            for s in range(len(words) - m + 1):
                here = grams(words[s : s + m])
                value = sum((here & there).values()) / sum((here | there).values())
                if value >= least and value > found.get((d, t), (0,))[0]:
                    found[d, t] = (value, s)
    return found


def test_matches(spark):
    rng = random.Random(4)
    vocab = [f"w{i}é" for i in range(80)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([1, 3, 5, 8, 20, 40, 60])))) for i in range(30)] + [(30, None), (31, " ..."), (32, "a b c d e f " * 6)]
    items.append((33, items[6][1]))
    rows = []
    for d in range(120):
        text = say(rng.choice([0, 3, 50, 150]))
        if d % 3 == 0:
            item = decontam.words_of(items[rng.randrange(30)][1])
            for _ in range(rng.choice([0, 0, 1, 2])):
                item[rng.randrange(len(item))] = "edit"
            at = rng.randint(0, len(text))
            text[at:at] = [x.upper() + "," for x in item]
        rows.append((d, " ".join(text), 1))
    rows += [(500, None, 1), (501, "a b c d e f " * 50, 1), (501, "a b c d e f " * 50, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    for block in (20_000, 7):
        out = decontam.matches(docs.drop("item_id"), bench, block_items=block).collect()
        got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in out}
        assert got == want
        assert len(out) == len(got) + 1
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _, _ in rows} - {d for d, _ in want}
    assert decontam.matches(docs, bench.where("false")).count() == 0
    assert decontam.matches(docs.where("false"), bench).count() == 0


def test_blocks_find_all_within_radius():
    rng = random.Random(1)
    items = [(i, " ".join(f"v{rng.randrange(50)}" for _ in range(30))) for i in range(200)]
    index = decontam.Index(items, 20, 5)
    for _ in range(300):
        fp = int(index.items[rng.randrange(200)][4])
        for b in rng.sample(range(64), rng.randint(0, 24)):
            fp ^= 1 << b
        want = [(t, (fp ^ int(x[4])).bit_count()) for t, x in enumerate(index.items)]
        assert index.within(30, fp) == [(t, d) for t, d in want if d <= 20]


def test_rows_of_one_id_are_judged_apart(spark):
    rows = [(None, "a b c d e f g"), (None, "clean"), (None, None), (1, "x a b c d e f g"), (1, "clean, too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = decontam.clean(docs, spark.createDataFrame([(0, "a b c d e f g")], "item_id long, text string"))
    assert {tuple(r) for r in kept.collect()} == {(None, "clean"), (None, None), (1, "clean, too")}


def test_documents_shorter_than_the_item():
    words = [f"w{i}" for i in range(38)]
    index = decontam.Index([(0, " ".join(words))], 20, 5)
    assert index.search(" ".join(words[:-1]), 0.8)[0][:2] == (33 / 34, 0)
    assert index.search(" ".join(words[3:-3]), 0.8)[0][:2] == (28 / 34, 0)
    assert not index.search(" ".join(words[4:-3]), 0.8) and not index.search(" ".join(words[:4]), 0.8)


def test_blocks_hold_every_item_within_both_bounds():
    items = [(0, "a" * 30), (1, None), (2, "b" * 200), (3, ""), (4, "c" * 60), (5, "d" * 41)]
    blocks = list(decontam.blocks_of(iter(items), 3, 100))
    assert blocks == [items[:2], items[2:3], items[3:5], items[5:]]
    assert list(decontam.blocks_of(iter(items), 2, 10_000)) == [items[:2], items[2:4], items[4:]]
    assert not list(decontam.blocks_of(iter([]), 2, 10))


def test_recall_of_windows_near_the_threshold():
    """Edited items with a similarity of 0.8 to 0.85: the Hamming step may lose one in a thousand or so."""
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(400)]
    near = found = 0
    while near < 1500:
        item = [rng.choice(vocab) for _ in range(rng.choice([40, 80, 160]))]
        edited = list(item)
        for _ in range(len(item) // 40):
            edited[rng.randrange(len(item))] = "edit"
        index = decontam.Index([(0, " ".join(item))], 20, 5)
        exact = decontam.Index([(0, " ".join(item))], 64, 5)
        best = exact.search(" ".join(edited), 0.5).get(0)
        if best and 0.8 <= best[0] < 0.85:
            near += 1
            found += 0 in index.search(" ".join(edited), 0.8)
    assert found >= 0.995 * near


def test_a_long_text_is_searched_whole():
    rng = random.Random(3)
    item = [f"w{rng.randrange(60)}" for _ in range(30)]
    noise = [f"w{rng.randrange(60)}" for _ in range(60_000)]
    index = decontam.Index([(0, " ".join(item))], 20, 5)
    assert index.search(" ".join(noise + item), 0.8)[0][:2] == (1.0, 60_000)
    assert 0 in index.search(" ".join(item * 2_000), 0.8)
