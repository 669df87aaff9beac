import random
import zlib

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

from gleaner.llm import tokens
from gleaner.llm.workspace import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole(texts):
    t = Tokenizer.from_file(PATH)  # the plain call of the library
    return [np.array([*e.ids, 0], "<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


def hashed(text):
    """Spark's xxhash64 of a string."""
    return 42 if text is None else np.int64(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)))


def odd_texts(n):
    rng = random.Random(9)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "\x1c", "\x85", "​", "a", "The", "don't", "'s", "123", "é", "日本", "!?", "_", "|", "<|endoftext|>", "🙂", "\x00"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(n)]


def test_pieces_encode_like_whole_texts():
    texts = odd_texts(20_000) + ["", " ", "  x", "x  ", " x \n y", "a" * 5000, "a <|endoftext|> b", "word, word.\nWord's end!"]
    want = [w.tolist() for w in whole(texts)]
    for most in (100, 10_000):
        encoder = tokens.Encoder(PATH, 0, most)
        got = [g for k in range(0, len(texts), 500) for g in encoder.encode(texts[k : k + 500])]
        assert encoder.cuts and [np.frombuffer(g, "<u2").tolist() for g in got] == want
    strict = tokens.Encoder(PATH, 0, special_as_text=True).encode(["a <|endoftext|> b"])[0]
    assert 50256 in want[-2] and 50256 not in np.frombuffer(strict, "<u2").tolist()


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, texts = tokens.Encoder(path, 0), ["The end.\nNow", "  a  b ", ""]
    assert not encoder.cuts
    want = [[*e.ids, 0] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u2").tolist() for g in encoder.encode(texts)] == want


def test_round_trip(spark):
    texts = odd_texts(400)
    rows = [(i * 7 % 400, t, 0) for i, t in enumerate(texts)] + [(None, "no id", 0), (1000, None, 0), (5, "again", 0), (5, "again", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, file int")
    path = new_path(spark, "tokens")
    manifest = tokens.write(docs.repartition(3), path, PATH)
    got = tokens.read(spark, path, manifest).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed(r[1])))
    order = [(d, t or "") for d, t, _ in order]
    ids = whole([t for _, t in order])
    ends = np.cumsum([len(x) for x in ids]).tolist()
    want = [(d, e - len(x), len(x), zlib.crc32(x.tobytes())) for (d, _), x, e in zip(order, ids, ends)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    first = min(manifest.collect(), key=lambda r: r.part)
    held = tokens.TokenFile(path, first.file)
    assert held.ids()[0].as_py() is None and held.tokens(0).tolist() == whole(["no id"])[0].tolist()


def test_empty(spark):
    path = new_path(spark, "tokens")
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.read(spark, path, tokens.write(docs, path, PATH)).count() == 0


def test_ids_of_any_type_and_one_hot_id(spark):
    rows = [("hot", f"text {i % 50} of {i}", 1) for i in range(600)] + [(None, None, 2), ("é", "x " * 60_000, 3)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, start int")
    found = []
    for parts in (1, 6):
        path = new_path(spark, "tokens")
        manifest = tokens.write(docs.repartition(parts), path, PATH)
        found.append(sorted(map(tuple, tokens.read(spark, path, manifest, docs.schema["doc_id"].dataType).collect()), key=lambda r: r[1]))
    assert found[0] == found[1] and len(found[0]) == 602  # the order within an id hangs on the texts alone
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", hashed(r[1])))
    assert [r[3] for r in found[0]] == [zlib.crc32(x.tobytes()) for x in whole([t or "" for _, t, _ in order])]
