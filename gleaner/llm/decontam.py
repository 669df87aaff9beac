"""Benchmark decontamination: SimHash of item-sized windows, multi-index blocks, exact verification.

Words are runs of letters, digits and underscores, lower-cased. Every window of a document that has
an item's number of words (a shorter document as a whole) is compared with the item by the SimHash of its word shingles (five words;
the whole item if it has fewer). The fingerprints of items are indexed by eight 8-bit blocks: a
fingerprint within ``radius`` differs in some block by at most radius div 8 bits, so a look at the
blocks finds all within the radius. Candidates are verified by the weighted Jaccard similarity of
the shingles, weighted by their counts.

A window that shares no shingle with an item has similarity 0, so fingerprints are made only where a
shingle of the item starts; this drops no match.

Items are taken in blocks of at most ``block_items`` items and ``block_chars`` characters (one longer
item is a block of its own), each sent to the tasks in full, and every document meets every block; no
document moves. The driver holds one block at a time: where there are several, each one's matches are
written before the next is read. Items and documents without words, and nulls, match
nothing; repeated items and documents are reported one by one. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from gleaner.llm.workspace import joined_small, staged

_WORD = re.compile(r"\w+")
BLOCKS = 8


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _bits(words: list[str], k: int) -> tuple[list[str], np.ndarray]:
    """The shingles of a run of words, and the 64 bits of each one's hash as rows."""
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    hashes = np.array([xxhash.xxh64_intdigest(s) for s in shingles], "<u8")
    return shingles, np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _fingerprints(counts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints from how many of n shingles have each bit, a row each."""
    return np.packbits(2 * counts > n, axis=-1, bitorder="little").view("<u8").reshape(-1)


class Index:
    """A block of items: their words, shingles, and fingerprints by blocks of bits."""

    def __init__(self, items: list[tuple[int | None, str | None]], radius: int, shingle: int) -> None:
        self.radius, self.items = radius, []
        self.vocabulary: dict[str, int] = {}
        self.starts: dict[int, dict[tuple[int, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
        self.blocks: dict[int, list[dict[int, list[int]]]] = {}
        flips = [sum(1 << b for b in c) for n in range(radius // BLOCKS + 1) for c in combinations(range(8), n)]
        for item_id, text in items:
            words = words_of(text or "")
            if not words:
                continue
            k, t = min(shingle, len(words)), len(self.items)
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for i in range(len(codes) - k + 1):
                self.starts[k][tuple(codes[i : i + k])].add(t)
            shingles, bits = _bits(words, k)
            fp = _fingerprints(bits.sum(axis=0, dtype=np.int64)[None], len(bits))[0]
            self.items.append((item_id, len(words), k, Counter(shingles), fp))
            tables = self.blocks.setdefault(len(words), [defaultdict(list) for _ in range(BLOCKS)])
            for b, table in enumerate(tables):
                value = int(fp) >> (8 * b) & 255
                for flip in flips:
                    table[value ^ flip].append(t)

    def within(self, n_words: int, fp: int) -> list[tuple[int, int]]:
        """(item, distance) of all items of that many words within the radius of ``fp``."""
        tables = self.blocks.get(n_words, ())
        found = {t for b, table in enumerate(tables) for t in table.get(fp >> (8 * b) & 255, ())}
        near = ((t, (fp ^ int(self.items[t][4])).bit_count()) for t in sorted(found))
        return [(t, d) for t, d in near if d <= self.radius]

    def search(self, text: str, least: float) -> dict[int, tuple[float, int, int]]:
        """item -> (similarity, first word of the window, distance), the best window of each item."""
        words = words_of(text)
        known = self.vocabulary.get
        codes = [known(w, 0) for w in words]
        best: dict[int, tuple[float, int, int]] = {}
        for k, starts in self.starts.items():
            windows: dict[int, set[int]] = defaultdict(set)  # words of a window -> where to look
            for i in self._runs(codes, k):
                for t in starts.get(tuple(codes[i : i + k]), ()):
                    m = self.items[t][1]
                    if len(words) < m:
                        windows[m].add(0)
                    else:
                        windows[m].update(range(max(0, i - m + k), min(i, len(words) - m) + 1))
            for m, at in windows.items():
                self._match(words, m, k, sorted(at), least, best)
        return best

    @staticmethod
    def _runs(codes: list[int], k: int) -> list[int]:
        """Where k words in a row are all in the vocabulary."""
        if len(codes) < k:
            return []
        unknown = np.concatenate([[0], np.cumsum(np.array(codes) == 0)])
        return np.flatnonzero(unknown[k:] == unknown[: len(unknown) - k]).tolist()

    def _match(self, words: list[str], m: int, k: int, at: list[int], least: float, best: dict[int, tuple[float, int, int]]) -> None:
        cut = [0, *(i for i in range(1, len(at)) if at[i] > at[i - 1] + m), len(at)]
        for a, b in zip(cut, cut[1:]):
            for c in range(a, b, 4096):  # bounds memory where most of a long text matches
                some = at[c : min(b, c + 4096)]
                self._match_run(words, m, k, some, least, best)

    def _match_run(self, words: list[str], m: int, k: int, at: list[int], least: float, best: dict[int, tuple[float, int, int]]) -> None:
        low = at[0]
        shingles, bits = _bits(words[low : at[-1] + m], k)
        sums = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(bits, axis=0, dtype=np.int64)])
        offsets, n = np.array(at) - low, min(m, len(words)) - k + 1
        for s, fp in zip(offsets.tolist(), _fingerprints(sums[offsets + n] - sums[offsets], n).tolist()):
            for t, d in self.within(m, fp):
                here, there = Counter(shingles[s : s + n]), self.items[t][3]
                both = sum((here & there).values())
                found = (both / (n + m - k + 1 - both), low + s, d)
                if found[0] >= least and (t not in best or (-found[0], found[1]) < (-best[t][0], best[t][1])):
                    best[t] = found


def blocks_of(items: Iterable[tuple], most_items: int, most_chars: int) -> Iterator[list[tuple]]:
    """Runs of items within both bounds, in their order; an item over the second is a run of its own."""
    block, chars = [], 0
    for item in items:
        size = len(item[1] or "")
        if block and (len(block) == most_items or chars + size > most_chars):
            yield block
            block, chars = [], 0
        block.append(item)
        chars += size
    if block:
        yield block


def matches(
    docs: DataFrame, items: DataFrame, least: float = 0.8, radius: int = 20, shingle: int = 5, block_items: int = 20_000, block_chars: int = 20_000_000,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(id, item, similarity, start, n_words, distance): the best window of each item in each document; n_words are the item's."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = items.schema[item_col].dataType
    schema = StructType([
        slim.schema["id"], StructField("item", kind), StructField("similarity", DoubleType()),
        StructField("start", LongType()), StructField("n_words", IntegerType()), StructField("distance", IntegerType()),
    ])

    def one(block: list[tuple]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(block, radius, shingle)
            for batch in batches:
                at, rows = [], []
                for i, text in enumerate(batch.column("text")):
                    for t, (similarity, start, d) in sorted(index.search(text.as_py() or "", least).items()):
                        at.append(i)
                        rows.append((index.items[t][0], similarity, start, index.items[t][1], d))
                columns = [batch.column("id").take(pa.array(at, pa.int64()))]
                columns += [pa.array([r[k] for r in rows], x) for k, x in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, names)

        return slim.mapInArrow(run, schema)

    names = schema.fieldNames()
    types = [to_arrow_type(f.dataType) for f in schema.fields[1:]]
    stream = blocks_of(((r[0], r[1]) for r in items.select(item_col, item_text_col).toLocalIterator()), block_items, block_chars)
    block = next(stream, None)
    parts = []
    while block is not None:
        part, block = one(block), next(stream, None)
        parts.append(part if block is None and not parts else staged(part, "matches"))
    if not parts:
        parts = [docs.sparkSession.createDataFrame([], schema)]
    return reduce(DataFrame.unionByName, parts).withColumnsRenamed({"id": id_col, "item": item_col if item_col != id_col else "item_id"})


def clean(docs: DataFrame, items: DataFrame, least: float = 0.8, radius: int = 20, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a match, with their own columns; rows that share an id are judged apart."""
    named = docs.withColumn("_row", F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text")))
    bad = matches(named, items, least, radius, shingle, id_col="_row", text_col=text_col, item_col=item_col, item_text_col=item_text_col)
    bad = staged(bad.select(F.col("_row").alias("_bad")).distinct(), "leaks")
    return joined_small(named, bad, F.col("_row") == F.col("_bad"), "left_anti").drop("_row")
