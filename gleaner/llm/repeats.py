"""Exact removal of repeated byte strings by partitioned suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in any
document. Only suffixes that can repeat are sorted:

1. Each window of ``length`` bytes is owned by one anchor, the leftmost minimum of the hashes of its
   ``gram``-byte strings. Equal windows have equal anchors at equal offsets, whatever surrounds them.
2. Anchors whose hash occurs at one place only own no repeated window. For the others, the bytes of
   the windows that they own are fetched from the texts (a join by text, so no text is broadcast).
3. Equal pieces are collapsed by partial aggregation, so a passage found in a third of all documents
   is one row with a mark. The suffixes of the different pieces of an anchor hash are put in order by
   deep-shallow sorting; neighbours equal over ``length`` bytes are repeats. Where a hash occurs at over
   ``hot_places`` places, the bytes that equal windows must share join its key, which cuts its group up.
4. Repeated runs go back to the texts that hold the piece, are united and cut out.

Equal texts are one text here; a text that occurs twice is cut out whole if it has ``length`` bytes.
Null text counts as empty; shorter texts lose nothing; repeated rows are copies of each other. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from gleaner.llm.suffixes import deep_shallow
from gleaner.llm.workspace import joined_small, staged

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_SEGMENT = 1 << 19  # windows handled at once; positions in a segment fit 20 bits
_PLACE = np.uint64((1 << 20) - 1)
TEXT = ["k1", "k2"]


@cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = _SEGMENT + (1 << 12)
    power, inverse = np.ones(n, np.uint64), np.ones(n, np.uint64)
    power[1:], inverse[1:] = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    table = np.random.default_rng(17).integers(0, 1 << 63, 256, dtype=np.uint64)
    return np.cumprod(power), np.cumprod(inverse), table


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    power, inverse, table = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * power[: len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * inverse[: len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, windows, anchor less first window) of the runs of windows with one owner."""
    out = []
    wide = length - gram + 1
    for low in range(0, len(data) - length + 1, _SEGMENT):
        some = data[low : low + _SEGMENT + length - 1]
        h = _gram_hashes(some, gram)
        key = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)  # ties go to the leftmost
        n = len(h) - wide + 1
        rows = -(-len(key) // wide)
        block = np.full(rows * wide, ~np.uint64(0))
        block[: len(key)] = key
        block = block.reshape(rows, wide)
        upto = np.minimum.accumulate(block, axis=1).ravel()
        beyond = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
        owner = (np.minimum(beyond[:n], upto[wide - 1 : wide - 1 + n]) & _PLACE).astype(np.int64)
        begins = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
        out.append((h[owner[begins]].view(np.int64), begins + low, np.diff(np.append(begins, n)), owner[begins] - begins))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def repeated_windows(pieces: list[bytes], group: np.ndarray, windows: np.ndarray, offset: np.ndarray, length: int) -> np.ndarray:
    """Which windows of the pieces (one flag each, piece after piece) equal one of another piece of the group.

    Windows of a group can only be equal at equal distances from their anchors, so (group, distance)
    leads the order.
    """
    data = np.frombuffer(b"".join(pieces), np.uint8)
    base = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])[:-1]
    piece = np.repeat(np.arange(len(pieces)), windows)
    within = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    primary = group[piece] * (length + 1) + offset[piece] - within
    order, equal = deep_shallow(data, base[piece] + within, primary, length)
    flags = np.zeros(len(piece), bool)
    flags[order[equal]] = True
    flags[order[np.flatnonzero(equal) - 1]] = True
    return flags


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, k1, k2, first, windows, offset), for the copies of a text in a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            found = []
            for text, *key in zip(batch.column("text"), batch.column("k1").to_pylist(), batch.column("k2").to_pylist()):
                if tuple(key) not in seen and len(text.as_buffer()) >= length:
                    seen.add(tuple(key))
                    h, first, windows, offset = anchors(np.frombuffer(text.as_buffer(), np.uint8), length, gram)
                    found.append((h, np.full(len(h), key[0]), np.full(len(h), key[1]), first, windows, offset))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names)

    names = ["h", "k1", "k2", "first", "windows", "offset"]
    long = texts.where(F.octet_length("text") >= length)
    return long.select("k1", "k2", "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def split_run(text: bytes, h: int, first: int, windows: int, offset: int, length: int, step: int = 16) -> Iterator[tuple[int, int, int, int]]:
    """Cut an anchor's windows into (key, first, windows, offset) of ``step`` distances from the anchor.

    All windows at distances [j, j + step) hold the bytes from ``j`` before the anchor to the end of
    the nearest-ending window; equal windows agree in them, so they go into the key.
    """
    anchor = first + offset
    for j in range((offset - windows + 1) // step * step, offset + 1, step):
        a, b = max(first, anchor - j - step + 1), min(first + windows, anchor - j + 1)
        core = text[anchor - j : anchor - j - step + 1 + length]
        yield xxhash.xxh64_intdigest(core + j.to_bytes(4, "little") + (h + (1 << 63)).to_bytes(8, "little")) - (1 << 63), a, b - a, anchor - a


def _pieces(found: DataFrame, length: int) -> DataFrame:
    """(h, c1, c2, k1, k2, first, windows, offset, piece) from rows with a text and its anchors.

    A hash found at very many places is replaced by keys of what lies around the anchor, so that its
    pieces are dealt to many tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                marks = [tuple(m.values()) for m in batch.column("marks")[i].as_py()]
                k1, k2 = batch.column("k1")[i].as_py(), batch.column("k2")[i].as_py()
                for k in range(0, len(marks), 20_000):
                    rows, seen = [], set()
                    for h, first, windows, offset, hot in marks[k : k + 20_000]:
                        parts = split_run(text, h, first, windows, offset, length) if hot else ((h, first, windows, offset),)
                        for key, a, n, away in parts:
                            piece = text[a : a + n + length - 1]
                            c1, c2 = (xxhash.xxh64_intdigest(piece, s) - (1 << 63) for s in (1, 2))
                            again = (key, c1, c2) in seen  # a period repeats its piece; its bytes travel once
                            seen.add((key, c1, c2))
                            rows.append((key, c1, c2, k1, k2, a, n, away, None if again else piece))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "piece" else pa.int64()) for n, c in zip(names, zip(*rows))], names)

    names = ["h", "c1", "c2", *TEXT, "first", "windows", "offset", "piece"]
    return found.mapInArrow(run, StructType([StructField(n, BinaryType() if n == "piece" else LongType()) for n in names]))


def _repeated_runs(kinds: DataFrame, length: int, most_windows: int = 400_000) -> DataFrame:
    """(h, c1, c2, low, high): runs of repeated windows of each different piece, from rows dealt by h."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        h = np.array([r[0] for r in rows])
        windows, offset = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
        group = np.concatenate([[0], np.cumsum(np.diff(h) != 0)])
        flags = np.zeros(windows.sum(), bool)
        start = np.cumsum(windows) - windows
        alone = np.bincount(group)[group] == 1
        if windows[~alone].sum() <= 2 * most_windows:
            steps = [(0, length)]
        else:  # one large group: a few distances from the anchor at a time
            step = max(1, most_windows // len(rows))
            steps = [(j, j + step) for j in range(0, length, step)]
        for low, high in steps:
            # Windows at distances [low, high) from the anchor: window t has distance offset - t.
            a, b = np.maximum(0, offset - high + 1), np.minimum(windows, offset - low + 1)
            use = np.flatnonzero(~alone & (b > a))
            if len(use):
                parts = [rows[i][6][a[i] : b[i] + length - 1] for i in use]
                got = repeated_windows(parts, group[use], (b - a)[use], (offset - a)[use], length)
                at = np.repeat(start[use] + a[use], (b - a)[use])
                at += np.arange(len(at)) - np.repeat(np.cumsum((b - a)[use]) - (b - a)[use], (b - a)[use])
                flags[at] |= got
        for i in np.flatnonzero([r[3] for r in rows]):  # found at several places
            flags[start[i] : start[i] + windows[i]] = True
        before = np.concatenate([[False], flags[:-1]])
        before[start] = False
        after = np.concatenate([flags[1:], [False]])
        after[start + windows - 1] = False
        low, high = np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after)
        piece = np.searchsorted(start, low, "right") - 1
        keys = [pa.array([rows[i][k] for i in piece], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays([*keys, pa.array(low - start[piece]), pa.array(high - start[piece] + length)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if size >= most_windows and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += row[4]
        if rows:
            yield solve(rows)

    names = ["h", "c1", "c2", "low", "high"]
    columns = ["h", "c1", "c2", "several", "windows", "offset", "piece"]
    return kinds.select(*columns).repartition("h").sortWithinPartitions("h").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _cut(found: DataFrame) -> DataFrame:
    """(k1, k2, n_removed, n_spans, kept_sha256) from rows with a text and its repeated runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                kept, at, spans, removed = hashlib.sha256(), 0, 0, 0
                end = -1
                for run_ in sorted((r["low"], r["high"]) for r in batch.column("runs")[i].as_py()):
                    low, high = run_
                    if low > end:
                        spans += 1
                        kept.update(text[at:low])
                        end = low
                    removed += max(0, high - end)
                    end = at = max(end, high)
                kept.update(text[at:])
                rows.append((removed, spans, kept.hexdigest()))
            values = [[r[k] for r in rows] for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), pa.array(values[0], pa.int64()), pa.array(values[1], pa.int64()), pa.array(values[2], pa.string())], schema.fieldNames()
            )

    schema = StructType([StructField(c, LongType()) for c in (*TEXT, "n_removed", "n_spans")] + [StructField("kept_sha256", StringType())])
    return found.mapInArrow(run, schema)


def removed(docs: DataFrame, length: int = 200, gram: int = 32, hot_places: int = 500, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    texts = _texts(docs, id_col, text_col)
    rows = staged(texts.select("id", *TEXT, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256")), "texts")
    # One document stands for each text; copies are known by their count.
    firsts = rows.groupBy(*TEXT).agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    firsts = staged(firsts, "firsts")

    marks = staged(_anchor_rows(texts, length, gram), "anchors")
    place = F.xxhash64(*TEXT, "first")
    several = marks.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b"), (F.count("*") > hot_places).alias("hot"))
    several = several.where("a <> b").select("h", "hot")
    several = staged(several, "repeated")
    marks = joined_small(marks, several, "h", "inner").distinct()
    per_text = marks.groupBy(*TEXT).agg(F.collect_list(F.struct("h", "first", "windows", "offset", "hot")).alias("marks"))
    per_text = staged(per_text.join(firsts.select("id", *TEXT), TEXT), "marked")
    pieces = staged(_pieces(_with_texts(texts, per_text, "marks"), length), "pieces")

    where = F.xxhash64(*TEXT, "first")
    kinds = pieces.groupBy("h", "c1", "c2").agg(
        (F.min(where) != F.max(where)).alias("several"), F.first("windows").alias("windows"), F.first("offset").alias("offset"),
        F.first("piece", ignorenulls=True).alias("piece"),
    )
    runs = staged(_repeated_runs(kinds, length), "runs")
    held = pieces.select("h", "c1", "c2", *TEXT, "first").join(runs, ["h", "c1", "c2"])
    spans = F.struct((F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high"))
    per_text = held.select(*TEXT, spans.alias("run")).groupBy(*TEXT).agg(F.collect_list("run").alias("runs"))
    once = firsts.where("copies = 1").select("id", *TEXT)
    cut = staged(_cut(_with_texts(texts, staged(per_text.join(once, TEXT), "cuts"), "runs")), "cut")

    more = staged(firsts.where("copies > 1").select(*TEXT, F.lit(True).alias("copied")), "copied")
    out = joined_small(joined_small(rows, cut, TEXT, "left"), more, TEXT, "left")
    whole = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= length)
    return out.select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )


def _with_texts(texts: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """(k1, k2, text, column) of the staged ``wanted`` rows; only wanted texts are dealt out."""
    ids = staged(wanted.select(F.col("id").alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2")), "wanted")
    same = texts["id"].eqNullSafe(ids["_id"]) & (texts["k1"] == ids["_k1"]) & (texts["k2"] == ids["_k2"])
    chosen = joined_small(texts, ids, same, "left_semi", 500_000)
    return chosen.select(*TEXT, "text").join(wanted.select(*TEXT, column), TEXT)
