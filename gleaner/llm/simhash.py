"""SimHash near-duplicates: exact links within a Hamming radius by vantage-point trees.

Fingerprints. A text is lower-cased in A-Z, cut into words at ASCII white space and into word
shingles joined by a space; a fingerprint bit is set if it is set in over half of the shingles'
XXH64 hashes. Shorter texts count as one shingle; texts without words and null get fingerprint zero
and link like any other.

Links. Two fingerprints that differ in at most r bits differ in at most r div 2 bits in one of their
halves. Each half has a vantage-point tree: a node measures the Hamming distance d of the half to
its vantage point; distances up to the node's boundary go inside, larger ones outside. By the
triangle inequality two halves within r div 2 have distances that differ by no more than that, so a
fingerprint just beyond the boundary is sent inside, too: every linked pair meets in a leaf, and no
other branch needs to be searched for it. Leaves are the shards of the search. A leaf reports its
connected pieces, not its pairs, and pieces are merged by distributed star contraction. A leaf with
too many fingerprints is cut into blocks and every pair of blocks becomes a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from gleaner.llm.components import components
from gleaner.llm.workspace import alone, give_back, joined_small, small_batches, staged

_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: bytes, shingle: int, seed: int = 42) -> np.ndarray:
    """XXH64 of a text's shingles in order, repeats included; shorter texts count as one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    size = min(shingle, len(words))
    xxh64 = xxhash.xxh64_intdigest
    return np.array([xxh64(joined[a : b - 1], seed) for a, b in zip([0, *ends], ends[size - 1 :])], "<u8")


def folded(hashes: np.ndarray) -> int:
    """The 64-bit SimHash of hashes, as a signed number."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):  # bounds memory for long texts
        some = hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text, as a signed number."""
    return folded(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py() or b"", shingle, seed) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps, pa.int64())], ["id", "fp"])

    return slim.mapInArrow(run, StructType([slim.schema["id"], StructField("fp", LongType())]))


def vantage(node: np.ndarray, half: int, width: int = 32) -> np.ndarray:
    """The vantage point of each tree node, ``width`` bits of a fixed mix of its number."""
    x = (node.astype(np.uint64) * np.uint64(2) + np.uint64(half + 1)) * _MIX
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - width)).astype(np.uint32)


def leaves(fps: np.ndarray, depth: int, radius: int = 3, width: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, index into fps) of all places in the two trees, over ``width`` bits each, of the given depth."""
    slack, boundary, mask = radius // 2, width // 2 - 1, np.uint64((1 << width) - 1)
    out_leaf, out_at = [], []
    for half in (0, 1):
        part = (fps.view(np.uint64) >> np.uint64(width * half) & mask).astype(np.uint32)
        node, at = np.ones(len(fps), np.int64), np.arange(len(fps))
        for _ in range(depth):
            d = np.bitwise_count(part[at] ^ vantage(node, half, width))
            inside, outside = d <= boundary + slack, d > boundary
            node = np.concatenate([2 * node[inside], 2 * node[outside] + 1])
            at = np.concatenate([at[inside], at[outside]])
        out_leaf.append(2 * node + half)
        out_at.append(at)
    return np.concatenate(out_leaf), np.concatenate(out_at)


def pieces(fps: np.ndarray, radius: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(member, least member) for all but the least member of each connected piece of distinct ``fps``.

    A flood: each fingerprint is compared with those not reached yet. What it reaches leaves the
    rest, so a dense cluster costs about one pass and sparse points a triangle of vector work.
    """
    rest = np.unique(fps.view(np.uint64))
    member, root = [], []
    while len(rest) > 1:
        queue, rest, got = [rest[:1]], rest[1:], [rest[:1]]
        while queue and len(rest):
            wave = np.concatenate(queue)
            queue = []
            for x in wave:
                near = np.bitwise_count(rest ^ x) <= radius
                if near.any():
                    queue.append(rest[near])
                    got.append(rest[near])
                    rest = rest[~near]
                    if not len(rest):
                        break
        if len(got) > 1:
            whole = np.concatenate(got).view(np.int64)
            least = whole.min()
            whole = whole[whole != least]
            member.append(whole)
            root.append(np.full(len(whole), least))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *member]), np.concatenate([none, *root])


def _dealt(placed: DataFrame, key: str, most_rows: int) -> DataFrame:
    """Rows of leaves as tasks (leaf, i, j): a leaf over ``most_rows`` is cut into blocks, and all pairs of them meet."""
    # At most (placed rows / most_rows) leaves are too large: a list that is small beside a task's rows.
    large = placed.groupBy("leaf").count().where(F.col("count") > most_rows)
    large = staged(large.select("leaf", F.ceil(F.col("count") / most_rows).cast("int").alias("blocks")), "leaves")
    blocked = joined_small(placed, large, "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    blocked = blocked.withColumn("b", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"))
    blocked = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return blocked.withColumns({"i": F.least("b", "other"), "j": F.greatest("b", "other")}).drop("b", "other", "blocks")


def links(distinct: DataFrame, radius: int = 3, leaf_rows: int = 4096, most_rows: int = 1 << 16) -> DataFrame:
    """(u, v) edges that connect exactly the fingerprints (column fp, distinct, staged) within ``radius``."""
    depth, rows = 0, distinct.count()
    while rows * 1.15**depth / 2**depth > leaf_rows:
        depth += 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            leaf, at = leaves(fps, depth, radius)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(fps[at])], ["leaf", "fp"])

    tasks = _dealt(distinct.mapInArrow(place, "leaf long, fp long"), "fp", most_rows)

    def search(table: pa.Table) -> pa.Table:
        member, root = pieces(table.column("fp").to_numpy(), radius)
        return pa.table({"u": member, "v": root})

    return tasks.groupBy("leaf", "i", "j").applyInArrow(search, "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) of every row; the component's least id names it.

    Equal fingerprints are collapsed before the search, so exact copies never multiply. Rows with a
    null id take part and get the least other id of their component, or null.
    """
    rows = staged(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    groups = staged(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "distinct")
    roots = components(links(groups.select("fp"), radius)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    roots = roots.unionByName(roots.select(F.col("root").alias("fp"), "root").distinct())
    rooted = groups.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("size")).where("size > 1")
    member = staged(rooted.select("fp", "root").join(named, "root").select("fp", "component_id"), "components")
    # Only components of two rows or more are joined back; the hot side is the rows, which may be split.
    return joined_small(rows, member, "fp", "left").select(F.col("id").alias(id_col), "fp", F.coalesce("component_id", "id").alias("component_id"))


FOLDS = [f"f{k}" for k in range(6)]  # fingerprints of a set in the search for near copies
RADIUS = 5  # of that search: at most two bits of one half, which a pair of similarity 0.8 has in one of twelve halves with 0.77, of 0.9 with 0.99
BITS = 768  # of a parity bitmap
BITMAP = [f"s{k}" for k in range(BITS // 64)]
LONG, LONG_BITS = 1000, 1 << 14  # sets beyond that size have a second, longer bitmap, as theirs of ``BITS`` is full
PLACE = ["leaf", "uid", "size", "pos", "root"]  # of a text in the group of a shingle
HEADS = [f"h{k}" for k in range(4)]  # first groups of a text that it shares
_SLACK = 1e-6  # of comparisons with products of a similarity: errors of rounding never drop a pair


def shingle_set(text: bytes, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """The distinct XXH64 hashes of a text's shingles, ascending; shorter texts count as one shingle."""
    hashes = shingle_hashes(text, shingle, seed)
    return np.unique((hashes if len(hashes) else np.array([xxhash.xxh64_intdigest(b"", seed)], np.uint64)).view(np.int64))


def folds(hashes: np.ndarray) -> list[int]:
    """Independent SimHash fingerprints, one for each of ``FOLDS``; the first is that of the hashes themselves."""
    out, x = [], hashes.view(np.uint64)
    for _ in FOLDS:
        out.append(folded(x))
        x = (x + _MIX) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
    return out


def reached(keys: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): places of distinct ``keys`` that differ in at most ``radius`` bits, as a forest over their connected pieces; a flood as in ``pieces``."""
    rest = np.arange(len(keys))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(rest) > 1:
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            for x in queue.pop():
                near = np.bitwise_count(keys[rest] ^ keys[x]) <= radius
                if near.any():
                    a.append(np.full(near.sum(), x))
                    b.append(rest[near])
                    queue.append(rest[near])
                    rest = rest[~near]
    return np.concatenate(a), np.concatenate(b)


def alike(texts: DataFrame, radius: int = RADIUS, leaf_rows: int = 12_000, most_rows: int = 1 << 16) -> DataFrame:
    """(u, v) texts that ``radius`` div 2 bits part in a half of one of their fingerprints, by the trees of ``links``.

    ``texts`` has uid and ``FOLDS``, staged. Each half has trees over its own halves: their smaller slack
    makes fewer replicas, which grow with the power 1.35 of the texts (1.53 with one tree a half). A leaf reports a forest over such pairs, never all of a dense cluster.
    """
    depth, rows = 0, texts.count()
    while rows * (1.2 / 2) ** depth > leaf_rows:
        depth += 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column("uid").to_numpy()
            for k, name in enumerate(FOLDS):
                fps = batch.column(name).to_numpy()
                for half in (0, 1):
                    key = (fps.view(np.uint64) >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF)).astype(np.int64)
                    leaf, at = leaves(key, depth, radius // 2, 16)
                    yield pa.RecordBatch.from_arrays([pa.array((2 * leaf + half) * len(FOLDS) + k), pa.array(key[at]), pa.array(uid[at])], ["leaf", "key", "uid"])

    tasks = _dealt(texts.mapInArrow(place, "leaf long, key long, uid long"), "uid", most_rows)

    def search(table: pa.Table) -> pa.Table:
        key, uid = table.column("key").to_numpy().astype(np.uint32), table.column("uid").to_numpy()
        order = np.lexsort((uid, key))
        uid = uid[order]
        keys, first, of = np.unique(key[order], return_index=True, return_inverse=True)
        a, b = reached(keys, radius // 2)
        u, v = np.concatenate([uid[first[of]], uid[first[a]]]), np.concatenate([uid, uid[first[b]]])
        return pa.table({"u": np.minimum(u, v)[u != v], "v": np.maximum(u, v)[u != v]})

    return tasks.groupBy("leaf", "i", "j").applyInArrow(search, "u long, v long").distinct()


def bitmap(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """``bits`` parities as signed 64-bit numbers: two sets differ in at least as many members as their bitmaps in bits."""
    odd = np.bincount((hashes.view(np.uint64) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def prefix_length(n: int, similarity: float) -> int:
    """How many of a set's n members, in an order common to all, must hold one of any set of that similarity."""
    return min(n, n - ceil(similarity * n - _SLACK) + 1)


def _frequent(slim: DataFrame, shingle: int, sample_docs: int = 10_000, most: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """(hash, estimated texts) of shingles found in three texts or more of a sample; hashes ascend.

    The estimate orders shingles and cuts large groups into blocks; results do not depend on it.
    """
    every = -(-max(1, slim.count()) // sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text.as_py() or b"", shingle))], ["h"])

    some = slim.select("text").where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).mapInArrow(run, "h long")
    top = some.groupBy("h").count().where("count > 2").orderBy(F.desc("count"), "h").limit(most).collect()
    top = np.array(sorted((r["h"], r["count"] * every) for r in top), np.int64).reshape(-1, 2)
    return top[:, 0].copy(), top[:, 1].copy()


def _looked_up(known: np.ndarray, value: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The value of each hash, 0 where it is not known."""
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, value[at], 0)


def group_pairs(leaf: np.ndarray, size: np.ndarray, pos: np.ndarray, similarity: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(d, a, b): places of the members of each group that may be that similar, d apart; sorted by leaf and size.

    Sizes within the similarity and a bound on what is in common before and after the shared member
    are necessary, so nothing that is similar is left out. The last pair of arrays is empty.
    """
    at, d = np.arange(len(leaf)), 0
    while len(at):
        d += 1
        at = at[: np.searchsorted(at, len(leaf) - d)]
        at = at[(leaf[at + d] == leaf[at]) & (size[at] >= similarity * size[at + d] - _SLACK)]
        a, b = at, at + d
        common = np.minimum(pos[a], pos[b]) + np.minimum(size[a] - pos[a], size[b] - pos[b])
        near = common * (1 + similarity) >= similarity * (size[a] + size[b]) - _SLACK
        yield d, a[near], b[near]


def own_bits(n: int) -> int:
    """Length of the bitmap that tells sets of n members from unrelated ones: a power of two, over half of n."""
    return min(LONG_BITS, max(1024, 1 << ceil(0.55 * n - 1).bit_length()))


def shortened(words: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps of powers of two words, ``length`` of ``words`` from ``start``, as those of ``width`` words: their halves are added up."""
    out = words[start[:, None] + np.arange(width)]
    for k in range(width, int(length.max(initial=0)), width):
        longer = np.flatnonzero(length > k)
        out[longer] ^= words[start[longer, None] + k + np.arange(width)]
    return out


def fresh_pairs(leaf: np.ndarray, root: np.ndarray, size: np.ndarray, bits: np.ndarray, own: tuple[np.ndarray, np.ndarray, np.ndarray], heads: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (a, b) that are not connected, that no bitmap rejects and that no other group reports.

    Two texts that have one of their ``heads`` in common meet in its group, too, so of all the groups
    that they share only that with the least such head reports them.
    """
    fresh = root[a] != root[b]
    a, b = a[fresh], b[fresh]
    both = heads[a][:, :, None] == heads[b][:, None, :]
    least = np.where(both, heads[a][:, :, None], np.iinfo(np.int64).max).min(axis=(1, 2), initial=np.iinfo(np.int64).max)
    here = ~both.any(axis=(1, 2)) | (least == leaf[a])
    a, b = a[here], b[here]
    most = (1 - similarity) * (size[a] + size[b]) + _SLACK
    near = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1) * (1 + similarity) <= most
    a, b, most = a[near], b[near], most[near]
    words, start, length = own
    width, near = np.minimum(length[a], length[b]), np.ones(len(a), bool)
    for w in np.unique(width[width > 0]).tolist():
        some = np.flatnonzero(width == w)
        for at in np.array_split(some, len(some) * w // 1_000_000 + 1):  # bounds memory
            x, y = (shortened(words, start[c[at]], length[c[at]], w) for c in (a, b))
            near[at] = np.bitwise_count(x ^ y).sum(axis=1) * (1 + similarity) <= most[at]
    return a[near], b[near]


def _wide_groups(leaf: np.ndarray, size: np.ndarray, root: np.ndarray, leaf_rows: int, similarity: float) -> np.ndarray:
    """Whether a row's group has sizes alike over ``leaf_rows`` apart and is not all of one root; sorted by leaf and size."""
    group = np.concatenate([[0], np.cumsum(leaf[1:] != leaf[:-1])])
    first = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
    mixed = np.minimum.reduceat(root, first) < np.maximum.reduceat(root, first)
    a = np.arange(max(0, len(leaf) - leaf_rows - 1))
    b = a + leaf_rows + 1
    wide = np.zeros(len(first), bool)
    wide[group[a[(leaf[a] == leaf[b]) & (size[a] >= similarity * size[b] - _SLACK)]]] = True
    return (wide & mixed)[group]


def _pair_batches(u: list[np.ndarray], v: list[np.ndarray], most_rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Each pair once, in batches that take little memory beside the heap where they arrive."""
    u, v = np.concatenate(u), np.concatenate(v)
    u, v = np.minimum(u, v), np.maximum(u, v)
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    keep = np.ones(len(u), bool)
    keep[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    u, v = u[keep], v[keep]
    for a in range(0, len(u), most_rows):
        yield pa.RecordBatch.from_arrays([pa.array(u[a : a + most_rows]), pa.array(v[a : a + most_rows])], ["u", "v"])


def _pair_batches(u: list[np.ndarray], v: list[np.ndarray], most_rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Each pair once, in batches that take little memory beside the heap where they arrive."""
    u, v = np.concatenate(u), np.concatenate(v)
    u, v = np.minimum(u, v), np.maximum(u, v)
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    keep = np.ones(len(u), bool)
    keep[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    u, v = u[keep], v[keep]
    for a in range(0, len(u), most_rows):
        yield pa.RecordBatch.from_arrays([pa.array(u[a : a + most_rows]), pa.array(v[a : a + most_rows])], ["u", "v"])


def near_copies(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, leaf_rows: int = 16, most_rows: int = 1 << 16, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component_id) of every row, where rows link at a shingle similarity of ``similarity`` or more.

    First the SimHash search: texts whose fingerprints meet in the leaves of vantage-point trees are held
    against each other, and what that links is not compared again. As some similar texts have no
    fingerprints that near, an exact join of sets finds the rest. Similarity is Jaccard's, of distinct
    shingles (known by their 64-bit hashes).

    The join: in one order of all shingles, rare ones first, two sets of that similarity share a shingle
    among the first n - ceil(similarity n) + 1 of their n. Texts that share one meet in its group. A group
    first reports its texts that have a partner there, never their pairs: one within ``leaf_rows`` places by
    size (a group with sizes alike farther apart reports all its texts) that sizes and places allow and the
    fingerprints' links do not connect. Only these texts get their parity bitmaps and meet again; bitmaps
    reject what is surely apart where they meet, the whole sets decide. Equal sets are collapsed before.
    Groups estimated at over ``most_rows`` texts are cut into blocks whose pairs meet.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    known, texts = _frequent(slim, shingle)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for whole in batches:
            for start in range(0, whole.num_rows, 250):  # bounds memory
                batch = whole.slice(start, 250)
                found = [shingle_set(t.as_py() or b"", shingle) for t in batch.column("text")]
                fps = np.array([folds(x) for x in found], np.int64).reshape(-1, len(FOLDS))
                key = [xxhash.xxh64_intdigest(x.tobytes()) for x in found]
                bits = np.array([bitmap(x) for x in found]).reshape(-1, len(BITMAP))
                ordered = [x[np.lexsort((x, _looked_up(known, texts, x)))] for x in found]
                size = np.array([len(x) for x in found], np.int64)
                member = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(np.concatenate(ordered)))
                wide = pa.array([bitmap(x, LONG_BITS) if len(x) > LONG else None for x in found], pa.list_(pa.int64()))
                own = pa.array([bitmap(x, own_bits(len(x))) if len(x) > LONG else None for x in found], pa.list_(pa.int64()))
                columns = [np.array(key, np.uint64).view(np.int64), np.arange(uid, uid + len(found)), size, *fps.T, *bits.T]
                uid += len(found)
                yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, columns), member, wide, own], ["id", "key", "uid", "size", *FOLDS, *BITMAP, "members", "wide", "own"])
        give_back()

    long = [StructField(c, LongType()) for c in ["key", "uid", "size", *FOLDS, *BITMAP]]
    shape = StructType([slim.schema["id"], *long, *(StructField(c, ArrayType(LongType())) for c in ["members", "wide", "own"])])
    with small_batches(docs.sparkSession, 250):  # texts go out, longer sets come back
        rows = staged(slim.mapInArrow(sets, shape), "sets")
    first = rows.groupBy("key").agg(F.min("id").alias("least"), F.min("uid").alias("uid"), F.count("*").alias("n"))
    nodes = staged(first, "nodes")
    equal = staged(rows.select("uid").join(nodes.select("uid"), "uid", "left_anti"), "equal")
    texts_of = joined_small(rows, equal, "uid", "left_anti")

    at_leaf = StructType([StructField(c, LongType()) for c in PLACE])

    def placed(roots: DataFrame) -> DataFrame:
        """(leaf, uid, size, pos, root) of the first shingles of each set; leaves are shingles, or pairs of their blocks."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (b.slice(a, 500) for b in batches for a in range(0, b.num_rows, 500)):
                leaf, row, pos = [], [], []
                uids, members = batch.column("uid").to_numpy(), batch.column("members")
                for k, uid in enumerate(uids.tolist()):
                    x = members[k].values.to_numpy()
                    blocks = -(-_looked_up(known, texts, x) // most_rows)
                    one = np.flatnonzero(blocks <= 1)
                    parts = [(x[one], one)]
                    for p in np.flatnonzero(blocks > 1).tolist():
                        n, own = int(blocks[p]), xxhash.xxh64_intdigest(uid.to_bytes(8, "little")) % int(blocks[p])
                        tasks = np.array([min(own, o) * n + max(own, o) + 1 for o in range(n)], np.uint64) * _MIX
                        parts.append(((x[p : p + 1].view(np.uint64) + tasks).view(np.int64), np.full(n, p)))
                    for some, at in parts:
                        leaf.append(some)
                        pos.append(at)
                        row.append(np.full(len(some), k))
                none = np.zeros(0, np.int64)
                leaf, row, pos = (np.concatenate([none, *x]) for x in (leaf, row, pos))
                for a in range(0, len(row), 20_000):
                    at = pa.array(row[a : a + 20_000])
                    uid, size, root = (batch.column(c).take(at) for c in ["uid", "size", "root"])
                    yield pa.RecordBatch.from_arrays([pa.array(leaf[a : a + 20_000]), uid, size, pa.array(pos[a : a + 20_000]), root], PLACE)

        # Only the first members, those of ``prefix_length``, go to Python.
        first = F.expr(f"slice(members, 1, least(size, size - ceil({similarity}D * size - {_SLACK}D) + 1))")
        own = roots.select(F.col("u").alias("uid"), F.col("v").alias("root"))
        slim = joined_small(texts_of.select("uid", "size", first.alias("members")), own, "uid", "left")
        return slim.withColumn("root", F.coalesce("root", "uid")).mapInArrow(run, at_leaf)

    def sorted_columns(batches: list[pa.RecordBatch]) -> tuple[pa.Table, list[np.ndarray]]:
        """The rows by leaf, size and uid, and their ``PLACE``."""
        table = pa.Table.from_batches(batches)
        table = table.take(pa.array(np.lexsort([table.column(c).to_numpy() for c in ["uid", "size", "leaf"]])))
        return table, [table.column(c).to_numpy() for c in PLACE]

    def sharing(groups: DataFrame, tasks: int) -> DataFrame:
        """The rows of ``groups`` that have a partner in their leaf."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            batches = [b for b in batches if b.num_rows]
            if not batches:
                return
            table, (leaf, uid, size, pos, root) = sorted_columns(batches)
            shares = _wide_groups(leaf, size, root, leaf_rows, similarity)
            for d, a, b in group_pairs(leaf, size, pos, similarity):
                if d > leaf_rows:
                    break
                fresh = root[a] != root[b]
                shares[a[fresh]] = shares[b[fresh]] = True
            yield from table.filter(pa.array(shares)).combine_chunks().to_batches(20_000)
            del table, leaf, uid, size, pos, root, batches
            give_back()

        return groups.repartition(tasks, "leaf").mapInArrow(run, at_leaf)

    def met(groups: DataFrame, tasks: int) -> DataFrame:
        """(u, v) of ``groups`` that may be similar."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            batches = [b for b in batches if b.num_rows]
            if not batches:
                return
            table, (leaf, uid, size, pos, root) = sorted_columns(batches)
            bits, heads = (np.stack([table.column(c).to_numpy() for c in columns], 1) for columns in (BITMAP, HEADS))
            bits = bits.view(np.uint64)  # bits of negative numbers would be counted without their sign
            lists = table.column("own").combine_chunks()
            length = lists.value_lengths().fill_null(0).to_numpy()
            own = lists.flatten().to_numpy().view(np.uint64), np.cumsum(length) - length, length
            u, v, held = [], [], 0
            for _, a, b in group_pairs(leaf, size, pos, similarity):
                for k in range(0, len(a), 100_000):
                    x, y = fresh_pairs(leaf, root, size, bits, own, heads, a[k : k + 100_000], b[k : k + 100_000], similarity)
                    u.append(uid[x])
                    v.append(uid[y])
                    held += len(x)
                if held > 500_000:  # bounds memory
                    yield from _pair_batches(u, v)
                    u, v, held = [], [], 0
            if held:
                yield from _pair_batches(u, v)
            del table, leaf, uid, size, pos, root, bits, heads, lists, own, u, v, batches
            give_back()

        return groups.repartition(tasks, "leaf").mapInArrow(run, "u long, v long")

    def similar(pairs: DataFrame) -> DataFrame:
        """The staged (u, v) whose sets are that similar."""
        ends = staged(pairs.select(F.col("u").alias("uid")).union(pairs.select("v")).distinct(), "ends")
        needed = joined_small(rows.select("uid", "size", "members"), ends, "uid", "left_semi")
        side = lambda c: needed.select(F.col("uid").alias(c), F.col("size").alias(c + "n"), F.col("members").alias(c + "m"))
        common = F.size(F.array_intersect("um", "vm"))
        both = pairs.join(side("u"), "u").join(side("v"), "v")
        return staged(both.where(common * (1 + similarity) >= similarity * (F.col("un") + F.col("vn")) - _SLACK).select("u", "v"), "linked")

    def near_by_bits(pairs: DataFrame) -> DataFrame:
        """The staged pairs that the bitmaps do not reject, with the sizes un and vn."""
        side = lambda c: rows.select(F.col("uid").alias(c), F.col("size").alias(c + "n"), *(F.col(s).alias(c + s) for s in BITMAP))
        apart = sum((F.bit_count(F.col("u" + s).bitwiseXOR(F.col("v" + s))) for s in BITMAP), F.lit(0))
        near = apart * (1 + similarity) <= (1 - similarity) * (F.col("un") + F.col("vn")) + _SLACK
        return staged(pairs.join(side("u"), "u").join(side("v"), "v").where(near).select(*pairs.columns, "un", "vn"), "near")

    def still_near(pairs: DataFrame) -> DataFrame:
        """The pairs without those of long sets that their longer bitmaps reject."""
        long = (F.col("un") > LONG) & (F.col("vn") > LONG)
        side = lambda c: rows.where(F.col("size") > LONG).select(F.col("uid").alias(c), F.col("wide").alias(c + "w"))
        bits = F.aggregate(F.zip_with("uw", "vw", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, x: n + x)
        near = bits * (1 + similarity) <= (1 - similarity) * (F.col("un") + F.col("vn")) + _SLACK
        kept = pairs.where(long).join(side("u"), "u").join(side("v"), "v").where(near).select(pairs.columns)
        return pairs.where(~long).unionByName(kept)

    def joined_up(edges: DataFrame) -> DataFrame:
        return components(edges, spread_hubs=False, tasks=few)

    cores = docs.sparkSession.sparkContext.defaultParallelism
    few = max(cores, nodes.count() // 50_000 + 1)  # tasks, and so files, of tables of pairs
    # The fingerprints search first, whole sets decide.
    alike_by = near_by_bits(alike(staged(texts_of.select("uid", *FOLDS), "fingerprints"), radius))
    roots = joined_up(similar(staged(still_near(alike_by).select("u", "v").coalesce(few), "proposed")))

    total = rows.agg(F.sum(F.col("size") * (1 - similarity) + 2)).first()[0] or 0
    tasks = max(cores, int(total) // 125_000 + 1)
    shared = staged(sharing(placed(roots), tasks), "met")
    order = F.array_sort(F.collect_list(F.struct("pos", "leaf")))
    heads = shared.groupBy("uid").agg(F.slice(order, 1, len(HEADS)).alias("heads"))
    heads = heads.select("uid", *(F.col("heads")[F.least(F.lit(k), F.size("heads") - 1)]["leaf"].alias(c) for k, c in enumerate(HEADS)))
    again = shared.join(heads.join(rows.select("uid", *BITMAP, "own"), "uid"), "uid")
    pairs = staged(met(again, max(cores, shared.count() // 50_000 + 1)).distinct(), "candidates")
    roots = joined_up(roots.unionByName(similar(pairs)))
    rooted = nodes.join(roots.select(F.col("u").alias("uid"), F.col("v").alias("root")), "uid", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "uid"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("members")).where("members > 1")
    member = staged(rooted.select("key", "root").join(named, "root").select("key", "component_id"), "components")
    return joined_small(rows.select("id", "key"), member, "key", "left").select(F.col("id").alias(id_col), F.coalesce("component_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, similarity: float | None = None, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that name their component: one document of each group stays.

    Groups are those of ``near_duplicates``, or of ``near_copies`` if a similarity is given. Decisions
    name a row by its id and its text's hash, so texts move only where rows repeat and different texts
    of one id, or of none, are judged apart. Rows without an id stay only where no other of their group has one.
    """
    row = F.struct(F.isnull(id_col).alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text"))
    named = docs.withColumn("_row", row)
    if similarity is None:
        found = alone(lambda: near_duplicates(named, radius, shingle, id_col="_row", text_col=text_col), "judged")
    else:
        found = alone(lambda: near_copies(named, similarity, shingle, id_col="_row", text_col=text_col), "judged", "snappy")  # its tables are many, and zstd works outside the heap
    copies = staged(found.where("_row <> component_id").select(F.col("_row").alias("_copy")).distinct(), "copies")
    kept = joined_small(named, copies, F.col("_row") == F.col("_copy"), "left_anti")
    again = found.where("_row = component_id").groupBy("_row").count().where("count > 1").select(F.col("_row").alias("_again"))
    again = staged(again, "repeated")
    if not again.limit(1).count():
        return kept.drop("_row")
    same = F.col("_row") == F.col("_again")
    once = joined_small(kept, again, same, "left_semi").dropDuplicates(["_row"])
    return joined_small(kept, again, same, "left_anti").unionByName(once).drop("_row")
