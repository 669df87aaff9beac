"""Reproducible shuffles and shards by a Feistel permutation of global row numbers.

Rows get gapless numbers in order of (id, content checksum). A Feistel network over Z_a x Z_b, with
a = ceil(sqrt(N)) and b = ceil(N / a), permutes [0, ab); walking its cycles until a value is below N
restricts it to [0, N). The permuted number p gives shard p mod n and slot p div n, so shard sizes
differ by at most one (law ``rows``) and any row's place can be computed from its number alone.

Only DataFrame functions are used. A null id sorts first, null text counts as empty, rows equal in
id and content are interchangeable, an empty table gives an empty result.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.workspace import staged

_LOCAL = (1 << 33) - 1  # monotonically_increasing_id: partition above, row within it below 2^33


def permuted(x: Column, n: int, seed: int = 7, rounds: int = 6) -> Column:
    """The place of row number ``x`` in a fixed pseudo-random order of [0, n).

    At most ab - n < a numbers lie outside [0, n), and a cycle meets each once, so that many steps
    suffice. Only a number that the first turn leaves outside, one in b or so, is walked at all.
    """
    a = isqrt(max(n, 1) - 1) + 1
    b = -(-max(n, 1) // a)

    def turn(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]
        moved = F.pmod(left + F.pmod(F.xxhash64(right, i, F.lit(seed)), F.lit(a)), F.lit(a))
        other = F.pmod(right + F.pmod(F.xxhash64(left, i, F.lit(seed)), F.lit(b)), F.lit(b))
        even = i % 2 == 0
        return F.struct(F.when(even, moved).otherwise(left).alias("l"), F.when(even, right).otherwise(other).alias("r"))

    def once(y: Column) -> Column:
        right = y % b
        start = F.struct(((y - right) / b).cast("long").alias("l"), right.cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn, lambda s: s["l"] * F.lit(b).cast("long") + s["r"])

    def walk(y: Column, _: Column) -> Column:
        steps = F.sequence(F.lit(1), F.when(y >= n, F.lit(max(1, a * b - n))).otherwise(F.lit(1)))
        return F.aggregate(steps, y, lambda z, _: F.when(z >= n, once(z)).otherwise(z))

    return F.aggregate(F.array(F.lit(0)), once(x), walk)


def numbered(df: DataFrame, order: list[str], out: str = "row_number") -> tuple[DataFrame, int]:
    """``df``, staged, with gapless global row numbers in ``order``; and the number of rows.

    Rows are dealt by range, so no task holds more than its range; one row per partition (the
    partition's count) is summed to the offsets, and only those are broadcast.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    counts = {r["_part"]: r["count"] for r in rows.groupBy("_part").count().collect()}  # a row per partition
    bases, total = [], 0
    for part in sorted(counts):
        bases.append((part, total))
        total += counts[part]
    offsets = df.sparkSession.createDataFrame(bases, "_part long, _base long")
    local = F.col("_at").bitwiseAND(F.lit(_LOCAL))
    return rows.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_base") + local).drop("_part", "_at", "_base"), total


def sharded(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """(id, size, text_crc32, row_number, position, shard, slot) of every row.

    ``position`` is the row's place in the shuffle; ``shard`` = position mod shards, ``slot`` = position
    div shards.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows, n = numbered(slim, [id_col, "text_crc32", "size"])
    rows = rows.withColumn("position", permuted(F.col("row_number"), n, seed))
    return rows.withColumns({"shard": (F.col("position") % shards).cast("int"), "slot": F.floor(F.col("position") / shards).cast("long")})
