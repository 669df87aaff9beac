"""Connected components of a distributed graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.workspace import remove, staged


MOST_HUBS = 100_000


def _beside_least(edges: DataFrame, n: int, spread: bool) -> tuple[DataFrame, DataFrame]:
    """``edges`` (u, v) with m, the least v of their u; and (u, m) alone. There are at most ``n`` edges.

    All edges of a hub would meet in one task of a join on u. At most ``MOST_HUBS`` nodes can have
    more than n / MOST_HUBS edges, so the minima of these are broadcast and their edges stay where
    they are; no other node has more edges than that, or a hundred.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_n"))
    if not spread:
        return edges.join(least.select("u", "m"), "u"), least.select("u", "m")
    is_hub = F.col("_n") > max(100, n // MOST_HUBS)
    marked = edges.join(F.broadcast(least.where(is_hub).select("u", F.col("m").alias("_m"))), "u", "left")
    others = marked.where("_m IS NULL").drop("_m").join(least.where(~is_hub).select("u", "m"), "u")
    return marked.where("_m IS NOT NULL").withColumnRenamed("_m", "m").unionByName(others), least.select("u", "m")


def components(edges: DataFrame, spread_hubs: bool = True, tasks: int | None = None) -> DataFrame:
    """(u, v): every node but the least of its component, with the component's least node.

    ``edges`` has columns u and v, in any direction, repeats and loops allowed. Each round is staged
    in the shared folder, so nothing is gathered on the driver and lost executors cost one round.
    Rounds go on until one changes nothing (about log of the longest shortest path). ``spread_hubs``
    takes two broadcasts and a staged table a round; without it a node's edges meet in one task. Each
    round is written by at most ``tasks`` tasks, each of which writes a file.
    """

    def written(df: DataFrame) -> DataFrame:
        return staged(df if tasks is None else df.coalesce(tasks), "edges")

    now = written(_ordered(edges))
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _beside_least(both, 2 * mark[0], spread_hubs)[0].where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = large.where("u <> v")
        if spread_hubs:
            large = staged(large, "large")
        small, least = _beside_least(large, 2 * mark[0], spread_hubs)
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(_ordered(small.unionByName(least.select("u", F.col("m").alias("v")))))
        before, mark = mark, _mark(new)
        for passed in (now, large) if spread_hubs else (now,):
            for folder in {f.rsplit("/", 1)[0] for f in passed.inputFiles()[:1]}:  # no files if it is empty
                remove(now.sparkSession, folder)
        now = new
        if mark == before:
            break
    return now


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and a sum over them, equal for equal sets."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("x")).first()
    return row["n"], int(row["x"] or 0)
