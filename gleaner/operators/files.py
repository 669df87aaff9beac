"""Files by content hash: deduplication, packing into batches, transfer and archive state."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.operators.running import hex_bucket, running_total


def distinct_files(files: DataFrame, sha: str = "sha", size: str = "bytes", record: str = "record_id") -> DataFrame:
    """(sha, bytes, records): one row per content; the size that the last record gives counts."""
    return files.groupBy(sha).agg(F.max_by(size, record).alias(size), F.count("*").alias("records"))


def class_counts(files: DataFrame, is_site: Column, sha: str = "sha") -> DataFrame:
    """(candidates, site_documents, both): distinct contents by class; one seen in both counts in each."""
    each = files.groupBy(sha).agg(F.bool_or(~is_site).alias("c"), F.bool_or(is_site).alias("s"))
    return each.agg(F.count_if("c").alias("candidates"), F.count_if("s").alias("site_documents"), F.count_if(F.col("c") & F.col("s")).alias("both"))


def duplicate_events(events: DataFrame, sha: str, order: str, size: str, flagged: Column | None = None) -> DataFrame:
    """(responses, duplicates, duplicate_bytes): events whose content came earlier, or that say so."""
    first = events.groupBy(sha).agg(F.min(order).alias("_first"))
    again = F.col(order) > F.col("_first")
    again = again if flagged is None else again | flagged
    return events.join(first, sha).agg(
        F.count("*").alias("responses"), F.count_if(again).alias("duplicates"), F.coalesce(F.sum(F.when(again, F.col(size))), F.lit(0)).alias("duplicate_bytes")
    )


def archived(files: DataFrame, batches: DataFrame) -> DataFrame:
    """The hashes of files in batches that were verified after their transfer."""
    done = batches.where("archive_status = 'transferred_verified'").select("batch_number")
    return files.join(done, "batch_number", "left_semi").select("sha").distinct()


def finished(results: DataFrame, archived_shas: DataFrame, on_disk: DataFrame) -> DataFrame:
    """Results with ``valid``: whether each of their files is archived or on disk with its size.

    ``results`` has record_id and files (array of sha, path, bytes); ``on_disk`` has path and bytes.
    """
    one = results.select("record_id", F.explode("files").alias("f")).select("record_id", "f.*")
    one = one.join(archived_shas.withColumn("_a", F.lit(True)), "sha", "left")
    one = one.join(on_disk.select("path", F.col("bytes").alias("_size")), "path", "left")
    good = F.coalesce("_a", F.lit(False)) | F.coalesce(F.col("_size") == F.col("bytes"), F.lit(False))
    valid = one.groupBy("record_id").agg(F.bool_and(good).alias("valid"))
    return results.join(valid, "record_id", "left").withColumn("valid", F.coalesce("valid", F.lit(True)))


def pending(files: DataFrame, packaged: DataFrame) -> DataFrame:
    """Distinct contents that no batch holds yet."""
    return distinct_files(files).join(packaged.select("sha"), "sha", "left_anti")


def late_associations(associations: DataFrame, packaged: DataFrame, known: DataFrame) -> DataFrame:
    """(record_id, sha, batch_number, source_url) of new record-to-file links into closed batches."""
    new = associations.groupBy("record_id", "sha").agg(F.max("source_url").alias("source_url"))
    late = new.join(packaged.select("sha", "batch_number"), "sha").join(known.select("record_id", "sha"), ["record_id", "sha"], "left_anti")
    return late.select("record_id", "sha", "batch_number", F.coalesce("source_url", F.lit("")).alias("source_url"))


def batch_prefix(files: DataFrame, target: int) -> DataFrame:
    """(sha, bytes, before): the files of the next batch, in order of hash while earlier ones are below the target."""
    rows = files.select("sha", "bytes").withColumn("_piece", hex_bucket("sha"))
    return running_total(rows, [], "_piece", ["sha"], "bytes", "before").where(F.col("before") < target).select("sha", "bytes", F.col("before").cast("long").alias("before"))


def next_fit(files: DataFrame, target: int, force: bool = True) -> DataFrame:
    """(batch, files, bytes) of closing batch after batch until nothing is left.

    Where a batch ends depends on where it began, so this is one pass over sorted (hash, size) pairs
    in constant memory; without ``force`` a last batch below the target stays open.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n, size = [], 0, 0
        for batch in batches:
            for b in batch.column("bytes").to_pylist():
                if n and size >= target:
                    out.append((n, size))
                    n, size = 0, 0
                n, size = n + 1, size + b
        if n and (force or size >= target):
            out.append((n, size))
        columns = [list(range(1, len(out) + 1)), [x[0] for x in out], [x[1] for x in out]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["batch", "files", "bytes"])

    return files.select("sha", "bytes").repartitionByRange(1, "sha").sortWithinPartitions("sha").mapInArrow(fold, "batch long, files long, bytes long")


def next_number(batches: DataFrame) -> DataFrame:
    return batches.agg((F.coalesce(F.max("batch_number"), F.lit(0)) + 1).alias("batch_number"))


def tree_hash(files: DataFrame, group: str, path: str = "path", sha: str = "sha") -> DataFrame:
    """(group, files, tree_sha256): SHA-256 of a group's ``sha  path`` lines in order of path.

    A group is one package, whose list of paths is one document by definition.
    """
    lines = F.transform(F.array_sort(F.collect_list(F.struct(path, sha))), lambda f: F.concat(f[sha], F.lit("  "), f[path], F.lit("\n")))
    return files.groupBy(group).agg(F.count("*").alias("files"), F.sha2(F.array_join(lines, ""), 256).alias("tree_sha256"))


def manifest(links: DataFrame, metadata: DataFrame) -> DataFrame:
    """Links with their metadata; a record without metadata is an error when the row is read."""
    found = metadata.withColumn("_found", F.lit(True))
    joined = links.join(found, "record_id", "left")
    missing = F.raise_error(F.concat(F.lit("no metadata for record "), F.col("record_id").cast("string"))).cast("boolean")
    return joined.where(F.coalesce("_found", missing)).drop("_found")


def inclusion(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(only_left, only_right): how many keys each side has that the other has not."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    both = a.withColumn("_a", F.lit(1)).join(b.withColumn("_b", F.lit(1)), key, "full")
    return both.agg(F.count_if(F.col("_b").isNull()).alias("only_left"), F.count_if(F.col("_a").isNull()).alias("only_right"))


def pdf_signature(content: Column) -> Column:
    """Starts with %PDF- after white space within 1,024 bytes, and %%EOF within the last 65,536 bytes."""
    head = F.decode(F.substring(content, 1, 1024), "ISO-8859-1")
    size = F.octet_length(content)
    tail = F.substring(content, F.greatest(size - 65535, F.lit(1)), F.lit(65536))
    return F.ltrim(head, F.lit(" \t\n\r\x0b\x0c")).startswith("%PDF-") & F.contains(F.decode(tail, "ISO-8859-1"), F.lit("%%EOF"))


def content_kind(content: Column, content_type: Column) -> Column:
    """pdf, html, other or invalid_pdf, in the order of the reasons."""
    head = F.ltrim(F.decode(F.substring(content, 1, 1024), "ISO-8859-1"), F.lit(" \t\n\r\x0b\x0c"))
    return (
        F.when(pdf_signature(content), "pdf")
        .when(head.startswith("%PDF-") | (content_type == "application/pdf"), "invalid_pdf")
        .when(content_type.isin("text/html", "application/xhtml+xml"), "html")
        .otherwise("other")
    )


def stop_at_budget(rows: DataFrame, order: str, bucket: Column, size: str, budget: int) -> DataFrame:
    """Rows, in order, while the bytes of earlier ones are below the budget."""
    out = running_total(rows.withColumn("_piece", bucket), [], "_piece", [order], size, "before").where(F.col("before") < budget)
    return out.drop("_piece").withColumn("before", F.col("before").cast("long"))


def stop_at_target(rows: DataFrame, order: str, bucket: Column, sha: str, target: int) -> DataFrame:
    """Rows, in order, up to the one that brings the target-th distinct content."""
    first = rows.groupBy(sha).agg(F.min(order).alias("_first"))
    marked = rows.join(first, sha).withColumn("_new", (F.col(order) == F.col("_first")).cast("long")).withColumn("_piece", bucket)
    out = running_total(marked, [], "_piece", [order], "_new", "seen").where(F.col("seen") < target)
    return out.drop("_piece", "_new", "_first").withColumn("seen", F.col("seen").cast("long"))


def capped(rows: DataFrame, group: str, order: str, most: int) -> DataFrame:
    """The first rows of each group, with ``limited``: whether the group had more (URLs of a record, links of a page)."""
    w = Window.partitionBy(group)
    ranked = rows.withColumn("_r", F.row_number().over(w.orderBy(order))).withColumn("limited", F.count("*").over(w) > most)
    return ranked.where(F.col("_r") <= most).drop("_r")
