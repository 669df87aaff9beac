"""Download attempts and results: statuses, counters and the coverage report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses that are no failure, and those that leave a record limited.
COMPLETED = ("pdf_obtido", "pdf_duplicado", "links_localizados")
LIMITING = ("limite_arquivo", "limite_execucao", "limite_profundidade", "redirect_limite", "html_grande", "disco_reserva")


def status_counts(attempts: DataFrame, *by: str) -> DataFrame:
    return attempts.groupBy(*by).agg(F.count("*").alias("n"))


def failures(attempts: DataFrame) -> DataFrame:
    return attempts.where(~F.col("status").isin(*COMPLETED))


def failure_stages(attempts: DataFrame) -> DataFrame:
    """(stage, n) of failed attempts, ``nao_registrada`` where none was recorded."""
    return failures(attempts).groupBy(F.coalesce("stage", F.lit("nao_registrada")).alias("stage")).agg(F.count("*").alias("n"))


def result_status(n_files: Column, n_urls: Column) -> Column:
    return F.when(n_files > 0, "sucesso").when(n_urls == 0, "sem_link_origem").otherwise("nao_obtido")


def limited(statuses: Column, too_many: Column, left_over: Column) -> Column:
    """Whether a record may have more: a limiting status, more candidates than taken, or unvisited URLs left."""
    return F.arrays_overlap(statuses, F.array(*[F.lit(s) for s in LIMITING])) | too_many | left_over


def record_summary(results: DataFrame, is_site) -> DataFrame:
    """A row per result: counts of its files by class, and the reasons of its failed attempts.

    ``results`` has record_id, status, limited, files (array of sha, url) and attempts (array of
    status, reason); ``is_site`` tells a file's URL.
    """
    site = F.size(F.filter("files", lambda f: is_site(F.coalesce(f["url"], F.lit("")))))
    failed = F.filter("attempts", lambda a: ~a["status"].isin(*COMPLETED))
    return results.select(
        "record_id", "status", F.size("files").alias("pdfs"), (F.size("files") - site).alias("candidate_work_pdfs"), site.alias("site_document_pdfs"),
        "limited", F.transform(failed, lambda a: F.coalesce(a["reason"], a["status"])).alias("reasons"),
    )


def download_report(summary: DataFrame, input_records: int) -> DataFrame:
    """One row: processed and remaining records, works with a candidate, extra candidates."""
    return summary.agg(
        F.count("*").alias("processed_records"), (F.lit(input_records) - F.count("*")).alias("remaining_records"),
        F.count_if(F.col("candidate_work_pdfs") > 0).alias("works_with_candidate_pdf"),
        F.coalesce(F.sum(F.greatest(F.col("candidate_work_pdfs") - 1, F.lit(0))), F.lit(0)).alias("possible_extra_candidate_files"),
    )


def first_attempt_by_domain(results: DataFrame, host) -> DataFrame:
    """(domain, status, n): results by the host of their first attempt."""
    return results.where(F.size("attempts") > 0).groupBy(host(F.element_at("attempts", 1)["url"]).alias("domain"), "status").agg(F.count("*").alias("n"))


def coverage_report(partitions: DataFrame, links: DataFrame, batches: DataFrame) -> DataFrame:
    """One row: records, links, duplicates, partitions by status, inaccessible records, closed batches."""
    p = partitions.agg(
        F.count("*").alias("partitions"), F.count_if(F.col("status") == "complete").alias("complete"), F.count_if(F.col("status") == "split").alias("split"),
        F.count_if(F.col("status") == "partial").alias("partial"), F.coalesce(F.sum("inaccessible"), F.lit(0)).alias("inaccessible_records"),
    )
    each = links.select("record_id", "partition_id").distinct()
    n = each.agg(F.count("*").alias("links"), F.countDistinct("record_id").alias("records")).withColumn("duplicate_links", F.col("links") - F.col("records"))
    b = batches.where("status = 'closed'").agg(F.count("*").alias("closed_batches"), F.coalesce(F.sum("files"), F.lit(0)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    return p.crossJoin(n).crossJoin(b)  # one row each
