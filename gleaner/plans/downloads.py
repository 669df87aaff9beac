"""Downloads of a cycle: two fetches, of the records' URLs and of what their pages link to.

Depth is fixed at one, so the search is two table expansions instead of a queue per record.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gleaner.functions import html
from gleaner.functions.urls import site_document
from gleaner.operators import attempts, files

URLS_PER_RECORD, LINKS_PER_PAGE, HTML_BYTES = 12, 8, 10 << 20


def queue(records: DataFrame, results: DataFrame, retry_s: int, as_of: Column, most: int | None = None) -> DataFrame:
    """(record_id, title, urls) of the records to try now, in order: new ones and those due again.

    ``results`` has record_id, status, valid (its files are still there), limited and finished_at.
    """
    verdict = attempts_due(retry_s, as_of)
    rows = records.join(results.select("record_id", verdict.alias("_v")), "record_id", "left")
    rows = rows.where(F.coalesce("_v", F.lit("retry")) == "retry").select("record_id", "title", "urls")
    return rows if most is None else rows.orderBy("record_id").limit(most)


def attempts_due(retry_s: int, as_of: Column) -> Column:
    from gleaner.operators.pacing import retry_eligible

    return retry_eligible(F.col("status"), F.col("valid"), F.col("limited"), F.col("finished_at"), as_of, retry_s)


def first_urls(rows: DataFrame, owned: DataFrame) -> DataFrame:
    """(record_id, url, depth): each record's distinct URLs, up to the cap, without those whose content it owns.

    ``owned`` has (record_id, url).
    """
    each = rows.select("record_id", F.posexplode(F.array_distinct("urls")).alias("position", "url")).join(owned, ["record_id", "url"], "left_anti")
    return files.capped(each, "record_id", "position", URLS_PER_RECORD).select("record_id", "url", F.lit(0).alias("depth"))


@F.pandas_udf(StringType())
def decoded(content: pd.Series, charset: pd.Series) -> pd.Series:
    """Bytes as text in the response's charset (UTF-8 if it is unknown); what is malformed is replaced."""

    def one(raw: bytes | None, name: str | None) -> str | None:
        if raw is None:
            return None
        try:
            return raw.decode(name or "utf-8", "replace")
        except LookupError:
            return raw.decode("utf-8", "replace")

    return pd.Series([one(raw, name) for raw, name in zip(content, charset)], dtype=object)


def classified(fetched: DataFrame) -> DataFrame:
    """Fetched rows with kind and, for what is no page to look into, status."""
    kind = F.when(F.col("content").isNotNull(), files.content_kind(F.col("content"), F.col("content_type")))
    rows = fetched.withColumn("kind", kind)
    rows = rows.withColumn("html", decoded(F.when(F.col("kind") == "html", F.col("content")), F.col("charset")))
    status = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("kind") == "pdf", "pdf_obtido")
        .when(F.col("kind") == "invalid_pdf", "pdf_invalido_ou_incompleto")
        .when(F.col("kind") == "other", "formato_nao_suportado")
        .when(F.col("bytes") > HTML_BYTES, "html_grande")
        .when(html.is_challenge(F.col("html")), "verificacao_navegador")
    )
    return rows.withColumn("status", status)


def second_urls(first: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(record_id, url, depth) of the links of the first pages, and the pages with their status.

    ``first`` is ``classified`` and staged. Links that the record has tried are left out.
    """
    pages = first.where("status IS NULL").withColumn("key", F.concat_ws("\x00", "record_id", "url"))
    found = html.links(pages, "key", "final_url", "html")
    distinct = html.candidates(found, "key").withColumns({"record_id": F.substring_index("key", "\x00", 1), "page": F.substring_index("key", "\x00", -1)})
    new = distinct.join(first.select("record_id", "url"), ["record_id", "url"], "left_anti")
    taken = files.capped(new, "key", "position", LINKS_PER_PAGE)
    counts = distinct.groupBy("key").agg(F.count("*").alias("all")).join(new.groupBy("key").agg(F.count("*").alias("candidates_found")), "key", "left")
    judged = pages.join(counts, "key", "left").fillna(0, ["all", "candidates_found"])
    status = F.when(F.col("all") == 0, "sem_link_pdf_no_html").otherwise("links_localizados")
    judged = judged.withColumns({"status": status, "too_many": F.col("candidates_found") > LINKS_PER_PAGE})
    return taken.select("record_id", "url", F.lit(1).alias("depth")).distinct(), judged.drop("key", "all", "html")


def page_metadata(classified_rows: DataFrame) -> DataFrame:
    """(record_id, fields): what each record's pages say in their metadata, a map per page that says something."""
    pages = classified_rows.where("html IS NOT NULL AND status IS NULL").withColumn("key", F.concat_ws("\x00", "record_id", "url"))
    found = html.metadata(pages, "key").where(F.size("fields") > 0)
    return found.select(F.substring_index("key", "\x00", 1).alias("record_id"), "fields")


def results(rows: DataFrame, tried: DataFrame, finished_at: Column, prior: DataFrame | None = None, metadata: DataFrame | None = None) -> DataFrame:
    """A result per record from its tried URLs: (record_id, title, status, files, attempts, metadata_from_html, limited, finished_at).

    ``tried`` has record_id, depth, url, at, final_url, kind, sha256, bytes, status, error, stage and
    too_many; pages of the second depth that were not looked into have status limite_profundidade.
    ``prior`` has record_id, files (sha256, path, bytes, url) that are still there and
    metadata_from_html: what a record has obtained stays, and comes first.
    """
    spark, none = rows.sparkSession, "record_id string, files array<struct<sha256 string, path string, bytes bigint, url string>>, metadata_from_html array<map<string, array<string>>>"
    prior = spark.createDataFrame([], none) if prior is None else prior
    metadata = spark.createDataFrame([], "record_id string, fields map<string, array<string>>") if metadata is None else metadata
    had = prior.select("record_id", F.explode("files.sha256").alias("sha256")).distinct().withColumn("_had", F.lit(True))
    order = F.struct("depth", "at", "url")
    earlier = tried.where("kind = 'pdf'").groupBy("record_id", "sha256").agg(F.min(order).alias("_first"))
    marked = tried.join(earlier, ["record_id", "sha256"], "left").join(had, ["record_id", "sha256"], "left")
    again = F.coalesce(order != F.col("_first"), F.lit(False)) | F.coalesce("_had", F.lit(False))
    marked = marked.withColumn("status", F.when((F.col("status") == "pdf_obtido") & again, "pdf_duplicado").otherwise(F.col("status")))
    event = F.struct("depth", "at", "url", "final_url", "kind", "sha256", "bytes", "status", F.col("error").alias("reason"), "stage")
    path = F.concat(F.lit("raw/pdf/"), F.substring("sha256", 1, 2), F.lit("/"), "sha256", F.lit(".pdf"))
    file = F.when(F.col("status") == "pdf_obtido", F.struct("sha256", path.alias("path"), "bytes", F.col("final_url").alias("url")))
    done = marked.groupBy("record_id").agg(
        F.array_sort(F.collect_list(event)).alias("attempts"), F.array_sort(F.collect_list(file)).alias("_new"), F.bool_or(F.coalesce("too_many", F.lit(False))).alias("_many")
    )
    said = metadata.groupBy("record_id").agg(F.collect_list("fields").alias("_said"))
    out = rows.select("record_id", "title", F.size("urls").alias("_urls")).join(done, "record_id", "left").join(said, "record_id", "left")
    out = out.join(prior.select("record_id", F.col("files").alias("_old"), F.col("metadata_from_html").alias("_told")), "record_id", "left")
    empty = F.array()
    known = F.coalesce("_told", empty)
    told = lambda: F.transform(known, lambda m: F.to_json(m))  # noqa: E731  maps cannot be compared, their JSON can
    out = out.withColumns({
        "files": F.concat(F.coalesce("_old", empty), F.coalesce("_new", empty)),
        "attempts": F.coalesce("attempts", empty), "_many": F.coalesce("_many", F.lit(False)),
        "metadata_from_html": F.concat(known, F.filter(F.coalesce("_said", empty), lambda m: ~F.array_contains(told(), F.to_json(m)))),
    })
    limited = attempts.limited(F.col("attempts.status"), F.col("_many"), F.col("_urls") > URLS_PER_RECORD)
    return out.select(
        "record_id", "title", attempts.result_status(F.size("files"), F.col("_urls")).alias("status"), "files", "attempts", "metadata_from_html",
        F.coalesce(limited, F.lit(False)).alias("limited"), finished_at.alias("finished_at"),
    )


def work_files(done: DataFrame) -> DataFrame:
    """(record_id, sha256, bytes, is_site) of all files of results."""
    rows = done.select("record_id", F.explode("files").alias("f")).select("record_id", "f.*")
    return rows.select("record_id", "sha256", "bytes", site_document(F.coalesce("url", F.lit(""))).alias("is_site"))
