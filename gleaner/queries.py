"""The engine's operators as queries over the driver's tables, which stand in for harvested ones.

Orders with their customer's nation are the corpus (year, institution), documents are files and
records, labels mark what is archived, events are the log of requests, pages are HTML pages. Every
query runs over its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import html, robots, urls
from gleaner.operators import attempts, files, pacing, records
from gleaner.operators.running import hex_bucket
from gleaner.plans import partitions, query_spec
from gleaner.session import table

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Query] = {}

TARGET = 500_000
CONFIG = {
    "endpoint": "https://search.example/api", "join": "AND", "limit": 100, "filters": ['format:"masterThesis"'],
    "groups": [
        {"operator": "OR", "clauses": [{"lookfor": "the", "type": "Title"}, {"lookfor": "der", "type": "Title"}]},
        {"operator": "OR", "clauses": [{"lookfor": "ing", "type": "Subject"}, {"lookfor": "ung", "type": "Subject"}]},
    ],
}


def query(f: Query) -> Query:
    _registered[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_registered)


def corpus(spark: SparkSession, d: str) -> DataFrame:
    """(record_id, year, institution) of every order; nation is a fixed list of countries and is broadcast."""
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("institution"))
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(F.broadcast(nation), "c_nationkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("string").alias("year"))
    return orders.join(customer, "o_custkey", "left").select(F.col("o_orderkey").alias("record_id"), "year", "institution")


def documents(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, sha, bytes, lang, source, text): the documents as files."""
    rows = table(spark, d, "documents")
    return rows.select("doc_id", F.sha2(F.col("text"), 256).alias("sha"), F.octet_length("text").cast("long").alias("bytes"), "lang", "source", "text")


def _plan(spark: SparkSession, d: str) -> DataFrame:
    c = corpus(spark, d)
    years = partitions.exposed(partitions.facet(c, "year"), 4)
    return partitions.plan(c, years, partitions.exposed(partitions.facet(c, "institution"), 20, "count"))


@query
def facet_years(spark: SparkSession, d: str) -> DataFrame:
    return partitions.facet(corpus(spark, d), "year").orderBy(F.col("value").desc())


@query
def facet_institutions(spark: SparkSession, d: str) -> DataFrame:
    return partitions.facet(corpus(spark, d), "institution").orderBy(F.col("count").desc(), "value")


@query
def smallest_facet(spark: SparkSession, d: str) -> DataFrame:
    return partitions.smallest(partitions.facet(corpus(spark, d), "institution"))


@query
def partition_cover(spark: SparkSession, d: str) -> DataFrame:
    c = corpus(spark, d)
    return partitions.cover(c, partitions.exposed(partitions.facet(c, "year"), 4)).withColumn("priority", F.col("priority").cast("int"))


@query
def partition_plan(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d).withColumn("parent_priority", F.col("parent_priority").cast("int"))


@query
def split_coverage(spark: SparkSession, d: str) -> DataFrame:
    return partitions.split_coverage(_plan(spark, d))


@query
def complement_check(spark: SparkSession, d: str) -> DataFrame:
    c = corpus(spark, d)
    return partitions.algebra(c, partitions.exposed(partitions.facet(c, "year"), 4), partitions.facet(c, "institution"))


@query
def next_partition(spark: SparkSession, d: str) -> DataFrame:
    """The largest years are being harvested, the others are complete; the first in order comes next."""
    parts = partitions.facet(corpus(spark, d), "year").select(F.col("value").alias("id"), (F.lit(3000) - F.col("value").cast("int")).alias("priority"), "count")
    mean = parts.agg(F.avg("count").alias("mean"))
    parts = parts.join(F.broadcast(mean)).withColumn("status", F.when(F.col("count") > F.col("mean"), "harvesting").otherwise("complete"))  # one row
    return partitions.next_partition(parts).select("id", "priority", "status")


@query
def partition_states(spark: SparkSession, d: str) -> DataFrame:
    """The state machine's next step for every year x institution cell, at its first page."""
    cells = corpus(spark, d).groupBy("year", "institution").agg(F.count("*").alias("total"))
    state = cells.withColumns({
        "kind": F.lit("institution"), "has_children_facet": F.lit(False), "status": F.lit("planned"), "page": F.lit(1), "rows": F.least("total", F.lit(100)),
        "repeated": F.lit(False), "retryable": F.lit(False), "total_changed": F.lit(False),
    })
    return partitions.transition(state).select("year", "institution", "total", "next_status", "next_page")


@query
def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    """Planned partitions, record links (documents by language) and closed batches in one row."""
    docs = documents(spark, d)
    batches = files.next_fit(files.distinct_files(docs, record="doc_id"), TARGET, force=False).select(F.lit("closed").alias("status"), "files", "bytes")
    links = docs.select(F.col("sha").alias("record_id"), F.col("lang").alias("partition_id"))
    out = attempts.coverage_report(_plan(spark, d), links, batches)
    return out.select(*(F.col(c).cast("long").alias(c) for c in out.columns))


@query
def record_first_wins(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select(F.col("sha").alias("record_id"), "doc_id", "source", "lang")
    return records.first_wins(docs, "record_id", ["doc_id"])


@query
def record_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return records.last_wins(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"])


@query
def partition_links_summary(spark: SparkSession, d: str) -> DataFrame:
    return records.links_summary(documents(spark, d), "sha", "source")


@query
def record_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Documents of one size in bytes and language share a key; those unlike its first are conflicts."""
    docs = documents(spark, d).withColumn("record_id", F.concat("lang", F.lit("-"), F.col("bytes").cast("string")))
    return records.conflicts(docs, "record_id", "doc_id", "sha")


@query
def normalize_props(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return events.select("event_id", F.upper("event_type").alias("kind"), k.alias("k"), records.canonical(F.col("props")).alias("canonical"))


@query
def reject_split(spark: SparkSession, d: str) -> DataFrame:
    """Unlabelled documents have no title, low-quality ones a blank one; long ones have a usable URL."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    title = F.when(F.col("quality") == 1, "title").when(F.col("quality") == 0, " ")
    links = records.usable_urls(F.array(F.when(F.col("n_chars") > 1000, "https://a/b").otherwise("ftp://a")))
    issue = records.title_issue(title)
    reason = records.rejected(F.col("doc_id").cast("string"), issue, F.size(links))
    return docs.select("doc_id", issue.alias("issue"), reason.alias("reason"), reason.isNull().alias("accepted"))


@query
def page_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return records.page_fingerprints(table(spark, d, "conversations"), ["conv_id"], "turn", "text")


@query
def repeated_pages(spark: SparkSession, d: str) -> DataFrame:
    return records.repeated_pages(documents(spark, d), "lang", "doc_id", "sha")


@query
def snapshot_growth_check(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    return records.growth(docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi"), docs, "doc_id", "sha")


@query
def import_compatibility(spark: SparkSession, d: str) -> DataFrame:
    """Pages imported as theses: every page's URL gets the query that its address and the configuration make."""
    pages = table(spark, d, "pages").select("page_id", "url")
    right = query_spec.request_url(CONFIG, 1).split("?", 1)[1]
    wrong = query_spec.request_url(CONFIG | {"groups": CONFIG["groups"][:1]}, 1).split("?", 1)[1]
    made = F.concat(urls.origin(F.col("url")), F.lit("/?"), F.when(F.contains("url", F.lit("/en/")), right).otherwise(wrong))
    formats = F.array(F.when(F.contains("url", F.lit("example.org")), "article").otherwise("masterThesis"))
    return pages.select("page_id", records.import_basis(formats, made, CONFIG).alias("basis"))


@query
def file_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return files.distinct_files(documents(spark, d), record="doc_id")


@query
def candidate_vs_site(spark: SparkSession, d: str) -> DataFrame:
    return files.class_counts(documents(spark, d), F.col("source") == "src0")


@query
def pdf_duplicates(spark: SparkSession, d: str) -> DataFrame:
    out = files.duplicate_events(documents(spark, d), "sha", "doc_id", "bytes")
    return out.withColumn("duplicate_bytes", F.col("duplicate_bytes").cast("long"))


@query
def archived_skip(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents were packed by source; batches of high-quality ones are archived: (doc_id, skip)."""
    docs, labels = documents(spark, d), table(spark, d, "labels")
    packed = docs.join(labels, "doc_id").select("sha", F.col("quality").cast("long").alias("batch_number"))
    batches = packed.select("batch_number").distinct().withColumn("archive_status", F.when(F.col("batch_number") == 1, "transferred_verified"))
    done = files.archived(packed, batches).withColumn("skip", F.lit(True))
    return docs.join(done, "sha", "left").select("doc_id", F.coalesce("skip", F.lit(False)).alias("skip"))


@query
def archived_results(spark: SparkSession, d: str) -> DataFrame:
    """Results with two files each, the document and its language's smallest; half the sizes on disk are right."""
    docs, labels = documents(spark, d), table(spark, d, "labels")
    least = docs.groupBy("lang").agg(F.min_by(F.struct("sha", "bytes"), F.struct("bytes", "doc_id")).alias("f"))
    file = lambda sha, size: F.struct(sha.alias("sha"), F.concat(F.lit("raw/"), sha).alias("path"), size.alias("bytes"))
    results = docs.join(least, "lang").select(F.col("doc_id").alias("record_id"), F.array(file(F.col("sha"), F.col("bytes")), file(F.col("f.sha"), F.col("f.bytes"))).alias("files"))
    archived = docs.join(labels.where("toxic = 0"), "doc_id", "left_semi").select("sha").distinct()
    disk = files.distinct_files(docs, record="doc_id").select(F.concat(F.lit("raw/"), "sha").alias("path"), F.when(F.col("sha") < "8", F.col("bytes")).otherwise(0).alias("bytes"))
    return files.finished(results, archived, disk).select("record_id", "valid")


@query
def late_associations(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents are packed; other documents with the same content arrive late."""
    docs = documents(spark, d).withColumns({"record_id": F.col("doc_id"), "source_url": F.when(F.col("lang") != "en", F.col("source"))})
    known = docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")
    packed = known.groupBy("sha").agg(F.min("doc_id").alias("batch_number"))
    return files.late_associations(docs, packed, known)


@query
def pending_files(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).withColumnRenamed("doc_id", "record_id")
    packed = docs.join(table(spark, d, "labels").select(F.col("doc_id").alias("record_id")), "record_id", "left_semi")
    return files.pending(docs, packed)


@query
def batch_prefix(spark: SparkSession, d: str) -> DataFrame:
    return files.batch_prefix(files.distinct_files(documents(spark, d), record="doc_id"), TARGET)


@query
def batch_next_fit(spark: SparkSession, d: str) -> DataFrame:
    return files.next_fit(files.distinct_files(documents(spark, d), record="doc_id"), TARGET)


@query
def tree_checksum(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).withColumn("path", F.concat(F.lit("pdfs/"), F.lpad(F.col("doc_id").cast("string"), 9, "0")))
    return files.tree_hash(docs, "source")


@query
def manifest_join(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).withColumnRenamed("doc_id", "record_id")
    out = files.manifest(table(spark, d, "labels").withColumnRenamed("doc_id", "record_id"), docs)
    return out.select("record_id", F.concat(F.lit("pdfs/"), "sha", F.lit(".pdf")).alias("pdf_path"), "source", "bytes").orderBy("record_id")


@query
def manifest_inclusion(spark: SparkSession, d: str) -> DataFrame:
    return files.inclusion(table(spark, d, "labels"), table(spark, d, "documents"), "doc_id")


@query
def budget_stop(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "sha", "bytes")
    return files.stop_at_budget(docs, "doc_id", F.floor(F.col("doc_id") / 4096), "bytes", TARGET)


@query
def target_stop(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "sha")
    return files.stop_at_target(docs, "doc_id", F.floor(F.col("doc_id") / 4096), "sha", 150)


@query
def url_caps(spark: SparkSession, d: str) -> DataFrame:
    """The first 8 requests of every user, with whether there were more."""
    return files.capped(table(spark, d, "events").select("user_id", "event_id"), "user_id", "event_id", 8)


def _log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query
def attempt_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return attempts.status_counts(table(spark, d, "events").withColumnRenamed("event_type", "status"), "status")


@query
def failure_stage_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events but purchases are failed attempts; the stage is the digit of their properties, unless they are views."""
    k = F.get_json_object("props", "$.k")
    log = table(spark, d, "events").select(
        F.when(F.col("event_type") == "purchase", "pdf_obtido").otherwise(F.col("event_type")).alias("status"),
        F.when(F.col("event_type") != "view", F.concat(F.lit("stage-"), F.right(k, F.lit(1)))).alias("stage"),
    )
    return attempts.failure_stages(log)


@query
def domain_status_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Pages as results: a page with anchors was a success."""
    pages = table(spark, d, "pages")
    status = attempts.result_status(F.size(html.hrefs(F.col("html"))), F.lit(1))
    results = pages.select(status.alias("status"), F.array(F.struct("url")).alias("attempts"))
    return attempts.first_attempt_by_domain(results, urls.host)


@query
def download_report(spark: SparkSession, d: str) -> DataFrame:
    """Users as works, their purchases as files (of odd value: a site's own) and their events as attempts."""
    log = table(spark, d, "events")
    status = F.when(F.col("event_type") == "purchase", "pdf_obtido").otherwise(F.col("event_type"))
    site = F.floor("value") % 2 == 1
    file = F.when(F.col("event_type") == "purchase", F.struct(F.when(site, "http://a/terms-of-use.pdf").otherwise("http://a/work.pdf").alias("url")))
    results = log.groupBy(F.col("user_id").alias("record_id")).agg(
        F.collect_list(file).alias("files"), F.collect_list(F.struct(status.alias("status"), F.lit(None).cast("string").alias("reason"))).alias("attempts")
    )
    results = results.withColumns({"status": attempts.result_status(F.size("files"), F.lit(1)), "limited": F.lit(False)})
    summary = attempts.record_summary(results, lambda u: F.contains(u, F.lit("terms-of-use")))
    out = attempts.download_report(summary, 10_000)
    return out.select(*(F.col(c).cast("long").alias(c) for c in out.columns))


@query
def cooldown_state(spark: SparkSession, d: str) -> DataFrame:
    """Errors block a user for two days, purchases are successes; seen from the end of 2024-01-15."""
    as_of = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return pacing.cooldowns(_log(spark, d), "user_id", "ts", F.col("event_type") == "error", F.col("event_type") == "purchase", 172_800, as_of).select(
        "user_id", F.unix_micros("last_block").alias("last_block"), F.unix_micros("last_success").alias("last_success"), F.unix_micros("blocked_until").alias("blocked_until"), "active"
    )


@query
def retry_eligibility(spark: SparkSession, d: str) -> DataFrame:
    """The last event of every user as its result, judged a day before the log's middle of January."""
    last = records.last_wins(_log(spark, d).select("user_id", "ts", "event_id", "event_type", "value"), "user_id", ["ts", "event_id"])
    status = F.when(F.col("event_type") == "purchase", "sucesso").otherwise("nao_obtido")
    verdict = pacing.retry_eligible(status, F.lit(True), F.col("value") > 50, F.col("ts"), F.lit("2024-01-31 00:00:00").cast("timestamp"), 86_400)
    return last.select("user_id", verdict.alias("verdict"))


@query
def host_pacing(spark: SparkSession, d: str) -> DataFrame:
    """When every user's requests may start if they keep an hour apart."""
    log = _log(spark, d).select("event_id", "user_id", F.unix_micros("ts").alias("arrival_us"))
    return pacing.paced(log, "user_id", "arrival_us", "event_id", 3_600_000_000)


@query
def raw_log_match(spark: SparkSession, d: str) -> DataFrame:
    """Events of one type and properties that lie within two minutes of each other."""
    log = _log(spark, d)
    key = F.concat("event_type", "props").alias("bytes")
    a, b = log.select("event_id", "ts", key), log.select(F.col("event_id").alias("raw_id"), F.col("ts").alias("modified"), key)
    return pacing.matching_raw(a, b, 120_000_000).where("event_id < raw_id").select("event_id", "raw_id")


@query
def retry_after_parse(spark: SparkSession, d: str) -> DataFrame:
    rows = [(1, "120"), (2, ""), (3, None), (4, "Wed, 21 Oct 2026 07:28:00 GMT"), (5, "soon"), (6, "-5"), (7, " 1.5 "), (8, "Wed, 21 Oct 2015 07:28:00 GMT")]
    df = spark.createDataFrame(rows, "id int, raw string")
    seconds, source = pacing.retry_after(F.col("raw"), F.lit("2026-10-21 07:00:00").cast("timestamp"))
    return df.select("id", seconds.alias("seconds"), source.alias("source"))


@query
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "pages").select(
        "page_id", urls.origin(u).alias("origin"), urls.host(u).alias("host"), urls.path(u).alias("path"), urls.query(u).alias("query"), urls.last_segment(u).alias("name")
    )


@query
def host_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").groupBy(urls.host(F.col("url")).alias("host")).agg(F.count("*").alias("pages"))


@query
def candidate_identity(spark: SparkSession, d: str) -> DataFrame:
    """Two bitstream variants of every page's URL, whose identities must meet, and the URL itself."""
    u = F.col("url")
    name = F.concat(urls.last_segment(u), F.lit(".PDF"))
    forms = F.array(
        F.concat(urls.origin(u), F.lit("/xmlui//bitstream/handle/1/2/"), name, F.lit("?sequence=1")),
        F.concat(urls.origin(u), F.lit("/bitstream/1/2/7/"), name, F.lit(";jsessionid=AB12")), u,
    )
    return table(spark, d, "pages").select("page_id", F.posexplode(forms).alias("form", "link")).select("page_id", "form", urls.identity(F.col("link")).alias("identity"))


@query
def anchor_targets(spark: SparkSession, d: str) -> DataFrame:
    """Every page's anchors in order."""
    return table(spark, d, "pages").select("page_id", F.posexplode(html.hrefs(F.col("html"))).alias("position", "target"))


@query
def link_extract(spark: SparkSession, d: str) -> DataFrame:
    """Candidate links of all pages, with a footer of known links put below each page."""
    footer = (
        '<meta name="citation_pdf_url" content="/files/main.pdf"><a href="/bitstream/1/2/a%20b.pdf">x</a><a href="/bitstream/1/2/pic.jpg">x</a>'
        '<a href="//cdn.example//x//y.pdf">x</a><a href="http://cdn.example/x/y.pdf">x</a><iframe src="doc" type="application/pdf"></iframe>'
        '<a href="/docs/Pol%C3%ADtica de Informa%C3%A7%C3%A3o.pdf">x</a>'
    )
    pages = table(spark, d, "pages").withColumn("html", F.concat("html", F.lit(footer)))
    return html.candidates(html.links(pages))


@query
def site_document_filter(spark: SparkSession, d: str) -> DataFrame:
    """Every page's URL with the name of a policy in one of two spellings, or its own."""
    u = F.col("url")
    named = F.when(F.contains(u, F.lit("/en/")), F.concat(urls.origin(u), F.lit("/Privacy%20Policy.pdf"))).when(F.contains(u, F.lit("/es/")), F.concat(urls.origin(u), F.lit("/Pol%C3%ADtica_de--Privacidade.pdf"))).otherwise(u)
    return table(spark, d, "pages").select("page_id", urls.site_document(named).alias("is_site_document"))


@query
def challenge_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages that ask to verify the browser; the mark is added to pages without anchors."""
    h = F.col("html")
    marked = F.when(F.contains(h, F.lit("<a href")), h).otherwise(F.concat(h, F.lit("<div class='G-Recaptcha'>")))
    return table(spark, d, "pages").select("page_id", html.is_challenge(marked).alias("challenge"))


@query
def content_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Pages as responses of several types, some with the signature of a PDF."""
    h = F.col("html")
    body = F.when(F.contains("url", F.lit("/en/")), F.concat(F.lit(" \n%PDF-1.7"), h, F.lit("%%EOF\n"))).when(F.contains("url", F.lit("/de/")), F.concat(F.lit("%PDF-1.7"), h)).otherwise(h)
    kind = F.when(F.contains("url", F.lit("example.com")), "application/pdf").when(F.contains("url", F.lit("example.net")), "text/html").otherwise("image/png")
    return table(spark, d, "pages").select("page_id", files.content_kind(body.cast("binary"), kind).alias("kind"))


@query
def boolean_groups(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(query_spec.matches_groups(F.col("text"), CONFIG)).select("doc_id")


@query
def clean_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.clean_url(F.concat(F.lit(" "), F.col("url"), F.lit("#part"))).alias("cleaned"))


@query
def robots_allowed(spark: SparkSession, d: str) -> DataFrame:
    """Pages of com hosts meet rules, of net hosts no policy, of org hosts an HTML answer."""
    pages = table(spark, d, "pages").select("page_id", "url")
    origins = pages.select(urls.origin(F.col("url")).alias("origin")).distinct()
    policies = origins.select(
        "origin", F.when(F.contains("origin", F.lit("example.net")), 404).otherwise(200).alias("status"),
        F.when(F.contains("origin", F.lit("example.org")), "<html>no</html>").otherwise("User-agent: *\nDisallow: /en/\nAllow: /\n").alias("body"),
    )
    return robots.checked(pages, policies, "gleaner").select("page_id", "robots")
