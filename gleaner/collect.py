"""The collection run: validate, plan, harvest, download, pack and report, resumable at any point.

State is a folder of Parquet tables; a run with another query refuses the folder. The control plane
(partitions, requests of a cycle, batches) is small and lives on the driver; pages, records and files
are tables.
"""

from __future__ import annotations

import argparse
import json
import re
import shutil
import sys
import time
from datetime import UTC, datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.urls import site_document
from gleaner.operators import attempts, files, pacing, records
from gleaner.plans import downloads, schemas
from gleaner.plans.partitions import PAGE, WINDOW, archived_facets, smallest
from gleaner.plans.query_spec import YEAR_PREFIX, partition_id, quoted, signature
from gleaner.sources import scans, sinks, transport, web
from gleaner.streaming.commit import ChangedPage, commit

# Why a run ends.
TARGET, TIME, RECORDS, BUDGET, DONE = (
    "meta_atingida",
    "limite_de_tempo_da_execucao",
    "limite_de_registros_da_execucao",
    "orcamento_de_transferencia_da_execucao",
    "particoes_e_fila_esgotadas",
)
RESERVE = "reserva_de_disco"
MANIFEST = "raw/manifest_pdf.jsonl"  # fixed value
NO_YEAR = "-publishDate:[* TO *]"
ANY_YEAR = "publishDate:[* TO *]"
RETRYABLE = {429, 500, 502, 503, 504}
STATE = "id STRING, version BIGINT, label STRING, kind STRING, filters ARRAY<STRING>, parent_id STRING, priority BIGINT, child BIGINT, status STRING, total BIGINT, next_page INT, inaccessible BIGINT, error STRING"


class RateLimited(ConnectionError):
    """The API asked to wait."""


class Collector:
    fallback_s = 3600.0  # a wait that the server does not state

    def __init__(self, spark: SparkSession, config: dict, folder: str | Path, **options: str) -> None:
        """``options`` go to the web sources: agent, transport, interval_s."""
        self.spark, self.config, self.folder = spark, config, Path(folder)
        self.options, self.transferred = options, 0
        self.folder.mkdir(parents=True, exist_ok=True)
        self.signature = signature(config, window=WINDOW, page=PAGE)
        held = self.folder / "settings.json"
        if held.exists() and json.loads(held.read_text())["signature"] != self.signature:
            raise ValueError("the folder belongs to another query; use another folder")
        if not held.exists():
            sinks.atomic_text(held, json.dumps({"signature": self.signature}))

    def _path(self, name: str) -> str:
        return str(self.folder / name)

    def table(self, name: str, schema: str) -> DataFrame:
        return scans.stored(self.spark, self._path(name), schema)

    # Partitions -------------------------------------------------------------------------------

    def partitions(self) -> DataFrame:
        return records.last_wins(self.table("partitions", STATE), "id", ["version"])

    def _put(self, rows: list[dict]) -> None:
        names = [f.split()[0] for f in STATE.split(", ")]
        version = time.time_ns()
        data = [tuple((r | {"version": version}).get(n) for n in names) for r in rows]
        self.spark.createDataFrame(data, STATE).coalesce(1).write.mode("append").parquet(self._path("partitions"))

    def _request(self, *asked: dict) -> list:
        """Answers of the API, valid ones cached by URL; one row per request, null where a 429 came before."""
        cache = self.table("api_cache", "url STRING, sha STRING, body STRING")
        log = self.table("http_log", schemas.HTTP_LOG)
        last = log.where("source = 'network'").agg(F.max("ts")).first()[0]
        options = self.options | ({"last": str(last.timestamp())} if last else {}) | self._policy() | {"policies": "true"}
        rows = web.search(self.spark, self.config, list(asked), cache, **options).collect()  # a page each
        fresh = [r for r in rows if r["harvest_ts"] is not None]
        events = [(r["harvest_ts"], r["url"], None if r["status"] is None else str(r["status"]), None, len((r["body"] or "").encode()), r["error"], "network", r["sha"]) for r in fresh]
        if events:
            self.spark.createDataFrame(events, schemas.HTTP_LOG).coalesce(1).write.mode("append").parquet(self._path("http_log"))
        for r in fresh:
            if r["page"] == 0:
                sinks.atomic_text(self.folder / "api_robots.json", json.dumps({"answer": [r["status"], r["body"]], "at": r["harvest_ts"].timestamp()}))
            elif r["status"] == 429:
                self._limited(r)
        rows = [r for r in rows if r["page"] != 0]
        good = self.spark.createDataFrame([(r["url"], r["sha"], r["body"]) for r in rows if r["status"] == 200], "url STRING, sha STRING, body STRING")
        sinks.append_new(good.where(records.page_error(F.try_parse_json("body")).isNull()), self._path("api_cache"), "url")
        by_place = {(r["partition_id"], r["page"]): r for r in rows}
        got = [by_place.get((partition_id(a.get("filters", [])), a.get("page", 1))) for a in asked]
        if any(r is None or r["status"] == 429 for r in got):
            raise RateLimited("http_429")
        return got

    def _policy(self, ttl_s: float = 86_400) -> dict[str, str]:
        """The policy of the API's origin, if it was asked for within ``ttl_s``."""
        path = self.folder / "api_robots.json"
        held = json.loads(path.read_text(encoding="utf-8")) if path.exists() else {"at": 0}
        return {"policy": json.dumps(held["answer"])} if time.time() - held["at"] <= ttl_s else {}

    def _limited(self, row, fallback_s: float | None = None) -> None:
        """Record a 429 and until when it blocks: what the server says, or the run's own wait."""
        now = row["harvest_ts"].astimezone(UTC)
        wait, source = transport.wait_seconds(row["retry_after"], now.timestamp()), "server_retry_after"
        if wait is None:
            wait, source = self.fallback_s if fallback_s is None else fallback_s, "client_policy_invalid_retry_after" if row["retry_after"] else "client_policy_no_retry_after"
        event = (now, row["url"], 429, row["retry_after"], now + timedelta(seconds=wait), source, (row["body"] or row["error"] or "")[:4096])
        self.spark.createDataFrame([event], schemas.RATE_LIMITS).coalesce(1).write.mode("append").parquet(self._path("rate_limits"))

    def cooldown(self, now: datetime) -> datetime | None:
        """Until when the API is not to be asked: the last block, unless an answer came after it or it is over.

        A folder whose log tells of a 429 that no block was recorded for is blocked for the run's own wait.
        """
        log = self.table("http_log", schemas.HTTP_LOG).where("source = 'network' AND url NOT LIKE '%/robots.txt'")
        seen = log.agg(F.max(F.when(F.col("status").startswith("2"), F.col("ts"))).alias("good"), F.max(F.when(F.col("status") == "429", F.col("ts"))).alias("bad")).first()
        block = self.table("rate_limits", schemas.RATE_LIMITS).agg(F.max_by(F.struct("observed_at", "blocked_until"), "observed_at").alias("b")).first()["b"]
        at, until = (block["observed_at"], block["blocked_until"]) if block else (seen["bad"], seen["bad"] and seen["bad"] + timedelta(seconds=self.fallback_s))
        if at is None or (seen["good"] is not None and seen["good"] > at):
            return None
        until = until.astimezone(UTC)
        return until if until > now else None

    def _total(self, answer) -> int | None:
        try:
            return json.loads(answer["body"])["resultCount"]
        except (TypeError, ValueError, KeyError):
            return None

    def _facets(self) -> tuple[int, dict[str, int], dict[str, int]]:
        root = json.loads(self._request({"limit": 1, "facets": ["publishDate", "institution"]})[0]["body"] or "{}")
        found = {k: {str(i["value"]): int(i["count"]) for i in root.get("facets", {}).get(k, [])} for k in ("publishDate", "institution")}
        if not found["publishDate"] or not found["institution"]:
            raise ValueError("the API returned no facets")
        values = [(field, value, count, datetime.now(UTC)) for field, counts in found.items() for value, count in counts.items()]
        sinks.append_new(self.spark.createDataFrame(values, schemas.FACET_VALUES).coalesce(1), self._path("facet_values"), "field", "value")
        return root["resultCount"], found["publishDate"], found["institution"]

    def validate(self, strict: bool = True) -> dict:
        """Check the partition algebra on the smallest year and the first institution; all three checks are reported."""
        root, years, insts = self._facets()
        year = min((y for y in years if years[y] > 0), key=lambda y: years[y])  # of equal ones the first listed
        held = archived_facets(self.table("facet_values", schemas.FACET_VALUES), self.table("api_cache", "url STRING, sha STRING, body STRING"), "institution")
        inst, at = smallest(held).first()["value"], YEAR_PREFIX + year
        asks = [[at], [at, quoted("institution", inst)], [at, quoted("institution", inst, True)], [NO_YEAR], [ANY_YEAR, *(quoted("publishDate", y, True) for y in years)]]
        by_year, child, residual, none, other = (self._total(r) for r in self._request(*({"filters": f, "limit": 1} for f in asks)))
        last = max(1, -(-min(child, WINDOW) // PAGE))
        pages = [json.loads(r["body"] or "{}").get("records", []) for r in self._request({"filters": asks[1], "page": last}, {"filters": asks[1], "page": last + 1})]
        ids = [[r.get("id") for r in p] for p in pages]
        boundary = None if not child else (not ids[1] if child <= WINDOW else bool(ids[0]) and ids[0] == ids[1])
        report = {
            "root": root, "year": year, "year_matches": by_year == years[year], "child": child, "residual_matches": residual == by_year - child,
            "no_year": none, "other_matches": other == root - sum(years.values()) - none, "boundary_valid": boundary,
        }
        report["valid"] = report["year_matches"] and report["residual_matches"] and report["other_matches"] and boundary is not False
        sinks.atomic_text(self.folder / "reports/partition_validation.json", json.dumps(report, indent=2))
        if strict and not report["valid"]:
            raise ValueError("the partition algebra does not hold")
        return report

    def plan(self) -> None:
        """The root partitions; nothing is done if there are partitions."""
        if self.partitions().limit(1).count():
            return
        _, years, _ = self._facets()
        listed = sorted(years, reverse=True)
        rows = [{"label": y, "kind": "year", "filters": [YEAR_PREFIX + y]} for y in listed]
        rows.append({"label": "other years", "kind": "other", "filters": [ANY_YEAR, *(quoted("publishDate", y, True) for y in listed)]})
        rows.append({"label": "no year", "kind": "none", "filters": [NO_YEAR]})
        self._put([r | {"id": partition_id(r["filters"]), "priority": i, "child": 0, "status": "planned", "next_page": 1, "inaccessible": 0} for i, r in enumerate(rows)])

    def harvest_one(self) -> bool:
        """Harvest the next page of the next partition; False if none is left."""
        part = self.partitions().where(F.col("status").isin("planned", "harvesting")).orderBy("priority", "child", "id").limit(1).first()
        if part is None:
            return False
        part = part.asDict()
        answer = self._request({"filters": part["filters"], "page": part["next_page"]})[0]
        if answer["status"] in RETRYABLE or (answer["status"] is None and answer["error"]):
            raise ConnectionError(answer["error"] or f"http_{answer['status']}")
        total = self._total(answer)
        state = part | {"error": None}
        if total is None or (part["total"] is not None and total != part["total"]):
            self._put([state | {"status": "inaccessible", "error": "the total changed" if total is not None else "no valid answer", "inaccessible": part["total"] or 0}])
            return True
        state["total"] = total
        if part["status"] == "planned" and total > WINDOW and part["kind"] == "year":
            insts = sorted(self._facets()[2].items(), key=lambda x: (-x[1], x[0]))
            kids = [(f"{part['label']} / {i}", "institution", quoted("institution", i)) for i, _ in insts]
            rows = [{"label": n, "kind": k, "filters": [*part["filters"], f]} for n, k, f in kids]
            rows.append({"label": f"{part['label']} / other institutions", "kind": "residual", "filters": [*part["filters"], *(quoted("institution", i, True) for i, _ in insts)]})
            new = [r | {"id": partition_id(r["filters"]), "parent_id": part["id"], "priority": part["priority"], "child": i + 1, "status": "planned", "next_page": 1, "inaccessible": 0} for i, r in enumerate(rows)]
            self._put([state | {"status": "split"}, *new])
            return True
        page = self.spark.createDataFrame([(part["id"], part["next_page"], answer["url"], answer["sha"], answer["body"], answer["harvest_ts"] or datetime.now(UTC))], "partition_id STRING, page INT, url STRING, sha STRING, body STRING, harvest_ts TIMESTAMP")
        try:
            commit(page, str(self.folder))
        except ChangedPage as error:
            self._put([state | {"status": "inaccessible", "error": str(error)}])
            return True
        pages = -(-min(total, WINDOW) // PAGE)
        if part["next_page"] < pages:
            self._put([state | {"status": "harvesting", "next_page": part["next_page"] + 1}])
        else:
            over = max(0, total - WINDOW)
            self._put([state | {"status": "partial" if over else "complete", "inaccessible": over}])
        return True

    # Records and downloads --------------------------------------------------------------------

    def records(self) -> DataFrame:
        """(record_id, title, urls) of harvested and imported records."""
        rows = self.table("records", schemas.RECORDS).withColumn("v", F.try_parse_json("payload"))
        urls = F.filter(F.transform(F.try_variant_get("v", "$.urls", "array<variant>"), lambda u: F.coalesce(F.try_variant_get(u, "$.url", "string"), F.try_variant_get(u, "$", "string"))), lambda u: u.isNotNull())
        return rows.select("record_id", F.try_variant_get("v", "$.title", "string").alias("title"), F.coalesce(urls, F.array().cast("array<string>")).alias("urls"))

    def import_metadata(self, *paths: str) -> dict:
        """Import compatible records of other harvests; what is known stays. Reports the counts of each file."""
        count = lambda: self.table("records", schemas.RECORDS).count()
        first, sources = count(), []
        for path in map(str, paths):
            rows = scans.download_input(self.spark, path)
            more = scans.jsonl(self.spark, path, "record_id STRING, formats ARRAY<STRING>, source_url STRING, query_id STRING")
            rows = rows.join(more, "record_id").withColumn("basis", records.import_basis(F.col("formats"), F.col("source_url"), self.config)).persist()
            good, sha, before = rows.where("basis IS NOT NULL"), scans.files_sha(self.spark, path), count()
            payload = F.to_json(F.struct("title", "urls", "formats"))
            sinks.append_new(good.select("record_id", payload.alias("payload"), F.current_timestamp().alias("discovered_at")), self._path("records"), "record_id")
            held = good.select("record_id", F.lit(path).alias("source_path"), F.col("query_id").alias("source_query_id"), F.col("basis").alias("compatibility_basis"), F.lit(sha).alias("source_sha"), payload.alias("payload"), F.current_timestamp().alias("imported_at"))
            sinks.append_new(held, self._path("record_sources"), "record_id", "source_path")
            n = rows.agg(F.count("*").alias("rows"), F.count("basis").alias("compatible")).first()
            rows.unpersist()
            sources.append({"path": path, "sha256": sha, "rows": n["rows"], "compatible": n["compatible"], "rejected": n["rows"] - n["compatible"], "inserted": count() - before})
        total = lambda key: sum(x[key] for x in sources)
        out = {
            "files": len(sources), "rows_read": total("rows"), "compatible_rows": total("compatible"), "rejected_rows": total("rejected"), "inserted_records": total("inserted"),
            "duplicate_records": total("compatible") - total("inserted"), "unique_records_before": first, "unique_records_after": count(), "sources": sources,
        }
        sinks.atomic_text(self.folder / "reports/import_existing_metadata.json", json.dumps(out, ensure_ascii=False, indent=2))
        return out

    def results(self) -> DataFrame:
        return records.last_wins(self.table("results", schemas.RESULTS), "record_id", ["finished_at"])

    def reuse_downloads(self, *folders: str | Path) -> dict:
        """Take over other folders' results, with their files, for known records; a result that is there stays.

        A folder whose manifest was taken over before is left out. A path that leaves its folder, and a
        file that is missing or has another hash than the manifest states, are errors, and then nothing
        of that folder is taken over.
        """
        unknown = 0
        for folder in (Path(f).resolve() for f in folders):
            manifest = str(folder / MANIFEST)
            sha = scans.files_sha(self.spark, manifest)
            if sha is None:
                raise ValueError(f"{folder} has no {MANIFEST}")
            seen = self.table("reuse_sources", schemas.REUSE_SOURCES).where((F.col("source_dir") == str(folder)) & (F.col("manifest_sha") == sha))
            if not seen.limit(1).count():
                unknown += self._reuse(folder, manifest, sha)
        taken = self.table("reused_files", schemas.REUSED_FILES).groupBy("sha").agg(F.bool_or("is_site").alias("site"), F.bool_or(~F.col("is_site")).alias("work"))
        sums = records.last_wins(self.table("reuse_sources", schemas.REUSE_SOURCES), "source_dir", ["imported_at"])
        sums = sums.agg(F.count("*").alias("sources"), F.coalesce(F.sum("records"), F.lit(0)).alias("records_reused"), F.coalesce(F.sum("files"), F.lit(0)).alias("file_associations"))
        counts = taken.agg(F.count("*").alias("unique_files"), F.count_if("work").alias("candidate_files"), F.count_if("site").alias("site_document_files"))
        return sinks.report(sums.crossJoin(counts).withColumn("skipped_unknown_records", F.lit(unknown)), self.folder / "reports/reused_downloads.json")  # one row each

    def _reuse(self, folder: Path, manifest: str, sha: str) -> int:
        """Take over one folder; how many of its rows name no known record."""
        rows = scans.jsonl(self.spark, manifest, schemas.RESULTS)
        known = rows.join(self.records().select("record_id"), "record_id", "left_semi").persist()
        named = known.select("record_id", F.explode("files").alias("f")).select("record_id", "f.*").withColumn("at", scans.contained("path")).persist()
        there = scans.contents(self.spark, str(folder)).withColumn("real", F.sha2("content", 256))
        checked = named.join(there.select(F.col("path").alias("at"), "real"), "at", "left").where("real IS DISTINCT FROM sha256")
        if wrong := checked.select("path", "at").first():
            raise ValueError(f"{wrong['path']} leaves its folder" if wrong["at"] is None else f"{wrong['path']} is missing or differs from its hash")
        content = there.join(named.select("sha256").distinct(), F.col("real") == F.col("sha256"), "left_semi")
        sinks.archive(content.select(F.col("real").alias("sha"), "content"), self._path("archive"))
        path = lambda f: F.concat(F.lit("raw/pdf/"), F.substring(f["sha256"], 1, 2), F.lit("/"), f["sha256"], F.lit(".pdf"))
        moved = F.transform(F.coalesce("files", F.array().cast(f"array<{schemas.FILE}>")), lambda f: F.struct(f["sha256"].alias("sha256"), path(f).alias("path"), f["bytes"].alias("bytes"), f["url"].alias("url"), F.lit("pdf").alias("kind")))
        open_end = F.coalesce("limited", F.lit(False)) | ~F.col("status").eqNullSafe(F.lit("sucesso")) | F.coalesce(F.exists("attempts", lambda a: ~F.coalesce(a["status"], F.lit("")).isin(*attempts.COMPLETED)), F.lit(False))
        first = F.min_by(F.struct(*known.columns), F.struct("finished_at")).alias("r")
        fresh = known.groupBy("record_id").agg(first).select("r.*").join(self.results().select("record_id"), "record_id", "left_anti")
        fresh = fresh.withColumn("limited", open_end).withColumn("files", moved)
        shaped = self.spark.createDataFrame([], schemas.RESULTS).unionByName(fresh.select(*rows.columns)).persist()
        n, links, skipped = shaped.count(), named.count(), rows.count() - known.count()
        taken = shaped.select("record_id", F.explode("files").alias("f")).select(F.col("f.sha256").alias("sha"), "record_id", site_document(F.coalesce("f.url", F.lit(""))).alias("is_site"), F.lit(str(folder)).alias("source_dir"))
        taken.write.mode("append").parquet(self._path("reused_files"))
        shaped.write.mode("append").parquet(self._path("results"))
        done = [(str(folder), sha, datetime.now(UTC), n, links)]
        self.spark.createDataFrame(done, schemas.REUSE_SOURCES).coalesce(1).write.mode("append").parquet(self._path("reuse_sources"))
        for df in (known, named, shaped):
            df.unpersist()
        return skipped

    def export(self) -> None:
        """Write records and rejections, the manifest of results and what pages said as JSON lines, each in its order."""
        held = self.table("records", schemas.RECORDS).withColumn("line", F.col("payload"))
        sinks.lines(held, self._path("metadata/records.jsonl"), "discovered_at", "record_id")
        refused = self.table("rejections", schemas.REJECTIONS).withColumnRenamed("raw_sha", "raw_sha256").withColumn("payload", F.try_parse_json("payload"))
        refused = refused.select("partition_id", "page", "position", F.to_json(F.struct("*")).alias("line"))
        sinks.lines(refused, self._path("metadata/rejections.jsonl"), "partition_id", "page", "position")
        results = self.results()
        sinks.jsonl(results, self._path(MANIFEST), "record_id")
        said = results.select("record_id", F.posexplode("metadata_from_html").alias("n", "m"))
        opened = F.expr("rtrim('}', to_json(named_struct('record_id', record_id)))")
        said = said.withColumn("line", F.concat(opened, F.when(F.size("m") == 0, "}").otherwise(F.concat(F.lit(","), F.substring(F.to_json("m"), 2, 1 << 30)))))
        sinks.lines(said, self._path("staging/metadata_html.jsonl"), "record_id", "n")

    def download(self, as_of: datetime, retry_s: int = 86_400, most: int = 50, limits: dict | None = None) -> int:
        """Fetch what one cycle's records name and link to; returns how many records were tried."""
        held = self.results()
        archive = self.table("archive", "sha STRING, content BINARY, prefix STRING").select(F.concat(F.lit("raw/pdf/"), F.substring("sha", 1, 2), F.lit("/"), "sha", F.lit(".pdf")).alias("path"), F.octet_length("content").cast("bigint").alias("bytes"))
        named = held.withColumn("files", F.transform("files", lambda f: F.struct(f["sha256"].alias("sha"), f["path"].alias("path"), f["bytes"].alias("bytes"))))
        valid = files.finished(named, sinks.Packer(self.spark, self.folder / "batches", 1).archived(), archive)
        todo = downloads.queue(self.records(), valid, retry_s, F.lit(as_of), most).persist()
        there = archive.withColumnRenamed("bytes", "size")
        each = held.join(todo.select("record_id"), "record_id", "left_semi").select("record_id", F.posexplode("files").alias("n", "f"))
        each = each.join(there, F.col("f.path") == F.col("path")).where("size = f.bytes")
        kept = each.groupBy("record_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "f"))), lambda x: x["f"]).alias("files"))
        told = held.join(todo.select("record_id"), "record_id", "left_semi").select("record_id", "metadata_from_html")
        slim = F.transform(F.coalesce("files", F.array().cast(f"array<{schemas.FILE}>")), lambda f: F.struct(f["sha256"].alias("sha256"), f["path"].alias("path"), f["bytes"].alias("bytes"), f["url"].alias("url")))
        prior = told.join(kept, "record_id", "left").select("record_id", slim.alias("files"), "metadata_from_html").persist()
        owned = prior.select("record_id", F.explode("files.url").alias("url"))
        first_list = [tuple(r) for r in downloads.first_urls(todo, owned).collect()]  # of at most ``most`` records
        first = downloads.classified(self._fetched(first_list, limits)).persist()
        links, pages = downloads.second_urls(first)
        second_list = [tuple(r) for r in links.collect()]
        second = downloads.classified(self._fetched(second_list, limits)).withColumn("status", F.coalesce("status", F.lit("limite_profundidade"))).persist()
        fetched = first.unionByName(second)
        sinks.archive(fetched.where("kind = 'pdf'").select(F.col("sha256").alias("sha"), "content"), self._path("archive"))
        columns = ["record_id", "depth", "url", "at", "final_url", "kind", "sha256", "bytes", "status", "error", "stage"]
        many = F.lit(False).alias("too_many")
        tried = first.where("status IS NOT NULL").select(*columns, many).unionByName(second.select(*columns, many)).unionByName(pages.select(*columns, "too_many"))
        done = downloads.results(todo, tried, F.lit(as_of), prior, downloads.page_metadata(first))
        log = fetched.select(F.col("at").alias("ts"), "url", F.coalesce(F.col("http_status").cast("string"), F.col("error")).alias("status"), F.lit(None).cast("int").alias("attempt"), "bytes", "error", F.lit("download").alias("source"), F.col("sha256"))
        log.write.mode("append").parquet(self._path("http_log"))
        self.transferred += fetched.agg(F.coalesce(F.sum("transferred"), F.lit(0))).first()[0]
        n = todo.count()
        shaped = self.spark.createDataFrame([], schemas.RESULTS)
        done = shaped.unionByName(done.withColumns({
            "files": F.transform("files", lambda f: F.struct(f["sha256"].alias("sha256"), f["path"].alias("path"), f["bytes"].alias("bytes"), f["url"].alias("url"), F.lit("pdf").alias("kind"))),
            "attempts": F.transform("attempts", lambda a: F.struct(*(a[c].alias(c) for c in ("url", "at", "depth", "final_url", "kind", "sha256", "bytes", "status", "reason", "stage")), F.lit(None).cast("string").alias("run_id"))),
        }))
        done.write.mode("append").parquet(self._path("results"))
        for df in (todo, first, second, prior):
            df.unpersist()
        return n

    def _fetched(self, urls: list[tuple], limits: dict | None) -> DataFrame:
        """Fetch at once and keep the answers, so that no later plan repeats a request."""
        path = self._path(f"fetched/{time.time_ns()}")
        web.fetch(self.spark, urls, limits, **self.options).write.parquet(path)
        return self.spark.read.parquet(path)

    def report(self, stop_reason: str) -> dict:
        parts = self.partitions().withColumn("inaccessible", F.coalesce("inaccessible", F.lit(0)))
        batches = sinks.Packer(self.spark, self.folder / "batches", 1).batches()
        one = attempts.coverage_report(parts, self.table("record_partitions", schemas.RECORD_PARTITIONS), batches)
        work = downloads.work_files(self.results()).groupBy("sha256").agg(F.bool_or(~F.col("is_site")).alias("c"), F.bool_or("is_site").alias("s"))
        counts = work.agg(F.count("*").alias("all_unique_pdfs"), F.count_if("c").alias("candidate_unique_pdfs"), F.count_if("s").alias("known_site_documents"))
        return sinks.report(one.crossJoin(counts).withColumn("stop_reason", F.lit(stop_reason)), self.folder / "reports/collection.json")

    def candidates(self) -> int:
        return downloads.work_files(self.results()).where("NOT is_site").select("sha256").distinct().count()

    def run(
        self, target: int, seconds: float, target_bytes: int, retry_s: int = 86_400, most_records: int | None = None, limits: dict | None = None, max_waits: int = 4,
        wait_s: float = 3600.0, budget_bytes: int = 20 << 30, reserve_bytes: int = 0, sleep=time.sleep, clock=lambda: datetime.now(UTC),
    ) -> dict:
        """Alternate downloads and harvesting until a limit is met or nothing is left; then pack and report.

        While the API asks to wait, in this run or before it, only downloads go on. Limits are looked at
        between cycles of at most 50 records; what a cycle may transfer is what the budget has left.
        """
        self.fallback_s = wait_s
        end, tried, waits = clock() + timedelta(seconds=seconds), 0, 0
        packer = sinks.Packer(self.spark, self.folder / "batches", target_bytes)
        metadata = lambda: self.table("records", schemas.RECORDS).select("record_id", "payload")
        started = clock()
        ready = False
        while True:
            room = None if most_records is None else most_records - tried
            left = budget_bytes - self.transferred
            n = 0
            if left > 0 and (room is None or room > 0):
                n = self.download(started, retry_s, min(50, room) if room is not None else 50, (limits or {}) | {"budget_bytes": left})
            tried += n
            packer.close_all(self.results(), metadata())
            reason = (
                TARGET if self.candidates() >= target
                else RESERVE if shutil.disk_usage(self.folder).free <= reserve_bytes
                else TIME if clock() >= end
                else RECORDS if most_records is not None and tried >= most_records
                else BUDGET if self.transferred >= budget_bytes
                else None
            )
            if reason:
                break
            if until := self.cooldown(clock()):
                if n:
                    continue  # the queue first
                if until >= end:
                    reason = f"{TIME}_durante_espera_429"
                    break
                while (pause := (until - clock()).total_seconds()) > 0:
                    sleep(min(30.0, pause))
                continue
            try:
                if not ready:
                    if not (self.folder / "reports/partition_validation.json").exists():
                        self.validate()
                    self.plan()
                    ready = True
                if not self.harvest_one() and not n:
                    reason = DONE
                    break
            except RateLimited:
                waits += 1
                if waits > max_waits:
                    reason = "rate_limit_429_em_harvest; retome mais tarde"
                    break
            except ConnectionError as error:
                waits += 1
                if waits > max_waits or clock() + timedelta(seconds=wait_s) >= end:
                    reason = f"erro_de_rede_em_harvest; {error}"
                    break
                sleep(pacing_wait(wait_s, waits))
        if reason in (TARGET, DONE):
            packer.close_all(self.results(), metadata(), force=True)
        self.export()
        return self.report(reason)


def pacing_wait(base: float, attempt: int) -> float:
    return base * min(attempt, 4)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="gleaner.collect", description=__doc__)
    p.add_argument("--contact", required=True)
    p.add_argument("--config", required=True, type=Path)
    p.add_argument("--data-dir", default="data/collection")
    p.add_argument("--target-pdfs", type=int, default=5000)
    p.add_argument("--batch-gb", type=float, default=1)
    p.add_argument("--reserve-gb", type=float, default=10)
    p.add_argument("--budget-gb", type=float, default=20)
    p.add_argument("--max-hours", type=float, default=8)
    p.add_argument("--rate-limit-wait-minutes", type=float, default=60)
    p.add_argument("--max-rate-limit-waits", type=int, default=4)
    p.add_argument("--max-records", type=int)
    p.add_argument("--repository-retry-hours", type=float, default=24)
    p.add_argument("--import-metadata", action="append", default=[])
    p.add_argument("--reuse-pdf-dir", action="append", default=[])
    p.add_argument("--validate-only", action="store_true")
    a = p.parse_args(argv)
    if not re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", a.contact):
        p.error("--contact must be an e-mail address")
    if not 1 <= a.target_pdfs <= 5000:
        p.error("--target-pdfs must be between 1 and 5000")
    if min(a.batch_gb, a.budget_gb, a.max_hours, a.repository_retry_hours) <= 0 or a.reserve_gb < 0:
        p.error("limits must be positive")
    return a


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    spark = SparkSession.builder.appName("gleaner.collect").config("spark.task.maxFailures", "1").config("spark.speculation", "false").getOrCreate()
    collector = Collector(spark, json.loads(a.config.read_text(encoding="utf-8")), a.data_dir, agent=f"gleaner (contact: {a.contact})")
    if a.import_metadata:
        collector.import_metadata(*a.import_metadata)
    if a.reuse_pdf_dir:
        collector.reuse_downloads(*a.reuse_pdf_dir)
    try:
        if a.validate_only:
            collector.validate()
        else:
            collector.run(
                a.target_pdfs, a.max_hours * 3600, int(a.batch_gb * 2**30), int(a.repository_retry_hours * 3600), a.max_records, None,
                a.max_rate_limit_waits, a.rate_limit_wait_minutes * 60, int(a.budget_gb * 2**30), int(a.reserve_gb * 2**30),
            )
    except KeyboardInterrupt:
        collector.report("interrompido_pelo_usuario")
        return 130
    except Exception as error:  # the report says how far the run came
        collector.report(f"erro: {error}")
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
