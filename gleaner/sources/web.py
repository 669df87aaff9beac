"""Python data sources: pages of the search API and fetched resources.

Reading has effects on servers, so a read is to be staged at once and run without task retries and
speculation. The API source has one partition, as its requests keep their distance and share one
policy; ``last`` and ``policy`` carry both on to the next read. The fetch source has one per host, so
that a host's pacing is one task's business; the hosts share the read's bytes in equal parts.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gleaner.plans.query_spec import partition_id, request_url
from gleaner.sources.transport import Client, FetchError, Limits, load, utc_now

_URLLIB = "gleaner.sources.transport:urllib_transport"


@dataclass
class _Requests(InputPartition):
    """What one task asks for."""

    rows: tuple

    def __init__(self, rows: tuple) -> None:
        self.rows = rows


class SearchApi(DataSource):
    """Options: config (JSON), requests (JSON list of {filters, page, limit, facets}), agent, transport, interval_s,
    last (epoch seconds of the request before), policy (JSON of status and text of the origin's robots.txt), policies.

    With ``policies`` set to true a policy that was asked for is a row of its own, with page 0. Requests after a 429 are not made.
    """

    @classmethod
    def name(cls) -> str:
        return "gleaner_search"

    def schema(self) -> str:
        return "partition_id STRING, page INT, url STRING, status INT, sha STRING, body STRING, error STRING, retry_after STRING, harvest_ts TIMESTAMP"

    def reader(self, schema) -> SearchReader:
        return SearchReader(dict(self.options))


class SearchReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.config, self.requests = json.loads(options["config"]), json.loads(options["requests"])
        self.agent, self.transport = options.get("agent", "gleaner"), options.get("transport", _URLLIB)
        self.interval_s, self.last, self.policy = float(options.get("interval_s", 10)), float(options.get("last", 0)), json.loads(options.get("policy", "null"))
        self.policies = options.get("policies") == "true"

    def partitions(self) -> list[InputPartition]:
        return [_Requests(tuple(self.requests))] if self.requests else []

    def read(self, partition: _Requests | None) -> Iterator[tuple]:
        limits = Limits(file_bytes=20 << 20, tries=4, interval_s=self.interval_s, retry_base_s=15.0, retry_429=False)
        client, p = Client(self.agent, load(self.transport), limits), urlsplit(self.config["endpoint"])
        client.last[p.netloc] = self.last
        if self.policy:
            origin = f"{p.scheme}://{p.netloc}"
            client.policies[origin] = client.adopt(origin, *self.policy)
        for r in partition.rows if partition else ():  # none if there are no requests
            filters, page = r.get("filters", []), r.get("page", 1)
            url = request_url(self.config, page, r.get("limit"), filters, r.get("facets", []))
            status, body, error, wait = None, None, None, None
            try:
                client._check_policy(url)
                status, headers, raw = client._transfer(url, client.limits.file_bytes, "resource")
                body, wait = raw.decode("utf-8", "replace"), headers.get("retry-after")
            except FetchError as failure:
                status, error, wait = failure.status, failure.code, failure.wait
            for at, answered, text in client.bodies.values() if self.policies else ():
                yield None, 0, at, answered, None, text, None, None, utc_now()
            client.bodies.clear()
            sha = None if body is None else hashlib.sha256(body.encode()).hexdigest()
            yield partition_id(filters), page, url, status, sha, body, error, wait, utc_now()
            if status == 429:
                return


class Fetch(DataSource):
    """Options: urls (JSON list of [record_id, url, depth]), agent, transport, limits (JSON)."""

    @classmethod
    def name(cls) -> str:
        return "gleaner_fetch"

    def schema(self) -> str:
        return (
            "record_id STRING, url STRING, depth INT, at TIMESTAMP, final_url STRING, content_type STRING, charset STRING, sha256 STRING,"
            " bytes BIGINT, content BINARY, error STRING, stage STRING, http_status INT, transferred BIGINT"
        )

    def reader(self, schema) -> FetchReader:
        return FetchReader(dict(self.options))


class FetchReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.urls = json.loads(options["urls"])
        self.agent, self.transport = options.get("agent", "gleaner"), options.get("transport", _URLLIB)
        self.limits = Limits(**json.loads(options.get("limits", "{}")))
        hosts = {urlsplit(row[1]).netloc for row in self.urls}
        self.limits.budget_bytes //= max(1, len(hosts))

    def partitions(self) -> list[InputPartition]:
        hosts = defaultdict(list)
        for row in self.urls:
            hosts[urlsplit(row[1]).netloc].append(tuple(row))
        return [_Requests(tuple(rows)) for _, rows in sorted(hosts.items())]

    def read(self, partition: _Requests | None) -> Iterator[tuple]:
        client = Client(self.agent, load(self.transport), self.limits)
        got: dict[str, tuple] = {}
        for record_id, url, depth in partition.rows if partition else ():
            before = client.transferred
            if url not in got:
                at = utc_now()
                try:
                    r = client.fetch(url)
                    got[url] = (at, r["url"], r["content_type"], r["charset"], r["sha256"], r["bytes"], r["content"], None, None, 200)
                except FetchError as failure:
                    got[url] = (at, None, None, None, None, None, None, failure.code, failure.stage, failure.status)
            yield (record_id, url, depth, *got[url], client.transferred - before)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SearchApi)
    spark.dataSource.register(Fetch)


def search(spark: SparkSession, config: dict, requests: list[dict], cache: DataFrame | None = None, **options: str) -> DataFrame:
    """Pages of the API; requests whose URL the cache (url, sha, body) holds are answered from it.

    ``requests`` is a plan of pages, so it is a list of the driver's.
    """
    register(spark)
    urls = {request_url(config, r.get("page", 1), r.get("limit"), r.get("filters", []), r.get("facets", [])): r for r in requests}
    cached = None
    if cache is not None:
        plan = spark.createDataFrame([(u, partition_id(r.get("filters", [])), r.get("page", 1)) for u, r in urls.items()], "url string, partition_id string, page int")
        cached = cache.join(plan, "url").selectExpr("partition_id", "page", "url", "200 AS status", "sha", "body", "CAST(NULL AS STRING) AS error", "CAST(NULL AS STRING) AS retry_after", "CAST(NULL AS TIMESTAMP) AS harvest_ts")
        known = {r["url"] for r in plan.join(cache.select("url"), "url", "left_semi").collect()}  # at most a row per request
        requests = [r for u, r in urls.items() if u not in known]
    fresh = spark.read.format("gleaner_search").options(config=json.dumps(config), requests=json.dumps(requests), **options).load()
    return fresh if cached is None else cached.unionByName(fresh)


def fetch(spark: SparkSession, urls: list[tuple[str, str, int]], limits: dict | None = None, **options: str) -> DataFrame:
    """Resources of (record_id, url, depth) rows, the cycle's bounded queue."""
    register(spark)
    return spark.read.format("gleaner_fetch").options(urls=json.dumps(urls), limits=json.dumps(limits or {}), **options).load()
